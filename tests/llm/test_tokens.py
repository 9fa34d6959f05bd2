import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken

from tuneforge.llm import bpe, queries, token_store
from tuneforge.llm.common import table

from ..conftest import SF_SMALL

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
HARD = ["", None, " ", "\n", "  a", "a  ", "a \n b", "a\n\nb", "a\tb", "x\r\ny", "don't we'll I'M they're 's", "a1b22 3",
        "tab\t\tz", "é ü  ß—…", "a\x1cb \x1f c", "a b", "　x", "日本 語。 ​", "<|endoftext|> x", "!!! ???\n",
        "one two", "one two", "w " * 3000, "y" * 4000, "́ á Å", "ΑΣ ΑΣ'S İI ſ", "🙂 👨‍👩‍👧 z"]


def test_bpe_like_library(spark):
    enc = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(HARD)], "doc_id long, text string, ids string")
    for block in (10, 10**7):
        got = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN, block_chars=block), RANKS).collect()
        assert len(got) == len(HARD)
        for r in got:
            text = HARD[r.doc_id] or ""
            assert np.frombuffer(r.ids, "<u4").tolist() == enc.encode_ordinary(text), text
            assert bytes(r.decoded) == text.encode() and r.n_ids == len(r.ids) // 4
    assert bpe.encode(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_op3_whole_texts(spark):
    enc = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    want = {}
    for r in table(spark, SF_SMALL, "documents").collect():
        ids = np.array(enc.encode_ordinary(r.text or ""), "<u4").tobytes()
        want[r.doc_id] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op3_bpe"](spark, SF_SMALL).collect()}
    assert got == want


def word_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_token_store_round_trip(spark):
    docs = spark.createDataFrame([(i * 3, t, "x") for i, t in enumerate(HARD)] + [(0, "again", "x"), (None, "no id", "x")],
                                 "doc_id long, text string, ids string")
    rows = docs.collect()
    folder, manifest = token_store.write_store(docs.repartition(3), WORDS, 2, segment_chars=2000)
    got = token_store.read_store(manifest).collect()
    want = sorted(zip([r.doc_id for r in rows], word_ids([r.text for r in rows])), key=str)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=str) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys) and manifest.count() > 1
    one = token_store.read_store(manifest, wanted={9, 30}).collect()
    assert sorted(map(str, one)) == sorted(str(r) for r in got if r.doc_id in (9, 30))
    assert token_store.read_store(token_store.write_store(docs.limit(0), WORDS, 2)[1]).count() == 0


def test_op8_whole_texts(spark):
    rows = sorted(table(spark, SF_SMALL, "documents").collect(), key=lambda r: r.doc_id)
    start, want = 0, {}
    for r, ids in zip(rows, word_ids([r.text for r in rows]), strict=True):
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op8_token_store"](spark, SF_SMALL).collect()}
    assert got == want


def test_op8_words_like_library():
    """Random words of letters with marks, capitals, stops and other scripts, as the library encodes them."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from tuneforge.llm import token_store, wordcode

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(4)
    letters = "abcXYZ İıſßẞÉéǅŉΐ日本кИΣς́̇.,.,-'1٣ \n\t"
    texts = ["日İ.", "İ.", "İ, x", "日 İİ.", "Σ. ΑΣ, ς."] + ["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(200_000)]
    load = token_store.word_encoder(path)
    known: dict = {}
    runs = wordcode.SpaceRuns(token_store.lower_fold)
    for t in texts:
        runs.add(t)
    lens, (codes,), numbered = runs.done()
    ends = np.cumsum(lens)
    words = [[numbered[c >> 1] for c in codes[end - n:end].tolist()] for end, n in zip(ends.tolist(), lens, strict=True)]
    load(list(dict.fromkeys(w for ws in words for w in ws)), known)
    for at in range(0, len(texts), 20_000):
        want = library.encode_batch_fast(texts[at:at + 20_000], add_special_tokens=False)
        for t, ws, e in zip(texts[at:], words[at:], want):
            assert [int(x) for w in ws for x in known[w]] == e.ids, t
