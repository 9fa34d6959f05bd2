"""Word-level coding of whole texts by a global distinct-word shuffle.

A tokenizer that treats each word of a text separately needs to see each distinct word once:

1. *Blocks.* Each task splits its texts into words with their positions, kept packed: a block holds the
   documents of about ``BLOCK_CHARS`` characters. Its word numbers in text order stay in one packed file
   of the shared scratch folder; its distinct words, dealt by hash into buckets, are a written table.
2. *Distinct words.* The blocks' word lists are shuffled by bucket, so all copies of a word meet in one
   task, which encodes each distinct word once and answers each block's list with the words' ids.
3. *Reassembly.* The answers are grouped back by block, and each document's ids are gathered by position.

The occurrences themselves (most of the corpus) are never shuffled. A hot word is one entry per block. The number of buckets follows the corpus, so a bucket's vocabulary is
bounded at any size."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written
from .files import make_folder, open_input, open_output

BLOCK_CHARS = 12_000_000
BUCKET_CHARS = 4_000_000
# Unicode White_Space, as regular expression engines other than Python's define \s.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

Split = Callable[[str], tuple[list[str], np.ndarray]]  # words of a text, and 1 where a space leads the word
# Adds the ids of new words to a dictionary of known ones, which is kept for a bucket.
Encoder = Callable[[list[str], dict], None]


def worker_cache(key, make):
    """``make()`` once per Python worker process and key."""
    store = sys.__dict__.setdefault("_tuneforge_llm_cache", {})
    if key not in store:
        store[key] = make()
    return store[key]


def release_memory() -> None:
    """Give freed memory back to the system: Python workers live on, and what one task held would otherwise stay
    counted beside the next stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, releasing memory when a task's batches are done."""
    def outer(batches):
        yield from run(batches)
        release_memory()

    return outer


def split_keeping_space(text: str) -> tuple[list[str], np.ndarray]:
    """Cut a text where byte-level pre-tokenisers always cut: before each run of non-spaces together with
    one leading space; of a longer white-space run, its last character stands alone."""
    if not text:
        return [], np.zeros(0, np.uint32)
    if not text[0].isspace() and not text[-1].isspace() and not any(map(text.__contains__, _ROUGH)):
        # only single spaces and single line feeds, none at either end
        words, lead = [], []
        for k, line in enumerate(text.split("\n")):
            own = line.split(" ")
            if k:
                words.append("\n")
                lead.append(np.zeros(1, np.uint32))
            words += own
            lead.append(np.ones(len(own), np.uint32))
            lead[-1][0] = 0
        return words, np.concatenate(lead)
    chunks = _chunk.findall(text)
    flags = np.fromiter((len(c) > 1 and c[0] == " " and not _space.match(c, 1) for c in chunks), np.uint32, len(chunks))
    return [c[1:] if f else c for c, f in zip(chunks, flags.tolist(), strict=True)], flags


_ODD = "\x1c\x1d\x1e\x1f"  # white space for str methods only
# Two white-space characters in a row, or one other than space and line feed. Substring tests, as they scan
# many times faster than a pattern.
_ROUGH = ["  ", "\n\n", " \n", "\n ", *_ODD, "\t", "\r", "\x0b", "\x0c", "\x85", "\xa0", "\u1680", "\u2028", "\u2029", "\u202f",
          "\u205f", "\u3000", *map(chr, range(0x2000, 0x200B))]
_space = re.compile(f"[{SPACE}]")
_chunk = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class _Numbers(dict):
    """word -> its number in order of first appearance."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class _Cuts:
    """The words of a block's texts, cut and numbered text by text."""

    def __init__(self, split: Split):
        self.split, self.numbers, self.lens, self.codes = split, _Numbers(), [], []

    def add(self, text: str) -> None:
        words, lead = self.split(text)
        self.lens.append(len(words))
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)) * 2 + lead)

    def done(self) -> tuple[list[int], list[np.ndarray], list[str]]:
        return self.lens, self.codes, list(self.numbers)


_WIDE_SPACE = _ROUGH[_ROUGH.index("\x85"):]
_wide_space = re.compile("[" + "".join(_WIDE_SPACE) + "]")


class SpaceRuns:
    """The runs of non-spaces of a block's folded texts, cut and numbered together by Arrow."""

    def __init__(self, fold: Callable[[str], str]):
        self.fold, self.texts = fold, []

    def add(self, text: str) -> None:
        text = self.fold(text)
        if any(map(text.__contains__, _WIDE_SPACE)):
            text = _wide_space.sub(" ", text)
        self.texts.append(text.strip(" \t\n\r\x0b\x0c") or None)  # an end of white space would give an empty word

    def done(self) -> tuple[list[int], list[np.ndarray], list[str]]:
        words = pc.ascii_split_whitespace(pa.array(self.texts, pa.large_string()))
        lens = pc.list_value_length(words).fill_null(0).to_pylist()
        coded = words.flatten().dictionary_encode()
        return lens, [coded.indices.to_numpy().astype(np.uint32) * 2], coded.dictionary.to_pylist()


def _pack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Integer arrays, stored byte plane by byte plane in as few bytes a number as their values need."""
    out = [np.array([len(arrays)], "<i8").tobytes()]
    for a in arrays:
        a = np.asarray(a)
        low = int(a.min()) if len(a) else 0
        a = a - a.dtype.type(low) if len(a) else a
        width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        out.append(np.array([len(a), low, width], "<i8").tobytes())
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize) if width else None
        out += [planes[:, k].tobytes() for k in range(width)]
    return _pack(b"".join(out))


def unpack_arrays(data: bytes) -> list[np.ndarray]:
    """The packed arrays: unsigned 32-bit where that holds them, else signed 64-bit."""
    raw = np.frombuffer(_unpack(data), np.uint8)
    at, out = 8, []
    for _ in range(int(raw[:8].view("<i8")[0])):
        n, low, width = (int(x) for x in raw[at:at + 24].copy().view("<i8"))
        at += 24
        small = low >= 0 and width <= 3 and low < 1 << 31
        planes = np.zeros((n, 4 if small else 8), np.uint8)
        for k in range(width):
            planes[:, k] = raw[at:at + n]
            at += n
        a = planes.view("<u4" if small else "<i8")[:, 0] if n else np.zeros(0, "<u4" if small else "<i8")
        out.append(a + a.dtype.type(low) if low else a)
    return out


NO_ID = -(1 << 62)  # stands for a null id


def _block(path: str, ids: list, lens: list[int], codes: list[np.ndarray], words: list[str], buckets: int) -> pa.RecordBatch:
    """Write the positions of a block to ``path`` and return its word lists, one per bucket."""
    import xxhash

    codes = np.concatenate([*codes, np.zeros(0, np.uint32)])
    counts = np.bincount(codes, minlength=2 * len(words))
    used = np.flatnonzero(counts)
    counts = counts[used]
    raw = [((" " if c & 1 else "") + words[c >> 1]).encode("utf-8", "surrogatepass") for c in used.tolist()]
    # Forms of a word that differ by case or a full stop or comma share a bucket, so an encoder can reuse the stem.
    bucket = np.fromiter((xxhash.xxh64_intdigest(r.rstrip(b".,").lower()) % buckets for r in raw), np.int64, len(raw))
    # Lists are in bucket order, each sorted by its words' first bytes; positions count from the most frequent word.
    order = np.lexsort((np.array(raw, "S8").view(">u8"), bucket)) if raw else np.zeros(0, np.int64)
    place, rank = np.empty(len(raw), np.uint32), np.zeros(2 * len(words), np.uint32)
    place[order] = np.arange(len(raw), dtype=np.uint32)
    common = np.argsort(-counts, kind="stable")
    rank[used[common]] = np.arange(len(raw), dtype=np.uint32)
    with open_output(path) as f:
        f.write(pack_arrays(np.array([NO_ID if i is None else i for i in ids], np.int64), np.array(lens, np.int64),
                            place[common], rank[codes]))
    lists = []
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        own = [raw[i] for i in part.tolist()]
        lists.append((path, int(bucket[part[0]]) if len(part) else 0,
                      _pack(pack_head(own) + b"".join(own))))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
        zip(*lists, strict=True), (pa.string(), pa.int64(), pa.binary()), strict=True)], names=["block", "bucket", "words"])


def pack_head(words: list[bytes]) -> bytes:
    return np.array([len(words), *map(len, words)], "<u4").tobytes()


def _words_of(blob: bytes) -> list[str]:
    raw = _unpack(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)).tolist()
    out, at = [], 4 + 4 * n
    for end in ends:
        out.append(raw[at:end].decode("utf-8", "surrogatepass"))
        at = end
    return out


def encode_texts(docs: DataFrame, id_col: str, text_col: str, split: Split | None, load: Callable[[], Encoder],
                 finish: Callable[[np.ndarray], bytes] | None = None, block_chars: int = BLOCK_CHARS,
                 fold: Callable[[str], str] | None = None) -> DataFrame:
    """(id, n_ids, ids): each text's ids as little-endian unsigned 32-bit integers, or as ``finish`` packs
    them. A null text is empty. ``load`` runs in the Python worker and returns the encoder of words. Words
    are as ``split`` cuts a text, or, where ``fold`` is given, the runs of non-spaces of the folded text."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    chars = rows.agg(F.sum(F.length("_text"))).first()[0] or 0
    buckets = max(16, chars // BUCKET_CHARS)

    folder = scratch_path(docs.sparkSession, "word-blocks")
    make_folder(folder)

    def make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh():
            return 0, [], SpaceRuns(fold) if fold else _Cuts(split)

        held, ids, cut = fresh()
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                cut.add(text)
                ids.append(i)
                held += len(text)
                if held >= block_chars:
                    yield _block(f"{folder}/{uuid.uuid4().hex}", ids, *cut.done(), buckets)
                    ids = cut = None
                    release_memory()
                    held, ids, cut = fresh()
        if ids:
            yield _block(f"{folder}/{uuid.uuid4().hex}", ids, *cut.done(), buckets)

    # Written before use: only blocks of finished tasks count, and a lost executor re-reads them.
    lists = written(rows.mapInArrow(trimmed(make_blocks), "block string, bucket long, words binary"), "word-lists")

    def encode_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known, at = load(), {}, None
        for batch in batches:
            out = []
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if bucket != at:
                    known, at = {}, bucket
                words = _words_of(blob)
                new = [w for w in words if w not in known]
                if new:
                    encoder(new, known)
                found = [known[w] for w in words]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                out.append(pack_arrays(counts, np.concatenate([*found, np.zeros(0, np.uint32)])))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"), pa.array(out, pa.binary())],
                                             names=["block", "bucket", "coded"])

    coded = (lists.repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(trimmed(encode_lists), "block string, bucket long, coded binary"))
    kind = pa.schema([("_id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.binary())])

    def reassemble(answers: pa.Table) -> pa.Table:
        listed = sorted(zip(answers["bucket"].to_pylist(), answers["coded"].to_pylist(), strict=True))
        parts = [unpack_arrays(blob) for _, blob in listed]
        counts = np.concatenate([p[0] for p in parts]).astype(np.int64)
        tokens = np.concatenate([p[1] for p in parts]).astype(np.uint32)
        del parts, listed
        starts = np.cumsum(counts) - counts
        with open_input(answers["block"][0].as_py()) as f:
            ids, lens, place, codes = unpack_arrays(f.read())
        counts, starts = counts[place], starts[place]
        out, n_out, at = [], [], 0
        for n in lens.tolist():
            own = codes[at:at + n]
            at += n
            size = counts[own]
            before = np.cumsum(size) - size
            got = tokens[np.repeat(starts[own] - before, size) + np.arange(int(size.sum()))]
            n_out.append(len(got))
            out.append(got.astype("<u4").tobytes() if finish is None else finish(got))
        ids = [None if i == NO_ID else i for i in ids.tolist()]
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(n_out, pa.int64()),
                                     pa.array(out, pa.binary())], schema=kind)

    done = coded.groupBy("block").applyInArrow(reassemble, "_id long, n_ids long, ids binary")
    return done.withColumnRenamed("_id", id_col)
