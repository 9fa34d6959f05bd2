"""User tokenizers (X1): a ``tokenizers`` JSON definition run in an Arrow UDF.

The JSON is broadcast once; each Python worker builds the tokenizer once per setting and encodes
an Arrow batch in slices of about ``SLICE_BYTES`` with ``encode_batch_fast``, since what the library
holds while it encodes is a hundred times the text. A slice's ids go back as one ``pyarrow.ListArray``
built from flat offsets and values. Output is ``array<int>``, the same type as the code-point
backend, so all label and padding functions apply unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


SLICE_BYTES = 256 * 1024  # of text encoded at once; a longer text is encoded alone


def _slices(batch: pa.Array) -> Iterator[pa.Array]:
    """A batch's rows in order, cut before the row that would take a slice beyond ``SLICE_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def encode_batches(tok, batches: Iterator[pa.Array], add_special_tokens: bool = False) -> Iterator[pa.Array]:
    """The ids of every text of the batches, slice by slice."""
    for batch in batches:
        for part in _slices(batch):
            texts = [t if t is not None else "" for t in part.to_pylist()]
            ids = [np.array(e.ids, np.int32) for e in tok.encode_batch_fast(texts, add_special_tokens=add_special_tokens)]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(i) for i in ids], out=offsets[1:])
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))


def _tokenizer(js: str, max_length: int | None = None):
    """Build (once per Python worker and setting) the tokenizer, truncating at ``max_length`` or
    not. The cache lives on the pyspark module, which workers import by reference (this package
    is shipped by value, so its own module state is rebuilt for every task)."""
    import pyspark

    cache = pyspark.__dict__.setdefault("_tuneforge_tokenizers", {})
    key = (hash(js), max_length)
    tok = cache.get(key)
    if tok is None:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(js)
        if max_length is None:
            tok.no_truncation()
        else:
            tok.enable_truncation(int(max_length))
        tok.no_padding()  # ids must not depend on which rows share an Arrow batch
        cache[key] = tok
    return tok


def tokenizer_ids(spark: SparkSession, col, tokenizer_json: str, add_special_tokens: bool = False,
                  max_length: int | None = None) -> Column:
    """Token ids of ``col`` under the tokenizer; null text encodes as ''. With ``max_length`` the
    tokenizer truncates itself (special tokens are kept and the content is cut), as a
    ``truncation=True`` call does."""
    bc = spark.sparkContext.broadcast(tokenizer_json)

    def enc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from encode_batches(_tokenizer(bc.value, max_length), batches, add_special_tokens)

    return F.arrow_udf(enc, "array<int>")(F.col(col) if isinstance(col, str) else col)


def tokenise(spark: SparkSession, col, backend: str = "codepoint", add_special_tokens: bool = False) -> Column:
    """Ids of ``col`` under a backend: ``"codepoint"`` (plain SQL, no Python) or a
    ``tokenizers`` JSON definition (Arrow UDF)."""
    if backend == "codepoint":
        from .tokens import codepoint_ids

        return codepoint_ids(col)
    return tokenizer_ids(spark, col, backend, add_special_tokens)


SPECIALS = ("<pad>", "<bos>", "<eos>")  # of the byte-level tokenizer built below


def byte_symbols() -> list[str]:
    """Printable stand-in character for each byte 0..255 (the usual byte-level BPE rule:
    printable Latin-1 bytes stand for themselves, the others map to 256 + n in order)."""
    keep = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    out, extra = [], 0
    for b in range(256):
        if b in keep:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


def byte_level_tokenizer_json() -> str:
    """A byte-level BPE tokenizer built from a rule: ids 0-2 are the specials, id 3+b is byte b,
    no merges. Encoding text gives 3 + its UTF-8 bytes."""
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers

    vocab = {s: i for i, s in enumerate(SPECIALS)}
    for b, sym in enumerate(byte_symbols()):
        vocab[sym] = len(SPECIALS) + b
    tok = Tokenizer(models.BPE(vocab=vocab, merges=[]))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    tok.add_special_tokens(list(SPECIALS))
    return tok.to_str()
