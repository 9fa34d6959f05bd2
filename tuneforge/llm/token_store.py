"""Token-id files: each document compressed by itself with one shared zstandard dictionary.

A store is a folder of segment files in ascending id order and the dictionary, trained on the
serialised ids of a bounded sample. A segment is

    b"TOKSEG1\\n" | one zstandard frame per document | index | footer

where the index (itself compressed) holds, per document in order, its id, its frame's offset and its
number of token ids, and the footer the index's place, the segment's totals, the width of a token id (2 or 4 bytes,
little-endian, unsigned) and the SHA-256 of the dictionary. One document is read from the footer, the
index and its own frame's bytes.

Segments get fresh names, and only those reported by finished tasks enter the manifest, so a task that
ran twice leaves no second copy in the store. Defined cases: a null or empty text is a document of its
end id alone; equal ids keep every row, ordered by frame; null ids come first; an empty table is a store
without segments."""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import wordcode
from .common import written
from .files import make_folder, open_input, open_output, read_range
from .wordcode import worker_cache

MAGIC = b"TOKSEG1\n"
FOOTER = "<QQQQHB32s8s"  # index offset and size, documents, token ids, format, id width, dictionary, magic
SAMPLE_DOCS = 400
DICTIONARY_BYTES = 65_536
SEGMENT_CHARS = 16_000_000
NO_ID = -(1 << 63)


def _tokenizer(path: str):
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return t

    return worker_cache(("tokenizer", path), make)


def word_encoder(tokenizer_path: str):
    """Adds the ids of new words to a dictionary of known ones."""
    t = _tokenizer(tokenizer_path)

    def run(words: list[str], known: dict) -> None:
        # Only where the lower-cased word is cut too: a letter may lower to one with a mark, which stays with the stop.
        cut = [(m.group(1), m.group(2)) if (m := _stop.match(w)) and _stop.match(w.lower()) else (w,) for w in words]
        parts = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in known]
        for p, e in zip(parts, t.encode_batch_fast(parts, add_special_tokens=False), strict=True):
            known[p] = np.array(e.ids, np.uint32)
        for w, c in zip(words, cut, strict=True):
            if len(c) == 2:
                known[w] = np.concatenate([known[c[0]], known[c[1]]])

    return run


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", finish=None,
           block_chars: int = wordcode.BLOCK_CHARS) -> DataFrame:
    """(id, n_ids, ids) by a tokenizer file whose words end at white space and whose letters and punctuation are
    split before merging, each distinct word encoded once."""

    def load():
        return word_encoder(tokenizer_path)

    fold = lower_fold if _splits_and_lowers(tokenizer_path) else str
    return wordcode.encode_texts(docs, id_col, text_col, None, load, finish, block_chars, fold)


_stop = re.compile(r"([^\W\d_]+)([.,])\Z")
_wide = re.compile("[^\x00-\u024f]")


def lower_fold(text: str) -> str:
    """Lower case where that is the same in every library: no letter beyond Latin Extended-B."""
    return text if not text.isascii() and _wide.search(text) else text.lower()


def _splits_and_lowers(path: str) -> bool:
    """Whether the tokenizer lowers its texts itself, so lower-case words give the same ids."""
    with open(path, encoding="utf-8") as f:
        normalizer = json.load(f).get("normalizer") or {}
    return "Lowercase" in [n["type"] for n in normalizer.get("normalizers", [normalizer]) if n]


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, width: int, id_col: str, text_col: str) -> bytes:
    """Trained on the ids of at most ``SAMPLE_DOCS`` whole documents, the smallest by a seeded hash of the
    id; b"" where they are too few or too short to train on."""
    import zstandard

    chosen = (docs.select(F.col(id_col).alias("_id")).distinct()
              .orderBy(F.xxhash64(F.lit("dictionary"), "_id"), "_id").limit(SAMPLE_DOCS))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_id").orderBy("_id", "_text").limit(SAMPLE_DOCS).collect()
    t = _tokenizer(tokenizer_path)
    kind = f"<u{width}"
    samples = [np.array([*t.encode(r["_text"] or "", add_special_tokens=False).ids, end_id], kind).tobytes() for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _zdict(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", segment_chars: int = SEGMENT_CHARS) -> tuple[str, DataFrame]:
    """(folder, manifest); the manifest has one row per segment: part, path, n_docs, n_ids, dictionary path."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-store")
    make_folder(folder)
    width = 2 if _tokenizer(tokenizer_path).get_vocab_size() <= 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer_path, end_id, width, id_col, text_col)
    digest = hashlib.sha256(dictionary).digest()
    dictionary_path = f"{folder}/{digest.hex()}.dictionary"
    with open_output(dictionary_path) as f:
        f.write(dictionary)

    def finish(ids: np.ndarray) -> bytes:
        import zstandard

        tool = worker_cache(("compressor", digest), lambda: zstandard.ZstdCompressor(level=6, dict_data=_zdict(dictionary)))
        return tool.compress(np.append(ids, end_id).astype(f"<u{width}").tobytes())

    frames = encode(docs, tokenizer_path, id_col, text_col, finish).withColumnRenamed(id_col, "_id")
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    parts = int(min(10_000, chars // segment_chars + 1))
    at = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), [k / parts for k in range(1, parts)] or [0.5], 20 * parts)).first()[0]
    bounds = np.array(at or [], np.int64)

    @F.arrow_udf("int")
    def part_of(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(bounds, known), pa.int32())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, f, part = [], None, None
        ids, sizes, counts = [], [], []

        def close():
            import zstandard

            index = zstandard.ZstdCompressor(level=3).compress(
                np.array(ids, "<i8").tobytes() + np.cumsum([len(MAGIC), *sizes]).astype("<u8").tobytes()
                + np.array(counts, "<u4").tobytes())
            f.write(index)
            f.write(struct.pack(FOOTER, len(MAGIC) + sum(sizes), len(index), len(ids), sum(counts), 1, width, digest, MAGIC))
            f.close()
            out.append({"part": part, "path": path, "n_docs": len(ids), "n_ids": sum(counts)})

        for batch in batches:
            for p, i, n, frame in zip(*(batch.column(c).to_pylist() for c in ("part", "_id", "n_ids", "ids")), strict=True):
                if p != part:
                    if f is not None:
                        close()
                    part, ids, sizes, counts = p, [], [], []
                    path = f"{folder}/segment-{p:06d}-{uuid.uuid4().hex}.tok"
                    f = open_output(path)
                    f.write(MAGIC)
                f.write(frame)
                ids.append(NO_ID if i is None else i)
                sizes.append(len(frame))
                counts.append(n + 1)
        if f is not None:
            close()
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
            [("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    rows = (frames.withColumn("part", part_of(F.col("_id"))).repartitionById(parts, "part")
            .sortWithinPartitions("part", F.col("_id").asc_nulls_first(), "ids"))
    manifest = written(rows.select("part", "_id", "n_ids", "ids")
                       .mapInArrow(write, "part int, path string, n_docs long, n_ids long"), "token-manifest")
    return folder, manifest.withColumn("dictionary", F.lit(dictionary_path))


def read_segment(path: str, dictionary_path: str, wanted: set | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, ids of the segment before it, its token ids) of all documents, or of the ``wanted`` ids, whose
    frames alone are then read."""
    import zstandard

    with open_input(path) as f:
        size = f.size()
        index_at, index_size, n_docs, n_ids, _, width, digest, magic = struct.unpack(
            FOOTER, read_range(f, size - struct.calcsize(FOOTER), struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError(f"not a token segment: {path}")

        def load():
            with open_input(dictionary_path) as d:
                data = d.read()
            if hashlib.sha256(data).digest() != digest:
                raise ValueError(f"{dictionary_path} is not the dictionary of {path}")
            return zstandard.ZstdDecompressor(dict_data=_zdict(data))

        tool = worker_cache(("decompressor", digest), load)
        raw = zstandard.ZstdDecompressor().decompress(read_range(f, index_at, index_size))
        ids = np.frombuffer(raw, "<i8", n_docs).tolist()
        ends = np.frombuffer(raw, "<u8", n_docs + 1, 8 * n_docs).astype(np.int64).tolist()
        counts = np.frombuffer(raw, "<u4", n_docs, 16 * n_docs + 8).astype(np.int64)
        starts = (np.cumsum(counts) - counts).tolist()
        chunk, base = b"", 0
        for k, i in enumerate(ids):
            i = None if i == NO_ID else i
            if wanted is not None and i not in wanted:
                continue
            if wanted is not None:
                frame = read_range(f, ends[k], ends[k + 1] - ends[k])
            else:
                if ends[k + 1] > base + len(chunk):  # frames are read on in ranges of a few MB
                    base = ends[k]
                    chunk = read_range(f, base, max(ends[k + 1] - base, min(4 << 20, ends[-1] - base)))
                frame = chunk[ends[k] - base:ends[k + 1] - base]
            got = np.frombuffer(tool.decompress(frame), f"<u{width}")
            if len(got) != counts[k]:
                raise ValueError(f"document {i} of {path} has {len(got)} ids, its index says {counts[k]}")
            yield i, starts[k], got


def read_store(manifest: DataFrame, id_col: str = "doc_id", wanted: set | None = None) -> DataFrame:
    """(id, start, n_tokens, ids): ``start`` counts the ids of all documents before; ids are little-endian
    unsigned 32-bit integers. ``wanted``: read these documents only."""
    before = Window.orderBy("part", "path").rowsBetween(Window.unboundedPreceding, -1)  # one row per segment
    listed = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, dictionary, first in zip(*(batch.column(c).to_pylist() for c in ("path", "dictionary", "first")), strict=True):
                rows, held = [], 0
                for i, start, ids in read_segment(path, dictionary, wanted):
                    rows.append((i, first + start, len(ids), ids.astype("<u4").tobytes()))
                    held += 4 * len(ids)
                    if held > 8 << 20:
                        yield _rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows)

    def _rows(rows):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          names=["_id", "start", "n_tokens", "ids"])

    spread = listed.select("path", "dictionary", "first").repartition(F.col("path"))
    return spread.mapInArrow(read, "_id long, start long, n_tokens long, ids binary").withColumnRenamed("_id", id_col)
