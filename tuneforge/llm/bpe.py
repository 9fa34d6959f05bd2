"""Byte-level BPE encoding by a global distinct-word shuffle, and decoding by the token-byte table.

The rank file and the pre-token pattern are parameters. Special tokens have no meaning: their strings
are ordinary text. A null text is empty (no ids); repeated rows are encoded alike; an empty table gives
an empty result; columns beyond id and text are not read."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import wordcode
from .wordcode import trimmed, worker_cache


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_chars: int = wordcode.BLOCK_CHARS) -> DataFrame:
    """(id, n_ids, ids): each text's token ids as little-endian unsigned 32-bit integers."""

    def load():
        def make():
            import tiktoken

            return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})

        encoding = worker_cache(("bpe", ranks_path, pattern), make)
        return lambda words, known: known.update((w, np.array(encoding.encode_ordinary(w), np.uint32)) for w in words)

    return wordcode.encode_texts(docs, id_col, text_col, wordcode.split_keeping_space, load, block_chars=block_chars)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded`` (bytes): every id joined with the token-byte table, in order. The table has one row
    per vocabulary entry, whatever the corpus, so it is joined on the map side as arrays."""
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make():
            ranks = read_ranks(ranks_path)
            size = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, rank in ranks.items():
                size[rank] = len(token)
            start = np.cumsum(size) - size
            data = np.zeros(int(size.sum()), np.uint8)
            for token, rank in ranks.items():
                data[start[rank]:start[rank] + len(token)] = np.frombuffer(token, np.uint8)
            return size, start, data

        size, start, data = worker_cache(("token bytes", ranks_path), make)
        for batch in batches:
            out = []
            for ids in batch.column(names.index(ids_col)):
                ids = np.frombuffer(ids.as_buffer(), "<u4")
                n = size[ids]
                before = np.cumsum(n) - n
                out.append(data[np.repeat(start[ids] - before, n) + np.arange(int(n.sum()))].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(trimmed(run), f"{schema}, decoded binary")
