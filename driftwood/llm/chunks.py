"""The corpus as a table of chunks, and exchanges of hash lists by chunk.

Operators that compare every passage of a corpus with all others hash it in
numpy, a chunk of texts at a time, and let Spark shuffle sorted hash lists:
one row a chunk and part of the hash space.  What a part finds goes back to
the chunks it concerns, where the texts are read again.  A chunk holds about
``CHUNK_BYTES`` of text (or one longer text) and at most ``CHUNK_ROWS`` rows,
compressed; the table is written once to the shared checkpoint folder, so
chunk numbers are fixed and a lost executor costs a read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, materialise

CHUNK_BYTES = 8 << 20
CHUNK_ROWS = 1 << 16
SCHEMA = "chunk long, n int, n_bytes long, ids binary, nulls binary, payload binary"
#: Stands for a null id where ids are compared: larger than any.
NO_ID = np.iinfo(np.int64).max


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = CHUNK_BYTES,
                max_rows: int = CHUNK_ROWS, level: int = 5) -> DataFrame:
    def run(batches):
        part, seq, held, ids = TaskContext.get().partitionId(), 0, [], []

        def flush():
            nonlocal seq, held, ids
            lengths = np.array([len(t) for t in held], "<u4")
            raw = lengths.tobytes() + b"".join(held)
            row = [part << 24 | seq, len(held), int(lengths.sum(dtype=np.int64)),
                   np.array([NO_ID if i is None else i for i in ids], "<i8").tobytes(),
                   bytes(i is None for i in ids), zstandard.ZstdCompressor(level=level).compress(raw)]
            seq, held, ids = seq + 1, [], []
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0]], pa.int64()), pa.array([row[1]], pa.int32()), pa.array([row[2]], pa.int64()),
                 *(pa.array([b], pa.binary()) for b in row[3:])], ["chunk", "n", "n_bytes", "ids", "nulls", "payload"])

        total = 0
        for batch in batches:
            for i, t in zip(batch.column("id"), batch.column("text"), strict=True):
                held.append(t.as_py().encode("utf-8", "surrogatepass"))
                ids.append(i.as_py())
                total += len(held[-1])
                if total >= size or len(held) >= max_rows:
                    yield flush()
                    total = 0
        if held:
            yield flush()
    return materialise(id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA), "chunks")


class Chunk:
    """A decoded row of the chunk table."""

    def __init__(self, row: dict):
        self.number, n = row["chunk"], row["n"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.nulls = np.frombuffer(row["nulls"], bool)
        raw = zstandard.ZstdDecompressor().decompress(row["payload"])
        ends = np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.int64) + 4 * n
        self.texts = [raw[a:b] for a, b in zip(np.concatenate(([4 * n], ends[:-1])).tolist(), ends.tolist(), strict=True)]

    def id_array(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.nulls)


def rows_of(batches) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def parts_for(chunks: DataFrame, part_bytes: int = 24 << 20) -> int:
    """How many parts to cut the hash space into, so that one part of the
    words of all texts takes about ``part_bytes``."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(8, -(-int(total) // part_bytes))


def cut(sorted_keys: np.ndarray, parts: int, bits: int = 64) -> np.ndarray:
    """Places at which ascending keys of ``bits`` bits are cut into parts."""
    bounds = [(k << bits) // parts for k in range(1, parts)]
    return np.concatenate(([0], np.searchsorted(sorted_keys, np.array(bounds, np.uint64)), [len(sorted_keys)]))


def table_rows(t: pa.Table) -> list[dict]:
    return t.to_pylist()
