"""Helpers shared by the corpus operators: tables, scratch tables, word
hashing in numpy and packed integer lists."""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import driftwood
from driftwood.session import scratch_path

WHITE = b"\t\n\x0b\x0c\r "
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back;
    cuts the lineage, so a lost executor costs a read and not a recompute."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def discard(df: DataFrame) -> None:
    """Delete the scratch table that ``df`` reads, once nothing will read it
    again; any other table stays."""
    path = df.__dict__.get("scratch")
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def ship(spark: SparkSession) -> None:
    """In a local session, give the Python workers this package's code, once
    a Spark context.  On a cluster the deployment ships it (``--py-files``),
    and no machine-local folder is used."""
    sc = spark.sparkContext
    if not sc.master.startswith("local") or getattr(sc, "_driftwood_shipped", False):
        return
    root = Path(driftwood.__file__).parent
    held = Path(tempfile.mkdtemp(prefix="driftwood-code-")) / "driftwood_code.zip"
    with zipfile.ZipFile(held, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(held))
    sc._driftwood_shipped = True


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns ``id`` (long) and ``text`` (null -> empty) whatever else
    the table holds, for code that runs in Python workers."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def join_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of documents with ``ids(id)``,
    whatever the documents' columns are called; null ids meet null ids."""
    return docs.join(ids.select(F.col("id").alias("__listed_id")),
                     F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__listed_id")), how)


def bucket_of(id_col: str, n: int):
    """crc32 of the id's decimal text modulo ``n`` (null ids: bucket of '')."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % n


# absent where the C library is not glibc
_MALLOC_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release_memory() -> None:
    """Give what a Python worker has freed back to the system.  Workers are
    used again by later stages, and the allocators keep the largest amount
    that any chunk or group has needed."""
    pa.default_memory_pool().release_unused()
    if _MALLOC_TRIM is not None:
        _MALLOC_TRIM(0)


# ---- hashing -------------------------------------------------------------

_MASK = (1 << 64) - 1


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser, elementwise."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64), 7)
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 20
_POW = np.ones(_PIECE + 1, dtype=np.uint64)
np.multiply.accumulate(np.full(_PIECE, _BASE, dtype=np.uint64), out=_POW[1:])
_IPOW = np.ones(_PIECE + 1, dtype=np.uint64)
np.multiply.accumulate(np.full(_PIECE, pow(_BASE, -1, 1 << 64), dtype=np.uint64), out=_IPOW[1:])
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[list(WHITE)] = True


def _hash_piece(a: np.ndarray):
    """Hashes, starts and ends of the words of one byte array."""
    word = ~_IS_WHITE[a]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64), start, end
    if len(a) > _PIECE:  # holds a word longer than a piece
        h = np.array([int.from_bytes(hashlib.blake2b(a[s:e].tobytes(), digest_size=8).digest(), "little")
                      if e - s > _PIECE else 0 for s, e in zip(start, end, strict=True)], dtype=np.uint64)
        for k in np.flatnonzero(end - start <= _PIECE):
            h[k] = _hash_piece(a[start[k]:end[k]])[0][0]
        return h, start, end
    total = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[a] * _POW[:len(a)], dtype=np.uint64)))
    return mix((total[end] - total[start]) * _IPOW[start]), start, end


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of every word (maximal run of bytes that are not white
    space) of ``data``, in order.  The hash of a word does not depend on
    where it stands; memory beyond the result is bounded."""
    if len(data) <= _PIECE:
        return _hash_piece(np.frombuffer(data, np.uint8))[0]
    out, at, a = [], 0, np.frombuffer(data, np.uint8)
    while at < len(a):
        to = at + _PIECE
        if to < len(a):
            cut = np.flatnonzero(_IS_WHITE[a[at:to]])
            if len(cut):
                to = at + int(cut[-1]) + 1
            else:  # inside a word longer than a piece: go on to its end
                while to < len(a) and not _IS_WHITE[a[to]]:
                    to += 1
        out.append(_hash_piece(a[at:to])[0])
        at = to
    return np.concatenate(out)


def shingles(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words; fewer words than ``k``
    (but not none): the whole sequence as one."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    w = min(k, n)
    out = np.full(n - w + 1, np.uint64(w if n < k else 0), dtype=np.uint64)
    for j in range(w):
        out += words[j:n - w + 1 + j] * _POW[j + 1]
    return mix(out, 1 + salt)


def fold_bytes(b: bytes) -> bytes:
    """A-Z lower-cased and nothing else changed."""
    return b.translate(_FOLD)


# ---- packed integers -----------------------------------------------------

# made once a worker: a codec costs far more than a small list
_PACKER, _UNPACKER = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending uint64 -> bytes: differences, byte planes, compressed."""
    d = np.diff(a.astype(np.uint64), prepend=np.uint64(0))
    return pack(d)


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


def pack(a: np.ndarray) -> bytes:
    """uint64 -> bytes, as byte planes, so that high bytes compress."""
    planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return _PACKER.compress(planes.tobytes())


def unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(_UNPACKER.decompress(b), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)
