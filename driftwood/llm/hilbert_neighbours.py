"""Exact-checked nearest neighbours over shifted Hilbert curves.

Vectors are projected on a few orthonormal directions (principal ones of a
bounded sample; every ordering turns them anew), shifted, cut into cells and
numbered along a Hilbert curve.  Each ordering is range-partitioned into
blocks of neighbouring keys, with bounds from a mergeable quantile sketch.
In its block, and in the blocks before and after it, a query looks at a window
of neighbouring keys; the windows of all orderings merge.  They work on 8-bit
sketches of the vectors with a proven error, so the (k+1)-th smallest upper
bound is a radius that holds the query's k neighbours and itself.

The rerank is exact and on the original vectors: key blocks of the first
ordering carry the box of their projections and of the length of what the
projection leaves out; only blocks whose box can reach into a query's radius
are opened, and the radius shrinks as they are read.  So recall is 1 by
construction, for any data; how many blocks stay closed depends on the data
(none do for vectors without structure: then this costs as much as a full
search of the stated queries, in blocks).

The work is tiled: some ``GROUP`` queries meet up to ``STRIP`` blocks in a task,
and each tile puts out k + 1 neighbours a query, packed.  Equal keys are told
apart by a hash, so copies of a vector spread over blocks, and a block keeps
only the k + 1 smallest ids of equal vectors (more can be in no result).

Defined results: a vector that is null, empty, zero, of another length than
``dim`` (by default the most frequent one, of these the longest), or has a
null or non-finite component takes no part, nor does a row with a null id;
candidates are all rows but the query's own, so another row with the query's
id may be found; repeated query rows have their neighbours once each; fewer
candidates than k give all; ties go to the smaller id; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix
from .dense import finite_vectors, matrix

K = 10
ORDERINGS = 4
DIMS, BITS, TIE_BITS = 8, 6, 15
#: Vectors that fit the directions, at most.
SAMPLE = 4096
#: Vectors a block, blocks a tile at most, queries a tile (about) and a piece of it.
BLOCK, STRIP, GROUP, PIECE = 4096, 64, 16384, 1024
#: Neighbouring keys on either side of a query.
WINDOW = 64


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cell numbers along the Hilbert curve."""
    x = [c.copy() for c in cells.astype(np.uint64).T]
    for level in range(bits - 1, 0, -1):
        q, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for axis in x:
            high = (axis & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ axis) & below)
            x[0] ^= np.where(high, below, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(level)) & np.uint64(1), np.uint64((1 << level) - 1), np.uint64(0))
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = key << np.uint64(1) | ((axis ^ flip) >> np.uint64(level)) & np.uint64(1)
    return key


class Curves:
    """The orderings' directions, ranges and shifts, fitted on a sample."""

    def __init__(self, sample: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.dim, m = dim, min(DIMS, dim)
        sample = np.clip(sample, -1e150, 1e150)  # the curves need not be good out there, only defined
        self.mean = sample.mean(axis=0)
        with np.errstate(all="ignore"):
            spread = sample - self.mean
            scale = np.abs(spread).max()
            basis = np.linalg.svd(spread / (scale or 1.0), full_matrices=True)[2][:min(2 * m, dim)]
        self.directions, self.low, self.span = [], [], []
        for o in range(ORDERINGS):
            turn = np.eye(len(basis))[:, :m] if o == 0 else np.linalg.qr(rng.standard_normal((len(basis), len(basis))))[0][:, :m]
            d = turn.T @ basis
            y = np.quantile(spread @ d.T, [0.001, 0.999], axis=0)
            self.directions.append(d)
            self.low.append(y[0])
            self.span.append(float((y[1] - y[0]).max()) or 1.0)

    def project(self, v: np.ndarray, o: int = 0) -> np.ndarray:
        return (v - self.mean) @ self.directions[o].T

    def keys(self, v: np.ndarray, o: int, tie: np.ndarray) -> np.ndarray:
        """Ascending along the ordering's curve; ``tie`` parts equal cells."""
        with np.errstate(all="ignore"):
            at = np.clip(np.nan_to_num((self.project(v, o) - self.low[o]) / self.span[o]), 0, 1)
        cells = np.clip((at / 2 + o / (2 * ORDERINGS)) * (1 << BITS), 0, (1 << BITS) - 1)
        key = hilbert_key(cells, BITS) << np.uint64(TIE_BITS)
        return (key | tie >> np.uint64(64 - TIE_BITS)).astype(np.int64)

    def box_point(self, v: np.ndarray) -> np.ndarray:
        """Coordinates whose distances never exceed the vectors': the first
        projection and the length of what it leaves out."""
        with np.errstate(all="ignore"):
            y = self.project(v)
            rest = v - self.mean - y @ self.directions[0]
            return np.concatenate([y, np.sqrt((rest ** 2).sum(axis=1))[:, None]], axis=1)


def tie_breaks(ids: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """A hash of every row's id and vector; repeated rows of the batch differ."""
    both = mix(ids.astype(np.uint64) ^ mix(prints.astype(np.uint64), 31), 32)
    by = np.argsort(both, kind="stable")
    start = np.flatnonzero(np.concatenate(([True], both[by][1:] != both[by][:-1])))
    nth = np.empty(len(both), np.uint64)
    nth[by] = np.arange(len(both)) - np.repeat(start, np.diff(np.concatenate((start, [len(both)]))))
    return mix(both + nth, 33)


def sketch(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit components, their unit, and the distance from the vector."""
    unit = np.abs(v).max(axis=1) / 127.0
    unit[unit == 0] = 1.0  # also where the quotient is too small for a double
    small = np.rint(v / unit[:, None]).astype(np.int8)
    with np.errstate(all="ignore"):
        return small, unit, np.sqrt(((small * unit[:, None] - v) ** 2).sum(axis=1)) * (1 + 1e-9)


def _columns(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    v = matrix(batch, dim)
    ids, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "print"))
    return v, ids, prints, tie_breaks(ids, prints)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * rows.shape[1]
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def _rows_of(column: pa.ChunkedArray | pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _pack(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


# ---- keys and windows ----------------------------------------------------

def key_table(vectors: DataFrame, curves: Curves) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v, _, _, tie = _columns(batch, curves.dim)
                yield pa.RecordBatch.from_pydict({f"key{o}": curves.keys(v, o, tie) for o in range(ORDERINGS)})
    return vectors.mapInArrow(run, ", ".join(f"key{o} long" for o in range(ORDERINGS)))


def block_bounds(keys: DataFrame, n: int) -> list[np.ndarray]:
    """For every ordering, the keys at which its blocks of about ``BLOCK``
    vectors begin: one number a block comes to the driver."""
    blocks = -(-n // BLOCK)
    if blocks < 2:
        return [np.empty(0, np.int64)] * ORDERINGS
    # one literal, folded by the optimizer, instead of one a block
    shares = F.split(F.lit(",".join(repr(i / blocks) for i in range(1, blocks))), ",").cast("array<double>")
    row = keys.agg(*[F.percentile_approx(f"key{o}", shares, F.lit(max(10000, 16 * blocks))).alias(f"b{o}")
                     for o in range(ORDERINGS)]).first()
    return [np.unique(np.array(row[f"b{o}"], np.int64)) for o in range(ORDERINGS)]


WINDOW_SCHEMA = ("ordering int, block int, role int, key long, id long, print long, sketch binary, unit double, error double")
RADIUS_SCHEMA = "id long, print long, ids array<long>, bounds array<double>"


def window_rows(vectors: DataFrame, curves: Curves, bounds: list[np.ndarray]) -> DataFrame:
    """Every vector in its block of every ordering (``role`` 0, 1 if it is a
    query), queries in the blocks before and after as well (``role`` 2)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v, ids, prints, tie = _columns(batch, curves.dim)
            asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            small, unit, error = sketch(v)
            for o in range(ORDERINGS):
                key = curves.keys(v, o, tie)
                block = np.searchsorted(bounds[o], key, side="right")
                for step in (0, -1, 1):
                    to = block + step
                    here = np.flatnonzero((to >= 0) & (to <= len(bounds[o])) & (asks | (step == 0)))
                    role = np.where(asks[here], 1, 0) if step == 0 else np.full(len(here), 2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(here), o, np.int32)), pa.array(to[here], pa.int32()), pa.array(role, pa.int32()),
                         pa.array(key[here]), pa.array(ids[here]), pa.array(prints[here]), _binary(small[here]),
                         pa.array(unit[here]), pa.array(error[here])],
                        ["ordering", "block", "role", "key", "id", "print", "sketch", "unit", "error"])
    return vectors.mapInArrow(run, WINDOW_SCHEMA)


def window_neighbours(t: pa.Table, dim: int, k: int) -> pa.Table:
    """The ``k`` smallest distance bounds of every query of one block, among
    the neighbouring keys."""
    role, key, ids, prints, unit, error = (t[c].to_numpy() for c in ("role", "key", "id", "print", "unit", "error"))
    small = _rows_of(t["sketch"], np.int8, dim)
    own = np.flatnonzero(role < 2)
    own = own[np.lexsort((ids[own], key[own]))]
    asks = np.flatnonzero(role > 0)
    # repeated rows ask once
    asks = asks[np.unique(np.stack([ids[asks], prints[asks]]), axis=1, return_index=True)[1]] if len(asks) else asks
    out_ids, out_bounds = [], []
    if len(own):
        width = min(len(own), 2 * WINDOW + 1)
        first = np.clip(np.searchsorted(key[own], key[asks]) - WINDOW, 0, len(own) - width)
        for a in range(0, len(asks), 256):
            q = asks[a:a + 256]
            near = own[first[a:a + 256, None] + np.arange(width)]
            with np.errstate(all="ignore"):
                apart = (small[near] * unit[near][:, :, None] - (small[q] * unit[q][:, None])[:, None]) ** 2
                bound = (np.sqrt(apart.sum(axis=2)) + error[near] + error[q][:, None]) * (1 + 1e-9)
            best = np.argsort(bound, axis=1, kind="stable")[:, :k]
            out_ids += np.take_along_axis(ids[near], best, axis=1).tolist()
            out_bounds += np.take_along_axis(bound, best, axis=1).tolist()
    else:
        asks = asks[:0]
    return pa.table([pa.array(ids[asks]), pa.array(prints[asks]), pa.array(out_ids, pa.list_(pa.int64())),
                     pa.array(out_bounds, pa.list_(pa.float64()))], ["id", "print", "ids", "bounds"])


def radii(vectors: DataFrame, curves: Curves, bounds: list[np.ndarray], k: int) -> DataFrame:
    """``id, print, radius``: the k-th smallest bound over the merged
    windows of a query (infinite, if they hold fewer ids)."""
    dim = curves.dim
    found = window_rows(vectors, curves, bounds).groupBy("ordering", "block").applyInArrow(
        lambda t: window_neighbours(t, dim, k), RADIUS_SCHEMA)
    # a row an ordering and block that the query met: its own, the one before and the one after
    each = found.select("id", "print", F.explode(F.arrays_zip("ids", "bounds")).alias("x"))
    least = each.groupBy("id", "print", "x.ids").agg(F.min("x.bounds").alias("bound"))
    return least.groupBy("id", "print").agg(F.sort_array(F.collect_list("bound")).alias("b")).select(
        "id", "print", F.coalesce(F.try_element_at("b", F.lit(k)), F.lit(float("inf"))).alias("radius"))


# ---- exact rerank --------------------------------------------------------

BOX = "low array<double>, high array<double>"
BLOCK_SCHEMA = f"block int, n int, ids binary, vecs binary, {BOX}"
PIECE_SCHEMA = f"grp int, piece int, n int, ids binary, copies binary, vecs binary, radius binary, widest double, {BOX}"
FOUND_SCHEMA = "grp int, piece int, ids binary, distances binary"


def _box(curves: Curves, v: np.ndarray) -> tuple[list[float], list[float]]:
    """Bounds of the vectors' ``box_point``, with some slack for rounding."""
    points = curves.box_point(v)
    slack = 1e-12 * curves.dim * (np.abs(v).max() + np.abs(curves.mean).max())
    return (points.min(axis=0) - slack).tolist(), (points.max(axis=0) + slack).tolist()


def _placed(vectors: DataFrame, curves: Curves, bound: np.ndarray, per: int) -> DataFrame:
    """The rows with the number of their block of the first ordering (by
    ``per`` blocks)."""
    schema = "block int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v, _, _, tie = _columns(batch, curves.dim)
                block = np.searchsorted(bound, curves.keys(v, 0, tie), side="right") // per
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), *batch.columns], ["block", *batch.schema.names])
    return vectors.mapInArrow(run, schema)


def packed_blocks(vectors: DataFrame, curves: Curves, bound: np.ndarray, k: int) -> DataFrame:
    """The vectors by blocks, with boxes; of equal vectors the ``k`` smallest ids."""
    def run(t: pa.Table) -> pa.Table:
        flat = t["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, curves.dim)
        ids = t["id"].to_numpy()
        same = np.unique(flat, axis=0, return_inverse=True)[1].ravel()
        by = np.lexsort((ids, same))
        start = np.flatnonzero(np.concatenate(([True], same[by][1:] != same[by][:-1])))
        nth = np.arange(len(by)) - np.repeat(start, np.diff(np.concatenate((start, [len(by)]))))
        by = by[nth < k]
        low, high = _box(curves, flat[by].astype(np.float64))
        kept_ids, kept = _pack(ids[by], flat[by])
        return pa.table([pa.array([t["block"][0].as_py()], pa.int32()), pa.array([len(by)], pa.int32()), pa.array([kept_ids], pa.binary()),
                         pa.array([kept], pa.binary()), pa.array([low], pa.list_(pa.float64())), pa.array([high], pa.list_(pa.float64()))],
                        ["block", "n", "ids", "vecs", "low", "high"])
    rows = _placed(vectors.select("id", "vec", "print"), curves, bound, 1)
    return rows.groupBy("block").applyInArrow(run, BLOCK_SCHEMA)


def packed_queries(queries: DataFrame, curves: Curves, bound: np.ndarray) -> DataFrame:
    """Queries of neighbouring blocks by groups, cut into pieces, with boxes
    and their widest radius."""
    def run(t: pa.Table) -> pa.Table:
        out = []
        v = t["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, curves.dim)
        key = curves.keys(v, 0, tie_breaks(t["id"].to_numpy(), t["print"].to_numpy()))
        by = np.argsort(key, kind="stable")
        ids, copies, radius = (t[c].to_numpy() for c in ("id", "copies", "radius"))
        for piece, a in enumerate(range(0, len(by), PIECE)):
            p = by[a:a + PIECE]
            low, high = _box(curves, v[p])
            held = _pack(ids[p], copies[p], v[p], radius[p])
            out.append({"grp": t["block"][0].as_py(), "piece": piece, "n": len(p), "widest": float(radius[p].max()), "low": low,
                        "high": high, **dict(zip(("ids", "copies", "vecs", "radius"), held, strict=True))})
        return pa.Table.from_pylist(out, pa.schema([
            ("grp", pa.int32()), ("piece", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("copies", pa.binary()),
            ("vecs", pa.binary()), ("radius", pa.binary()), ("widest", pa.float64()), ("low", pa.list_(pa.float64())),
            ("high", pa.list_(pa.float64()))]))
    per = max(1, GROUP * 100 // BLOCK)  # as many blocks as hold some GROUP queries, if one row in a hundred is one
    return _placed(queries, curves, bound, per).groupBy("block").applyInArrow(run, PIECE_SCHEMA)


class Nearest:
    """The ``k`` nearest found so far of a piece's queries, by distance, then id."""

    def __init__(self, queries: np.ndarray, radius: np.ndarray, k: int):
        self.q, self.radius, self.k = queries, radius, k
        self.length = (queries ** 2).sum(axis=1)
        self.who = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.far = np.empty(0, np.float64)

    def meet(self, ids: np.ndarray, vecs: np.ndarray) -> None:
        with np.errstate(all="ignore"):
            length = (vecs ** 2).sum(axis=1)
            square = self.length[:, None] + length - 2 * (self.q @ vecs.T)
            limit = self.radius ** 2
            slack = 1e-9 * (self.length[:, None] + length)
            i, j = np.nonzero(~(square > limit[:, None] + slack))  # what cannot be told stays
            for a in range(0, len(i), 1 << 16):
                self._keep(i[a:a + (1 << 16)], ids[j[a:a + (1 << 16)]], vecs[j[a:a + (1 << 16)]])

    def _keep(self, i: np.ndarray, ids: np.ndarray, vecs: np.ndarray) -> None:
        total = np.zeros(len(i))
        for d in range(vecs.shape[1]):  # in order, so that a plain loop gives the same last digit
            apart = self.q[i, d] - vecs[:, d]
            total += apart * apart
        self.add(i, ids, np.sqrt(total))

    def add(self, who: np.ndarray, ids: np.ndarray, far: np.ndarray) -> None:
        who, ids, far = np.concatenate([self.who, who]), np.concatenate([self.ids, ids]), np.concatenate([self.far, far])
        by = np.lexsort((ids, far, who))
        who = who[by]
        start = np.searchsorted(who, np.arange(len(self.q)))
        nth = np.arange(len(who)) - start[who]
        by, who, nth = by[nth < self.k], who[nth < self.k], nth[nth < self.k]
        self.who, self.ids, self.far = who, ids[by], far[by]
        full = nth == self.k - 1
        self.radius[who[full]] = np.minimum(self.radius[who[full]], self.far[full])

    def packed(self) -> list[bytes]:
        """Ids and distances, ``k`` places a query; unused ones are NaN."""
        nth = np.arange(len(self.who)) - np.searchsorted(self.who, np.arange(len(self.q)))[self.who]
        ids, far = np.zeros((len(self.q), self.k), np.int64), np.full((len(self.q), self.k), np.nan)
        ids[self.who, nth], far[self.who, nth] = self.ids, self.far
        return _pack(ids, far)


def _reaches(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray, radius: float) -> bool:
    with np.errstate(all="ignore"):
        gap = np.maximum(0, np.maximum(low - other_high, other_low - high))
        return not np.sqrt((gap ** 2).sum()) > radius  # a box that is no number reaches everywhere


def tile(blocks: pa.Table, pieces: pa.Table, dim: int, kind, k: int) -> pa.Table:
    """Every piece's nearest among the blocks of a tile."""
    out = []
    for p in pieces.to_pylist():
        best = Nearest(np.frombuffer(p["vecs"], np.float64).reshape(-1, dim), np.frombuffer(p["radius"], np.float64).copy(), k)
        low, high = np.array(p["low"]), np.array(p["high"])
        for b in range(blocks.num_rows):
            box = (np.array(blocks[c][b].as_py()) for c in ("low", "high"))
            if _reaches(low, high, *box, float(best.radius.max())):
                vecs = np.frombuffer(blocks["vecs"][b].as_buffer(), kind).reshape(-1, dim)
                best.meet(np.frombuffer(blocks["ids"][b].as_buffer(), np.int64), vecs.astype(np.float64))
        ids, far = best.packed()
        out.append({"grp": p["grp"], "piece": p["piece"], "ids": ids, "distances": far})
    return pa.Table.from_pylist(out, pa.schema([("grp", pa.int32()), ("piece", pa.int32()), ("ids", pa.binary()),
                                                ("distances", pa.binary())]))


def merge(found: pa.Table, pieces: pa.Table, k: int) -> pa.Table:
    """The k nearest of a piece's queries over all tiles, without the
    query's own row, once for each copy of the query."""
    out = {"query_id": [], "rank": [], "vec_id": [], "score": []}
    for p in pieces.to_pylist():
        n = p["n"]
        best = Nearest(np.zeros((n, 1)), np.full(n, np.inf), k + 1)
        for r in found.to_pylist():
            far = np.frombuffer(r["distances"], np.float64)
            have = ~np.isnan(far)
            best.add(np.repeat(np.arange(n), k + 1)[have], np.frombuffer(r["ids"], np.int64)[have], far[have])
        own = np.frombuffer(p["ids"], np.int64)
        itself = np.flatnonzero((best.ids == own[best.who]) & (best.far == 0))
        itself = itself[np.unique(best.who[itself], return_index=True)[1]]  # one row of it
        who, ids, far = (np.delete(a, itself) for a in (best.who, best.ids, best.far))
        rank = np.arange(len(who)) - np.searchsorted(who, np.arange(n))[who] + 1
        who, ids, far, rank = (a[rank <= k] for a in (who, ids, far, rank))
        times = np.frombuffer(p["copies"], np.int64)[who]
        for name, a in (("query_id", own[who]), ("rank", rank), ("vec_id", ids), ("score", far)):
            out[name].append(np.repeat(a, times))
    types = {"query_id": pa.int64(), "rank": pa.int32(), "vec_id": pa.int64(), "score": pa.float64()}
    return pa.table({c: pa.array(np.concatenate(a) if a else [], types[c]) for c, a in out.items()})


def _gap(a: str, b: str) -> Column:
    """Distance of two boxes."""
    side = (f"zip_with(zip_with({a}_low, {b}_high, (x, y) -> x - y), zip_with({b}_low, {a}_high, (x, y) -> x - y), "
            "(x, y) -> greatest(0D, x, y))")
    return F.expr(f"sqrt(aggregate({side}, 0D, (s, x) -> s + x * x))")


def common_length(vectors: DataFrame, vec_col: str) -> int:
    row = vectors.select(F.size(F.col(f"`{vec_col}`")).alias("n")).where("n > 0").groupBy("n").count().orderBy(
        F.desc("count"), F.desc("n")).first()
    return row.n if row else 0


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest_neighbours(vectors: DataFrame, asks: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
                       dim: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` vectors nearest to each
    row for which ``asks`` (of the column ``id``) holds."""
    spark = vectors.sparkSession
    dim = dim or common_length(vectors, vec_col)
    if not dim:
        return spark.createDataFrame([], RESULT)
    rows = (finite_vectors(vectors, id_col, vec_col, dim).where(F.col("id").isNotNull() & F.exists("vec", lambda x: x != 0))
            .withColumns({"print": F.xxhash64("vec"), "asks": F.coalesce(asks, F.lit(False))}))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    sample = [r.vec for r in rows.orderBy(F.xxhash64("id", "print")).limit(SAMPLE).select("vec").collect()]
    curves = Curves(np.array(sample, np.float64).reshape(-1, dim))
    kind = np.float32 if rows.schema["vec"].dataType.simpleString() == "array<float>" else np.float64
    bounds = block_bounds(key_table(rows, curves), n)

    queries = rows.where("asks").groupBy("id", "print", "vec").agg(F.count(F.lit(1)).alias("copies"))
    queries = queries.join(radii(rows, curves, bounds, k + 1), ["id", "print"])
    pieces = materialise(packed_queries(queries, curves, bounds[0]), "queries")
    blocks = materialise(packed_blocks(rows, curves, bounds[0], k + 1), "blocks")

    # which blocks a group of queries opens: boxes of all blocks against boxes of the stated queries' pieces
    groups = [r.grp for r in pieces.select("grp").distinct().collect()]  # one number for some 16,384 queries
    if not groups:
        return spark.createDataFrame([], RESULT)
    of_block = blocks.select("block", F.col("low").alias("b_low"), F.col("high").alias("b_high"),
                             F.explode(F.array(*map(F.lit, groups))).alias("grp"))
    of_piece = pieces.select("grp", F.col("low").alias("p_low"), F.col("high").alias("p_high"), "widest")
    opened = of_block.join(of_piece, "grp").where((_gap("b", "p") <= F.col("widest")) | F.isnan(_gap("b", "p"))).select("grp", "block").distinct()
    wide = min(STRIP, int(np.ceil(np.sqrt(len(bounds[0]) + 1))))
    strip = F.expr(f"block DIV {wide}").cast("int").alias("strip")
    left = blocks.join(opened, "block").select("grp", strip, "block", "ids", "vecs", "low", "high")
    right = pieces.join(opened.select("grp", strip).distinct(), "grp")
    k1 = k + 1
    found = left.groupBy("grp", "strip").cogroup(right.groupBy("grp", "strip")).applyInArrow(
        lambda b, p: tile(b, p, dim, kind, k1), FOUND_SCHEMA)
    return found.groupBy("grp", "piece").cogroup(pieces.groupBy("grp", "piece")).applyInArrow(
        lambda f, p: merge(f, p, k), RESULT)


def query(vectors: DataFrame) -> DataFrame:
    return nearest_neighbours(vectors, F.col("id") % 100 == 0)


#: By brute force; a vec_id may not repeat.
SQL = f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
             AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
w AS (SELECT * FROM v WHERE len(x) = (SELECT len(embedding) FROM embeddings WHERE len(embedding) > 0
                                      GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)),
pair AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_distance(q.x, c.x) AS score
         FROM w q JOIN w c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER o)::INTEGER AS rank, vec_id, score FROM pair
WINDOW o AS (PARTITION BY query_id ORDER BY score, vec_id) QUALIFY row_number() OVER o <= {K}
"""
