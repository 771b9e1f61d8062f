"""Centroid clustering by progressive search over Walsh-Hadamard coefficients.

Components become integers ``floor(256 * x)``.  The Hadamard transform of a
64-component vector is an exact integer map that keeps squared distances up
to the factor 64, so a sum of squared differences over some of the
coefficients never exceeds the whole.  A task transforms its vectors and the
centroids, adds up coefficient differences from coarse (the first ones) to
fine, takes the full distance to the centroid that looks best as an upper
bound, and drops the centroids whose partial sum is strictly larger; what is
left is finished over all 64 coefficients.  Ties stay to the end and go to
the smaller number, so the result is that of a full search.

A round is one map pass that adds up its vectors a centroid in the task, and
one aggregate of ``k`` rows a component and task; only the ``k`` centroids
meet the driver.  Sums are exact, their floored quotients are taken there.

Defined results: vectors of another length, null, or with a null or
non-finite component take no part (no row); null ids are kept and sort as an
empty text when the first centroids are chosen; of rows with the same id the
smaller vector comes first; fewer rows than ``k`` give fewer centroids; an
empty table gives an empty result; further columns are not read.  Integers
beyond 2**24 take a slower exact path; a distance or sum that no long can
hold is null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .dense import finite_vectors, matrix

DIM = 64
K = 40
ROUNDS = 5
SCALE = 256
SEED_SALT = "2:"
#: Up to this size of an integer, 64 * distance fits 64 bits.
SMALL = 1 << 24
SLAB = 2048
LIMB = 10 ** 18
LEVELS = (8, 16, 32, 64)


def to_integers(vectors: np.ndarray) -> np.ndarray:
    """``floor(256 * x)``: 64-bit integers, or Python's where these could overflow."""
    whole = np.floor(vectors * float(SCALE))
    if not len(whole) or np.abs(whole).max() <= SMALL:
        return whole.astype(np.int64)
    return np.array([[int(SCALE * x // 1) if abs(x) < 2.0 ** 900 else int(x) * SCALE for x in row]
                     for row in vectors.tolist()], dtype=object).reshape(vectors.shape)


def hadamard(a: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of every row (a length that is a power of two)."""
    n, dim = a.shape
    a, h = a.copy(), 1
    while h < dim:
        pairs = a.reshape(n, dim // (2 * h), 2, h)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0], pairs[:, :, 1] = low + high, low - high
        h *= 2
    return a


def _search(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest row of ``c`` (coefficients) of each row of ``x`` and the sum
    of squared differences of all coefficients."""
    def full(number: np.ndarray) -> np.ndarray:
        return ((x - c[number]) ** 2).sum(axis=1)

    first = LEVELS[0]
    partial = ((x[:, None, :first] - c[None, :, :first]) ** 2).sum(axis=2)
    bound = full(partial.argmin(axis=1))
    row, cand = np.nonzero(partial <= bound[:, None])
    part = partial[row, cand]
    for start, stop in zip(LEVELS, LEVELS[1:]):
        part = part + ((x[row, start:stop] - c[cand, start:stop]) ** 2).sum(axis=1)
        begin = np.searchsorted(row, np.arange(len(x)))
        least = np.minimum.reduceat(part, begin)  # every row has a candidate: the bound's own
        if stop == DIM:
            hit = np.flatnonzero(part == least[row])
            _, at = np.unique(row[hit], return_index=True)
            return cand[hit[at]], least
        best = np.flatnonzero(part == least[row])
        _, at = np.unique(row[best], return_index=True)
        bound = np.minimum(bound, full(cand[best[at]]))
        keep = part <= bound[row]
        row, cand, part = row[keep], cand[keep], part[keep]
    raise AssertionError("unreachable")


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and the squared distance to it, of
    integer vectors of 64 components; ties go to the smaller number."""
    if vectors.dtype == object or centroids.dtype == object:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    c = hadamard(centroids)
    number, total = np.empty(len(vectors), np.int64), np.empty(len(vectors), vectors.dtype)
    for at in range(0, len(vectors), SLAB):
        number[at:at + SLAB], total[at:at + SLAB] = _search(hadamard(vectors[at:at + SLAB]), c)
    return number, total // DIM


def _centroid_array(centroids: list[list[int]]) -> np.ndarray:
    small = all(abs(v) <= SMALL for c in centroids for v in c)
    return np.array(centroids, dtype=np.int64 if small else object).reshape(len(centroids), DIM)


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors whose ``salt`` and id hash lowest; at most ``k`` rows
    come to the driver."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(key, "vec").limit(k).select("vec").collect()
    return to_integers(np.array([r.vec for r in rows], np.float64).reshape(len(rows), DIM)).tolist()


def limbs(total: int) -> list[int]:
    """Signed digits of ``total`` in base 10**18, lowest first."""
    sign, rest, out = (-1 if total < 0 else 1), abs(total), []
    while rest or not out:
        rest, digit = divmod(rest, LIMB)
        out.append(sign * digit)
    return out


def cluster_sums(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``cluster, pos, limb, total, n``: the sum of component ``pos`` over the
    vectors nearest to each centroid, by digits, and their number."""
    def run(batches):
        c = _centroid_array(centroids)
        total, count = np.zeros(c.shape, object), np.zeros(len(c), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = to_integers(matrix(batch, DIM))
            number, _ = nearest(v, c)
            for k in np.unique(number).tolist():
                total[k] += v[number == k].sum(axis=0).astype(object)
                count[k] += int((number == k).sum())
        for k in np.flatnonzero(count).tolist():
            rows = [(pos, limb, digit) for pos in range(DIM) for limb, digit in enumerate(limbs(int(total[k, pos])))]
            pos, limb, digit = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(rows), pa.int32()), pa.array(pos, pa.int32()), pa.array(limb, pa.int32()),
                 pa.array(digit, pa.int64()), pa.array([int(count[k])] * len(rows), pa.int64())],
                ["cluster", "pos", "limb", "total", "n"])
    sums = vectors.mapInArrow(run, "cluster int, pos int, limb int, total long, n long")
    return sums.groupBy("cluster", "pos", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                      F.sum("n").alias("n"))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floored means, empty ones as before."""
    sums: dict[int, list[int]] = {}
    counts: dict[int, int] = {}
    for r in cluster_sums(vectors, centroids).collect():  # 64 rows a centroid, more only beyond 10**18
        sums.setdefault(r.cluster, [0] * DIM)[r.pos] += int(r.total) * LIMB ** r.limb
        if r.limb == 0:
            counts[r.cluster] = r.n
    return [[t // counts[k] for t in sums[k]] if k in sums else list(c) for k, c in enumerate(centroids)]


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``id, cluster, distance`` of every vector."""
    def run(batches):
        c = _centroid_array(centroids)
        for batch in batches:
            if batch.num_rows:
                number, d = nearest(to_integers(matrix(batch, DIM)), c)
                if d.dtype == object:
                    d = [x if x < 1 << 63 else None for x in d.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(number, pa.int32()), pa.array(d, pa.int64())],
                                                 ["id", "cluster", "distance"])
    return vectors.mapInArrow(run, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
            salt: str = SEED_SALT) -> tuple[DataFrame, list[list[int]]]:
    """``id, cluster, distance`` of every vector and the final centroids."""
    kept = materialise(finite_vectors(vectors, id_col, vec_col, DIM), "vectors")
    centroids = first_centroids(kept, k, salt)
    for _ in range(rounds):
        centroids = moved(kept, centroids)
    return materialise(assigned(kept, centroids), "assigned"), centroids


def query(vectors: DataFrame) -> DataFrame:
    rows, centroids = cluster(vectors)
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(whole.alias("total")).collect()}  # at most k rows

    def long_or_null(values: list) -> int | None:
        total = None if None in values else sum(map(int, values))
        return None if total is None or total >= 1 << 63 else total
    inertia = long_or_null(list(sums.values()))
    facts = vectors.sparkSession.createDataFrame(
        [(n, long_or_null([sums[n]]), inertia, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for n, c in enumerate(centroids) if n in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    distance = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    ctes = [f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS cluster, v AS c
  FROM (SELECT v, sha256('{SEED_SALT}' || vec_id::VARCHAR) AS h FROM kept) QUALIFY row_number() OVER (ORDER BY h) <= {K})"""]
    for r in range(ROUNDS + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, cluster, distance FROM (
    SELECT vec_id, v, cluster, {distance} AS distance FROM kept, c{r})
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if r < ROUNDS:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT cluster, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END::BIGINT ORDER BY pos) AS c
    FROM (SELECT cluster, pos, sum(x) AS s, count(*) AS n
          FROM (SELECT cluster, unnest(range({DIM})) AS pos, unnest(v) AS x FROM a{r}) GROUP BY cluster, pos)
    GROUP BY cluster) m USING (cluster))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, a.cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)"""


#: By brute force; a vec_id may not repeat.
SQL = _sql()
