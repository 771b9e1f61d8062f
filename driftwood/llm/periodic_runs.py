"""Periodic runs of words, by block convolution.

A run is a stretch of words with smallest period q, at least ``MIN_WORDS``
and three periods long, that no neighbouring word extends.  At each dyadic
scale B (8, 16, 32, ...) a text's word numbers are cut into blocks of B.  A
run whose period the scale answers for (1 to 15 at B = 8, else B to 2B - 1)
is long enough to hold a whole aligned block and the same block one period
on.  The block's squared differences from all places of the following window
are one convolution, taken by a number-theoretic transform whose modulus
exceeds any possible sum, so they are exact; a zero is a repetition at that
distance.  Word numbers are folded so far that the sums stay below the
modulus, and the extension of a seed compares the true numbers, so folding
can add false seeds but lose none.  Blocks in which some word does not come
again within the scale's distance have no zero and are not transformed.

Seeds are taken by scale and rising distance and extended word by word to
the largest stretch with that distance.  Seeds inside a stretch already found
whose period divides their distance lead to the same stretch and are passed
over; so what is left has its distance as smallest period.

One map pass, a document at a time, with memory in proportion to the longest
text; no shuffle.

Defined results: words are maximal runs without white space, unchanged; a
null, empty or blank text has no words and no runs; rows with the same id
are separate documents; empty tables work; further columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text

MIN_WORDS = 24
REPEATS = 3
FIRST_BLOCK = 8
#: A prime with a primitive root 3 and roots of unity of every order up to 2**23.
PRIME = 998244353
ROOT = 3
#: Numbers transformed at a time.
SLAB = 1 << 18

RUN_TYPE = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"id long, n_words long, runs array<{RUN_TYPE}>, collapsed string"
Run = tuple[int, int, int]


# ---- transform -----------------------------------------------------------

@functools.lru_cache(maxsize=64)
def _powers(size: int, inverse: bool) -> np.ndarray:
    """The first ``size / 2`` powers of a primitive root of unity of order ``size``."""
    step = pow(ROOT, (PRIME - 1) // size, PRIME)
    step = pow(step, -1, PRIME) if inverse else step
    out = np.ones(max(1, size // 2), np.uint64)
    have = 1
    while have < len(out):  # doubles what is there
        out[have:2 * have] = out[:have] * np.uint64(pow(step, have, PRIME)) % np.uint64(PRIME)
        have *= 2
    return out


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    s = a + b
    return np.minimum(s, s - np.uint64(PRIME))  # a negative difference wraps to a huge number


def transform(a: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every row (a power of two long), in
    bit-reversed order."""
    m, size = a.shape
    h = size // 2
    while h:
        v = a.reshape(m, size // (2 * h), 2, h)
        low, high = v[:, :, 0], v[:, :, 1]
        out = np.empty_like(v)
        out[:, :, 0] = _plus(low, high)
        out[:, :, 1] = _plus(low, np.uint64(PRIME) - high) * _powers(2 * h, False) % np.uint64(PRIME)
        a, h = out.reshape(m, size), h // 2
    return a


def inverse(a: np.ndarray) -> np.ndarray:
    """Undoes ``transform``."""
    m, size = a.shape
    h = 1
    while h < size:
        v = a.reshape(m, size // (2 * h), 2, h)
        low, high = v[:, :, 0], v[:, :, 1] * _powers(2 * h, True) % np.uint64(PRIME)
        out = np.empty_like(v)
        out[:, :, 0], out[:, :, 1] = _plus(low, high), _plus(low, np.uint64(PRIME) - high)
        a, h = out.reshape(m, size), h * 2
    return a * np.uint64(pow(size, -1, PRIME)) % np.uint64(PRIME)


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For every row, the sums of squared differences of the block from the
    window's words beginning at each place: exact as long as they stay below
    the modulus."""
    m, b = blocks.shape
    lags = windows.shape[1] - b + 1
    size = 1 << max(1, int(windows.shape[1] - 1).bit_length())
    x, y = np.zeros((m, size), np.uint64), np.zeros((m, size), np.uint64)
    x[:, :b], y[:, :windows.shape[1]] = blocks[:, ::-1], windows
    cross = inverse(transform(x) * transform(y) % np.uint64(PRIME))[:, b - 1:b - 1 + lags].astype(np.int64)
    squares = np.concatenate([np.zeros((m, 1), np.int64), np.cumsum(windows.astype(np.int64) ** 2, axis=1)], axis=1)
    return (blocks.astype(np.int64) ** 2).sum(axis=1)[:, None] + squares[:, b:] - squares[:, :lags] - 2 * cross


# ---- seeds ---------------------------------------------------------------

def next_distance(x: np.ndarray) -> np.ndarray:
    """Distance of every word to the next same word (a huge number if none)."""
    out = np.full(len(x), np.iinfo(np.int64).max)
    by = np.argsort(x, kind="stable")
    same = x[by[1:]] == x[by[:-1]]
    out[by[:-1][same]] = np.diff(by)[same]
    return out


def candidate_blocks(x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """For every scale: block length, least distance, and the numbers of the
    blocks all of whose words come again within the scale's distances."""
    n, size = len(x), FIRST_BLOCK
    far = next_distance(x)[:n // size * size].reshape(-1, size).max(axis=1)
    while len(far):
        least = 1 if size == FIRST_BLOCK else size
        if REPEATS * least > n:
            return
        fits = np.arange(len(far)) * size + size + least <= n
        yield size, least, np.flatnonzero((far < 2 * size) & fits)
        far = far[:len(far) // 2 * 2].reshape(-1, 2).max(axis=1)
        size *= 2


def seeds(x: np.ndarray, size: int, least: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and distance of every block's occurrences in its window, by
    start and rising distance."""
    n, lags = len(x), 2 * size - least
    fold = np.uint64(int(((PRIME - 1) // size) ** 0.5))
    codes = np.zeros(n + 3 * size, np.uint64)
    codes[:n] = (x.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % fold
    found_at, found_q = [], []
    step = max(1, SLAB // (4 * size))
    for a in range(0, len(blocks), step):
        start = blocks[a:a + step] * size
        sums = squared_differences(codes[start[:, None] + np.arange(size)],
                                   codes[start[:, None] + np.arange(least, least + lags + size - 1)])
        row, lag = np.nonzero(sums == 0)
        q = lag + least
        inside = (start[row] + q + size <= n) & (REPEATS * q <= n)
        found_at.append(start[row[inside]])
        found_q.append(q[inside])
    return np.concatenate(found_at), np.concatenate(found_q)


def extend(x: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The largest stretch ``[s, e)`` around ``at`` whose words q apart are the same."""
    n, to, step = len(x), at, 64
    while to < n - q:
        stop = min(to + step, n - q)
        differ = np.flatnonzero(x[to:stop] != x[to + q:stop + q])
        if len(differ):
            to += int(differ[0])
            break
        to, step = stop, min(2 * step, 1 << 16)
    s, step = at, 64
    while s > 0:
        stop = max(0, s - step)
        differ = np.flatnonzero(x[stop:s] != x[stop + q:s + q])
        if len(differ):
            s = stop + int(differ[-1]) + 1
            break
        s, step = stop, min(2 * step, 1 << 16)
    return s, to + q


def find_runs(x: np.ndarray) -> list[Run]:
    """``(start, length, period)`` of every run of the word numbers ``x``, by
    start, then period."""
    if len(x) < MIN_WORDS:
        return []
    stretches: list[Run] = []
    runs: list[Run] = []
    for size, least, blocks in candidate_blocks(x):
        if not len(blocks):
            continue
        at, q = seeds(x, size, least, blocks)
        open_ = np.ones(len(at), bool)

        def close(s: int, e: int, period: int) -> None:
            a, b = np.searchsorted(at, [s, e])
            open_[a:b] &= ~((q[a:b] % period == 0) & (at[a:b] + size + q[a:b] <= e))
        for s, e, period in stretches:
            close(s, e, period)
        order = np.lexsort((at, q))
        bounds = np.searchsorted(q[order], np.unique(q)).tolist() + [len(order)]
        for a, b in zip(bounds, bounds[1:]):
            group = order[a:b]
            for i in group[open_[group]].tolist():
                if not open_[i]:
                    continue
                period = int(q[i])
                s, e = extend(x, int(at[i]), period)
                if e - s < size + period:  # folded numbers met by chance
                    continue
                stretches.append((s, e, period))
                close(s, e, period)
                if e - s >= max(MIN_WORDS, REPEATS * period):
                    runs.append((s, e - s, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


# ---- documents -----------------------------------------------------------

def repeat_tail(n: int, doc_id: int | None) -> np.ndarray | None:
    """Places of the original words in a text of ``n`` words whose tail is
    made periodic for one id in ten: the test rule of the registered query."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def runs_of_text(text: str, places: Callable[[int], np.ndarray | None]) -> tuple[int, list[Run], str]:
    """Number of words, runs, and the words that no run's repetitions hold,
    joined by one space."""
    words = text.encode("utf-8", "surrogatepass").split()
    at = places(len(words))
    if at is not None:
        words = [words[i] for i in at.tolist()]
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    runs = find_runs(np.fromiter(map(number.__getitem__, words), np.int64, len(words))) if len(words) >= MIN_WORDS else []
    if runs:
        cover = np.zeros(len(words) + 1, np.int64)
        for s, length, period in runs:
            cover[s + period] += 1
            cover[s + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()]
        return len(cover) - 1, runs, b" ".join(words).decode("utf-8", "replace")
    return len(words), runs, b" ".join(words).decode("utf-8", "replace")


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """``id, n_words, runs, collapsed`` of every document; with ``planted``
    of the texts that ``repeat_tail`` makes of them."""
    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_pylist()
            made = [runs_of_text(t.as_py(), (lambda n, i=i: repeat_tail(n, i)) if planted else lambda n: None)
                    for i, t in zip(ids, batch.column("text"), strict=True)]
            runs = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for _, r, _ in made],
                            pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([n for n, _, _ in made], pa.int64()), runs,
                                              pa.array([t for _, _, t in made], pa.string())],
                                             ["id", "n_words", "runs", "collapsed"])
    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def query(docs: DataFrame) -> DataFrame:
    # of two runs the greater length / period, compared as products; ties keep the earlier one
    best = F.reduce("runs", F.lit(None).cast(RUN_TYPE), lambda m, r: F.when(
        m.isNotNull() & (r["length"] * m["period"] <= m["length"] * r["period"]), m).otherwise(r))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return collapse_runs(docs, planted=True).withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, w, len(w) AS n, xor(list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                   lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) AS h
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
rule AS (SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS planted, (h // 10) % greatest(n, 1) AS a, h // 10 AS g FROM d),
made AS (SELECT doc_id, w, n, planted, a, 1 + (n - a) // (3 + g % 8) AS p FROM rule),
word AS MATERIALIZED (
  SELECT doc_id, n, i, CASE WHEN planted AND i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS x
  FROM (SELECT *, unnest(range(n)) AS i FROM made)),
match AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM word l JOIN word r ON l.doc_id = r.doc_id AND l.x = r.x
          WHERE r.i > l.i AND {REPEATS} * (r.i - l.i) <= l.n),
island AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM match),
stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM island GROUP BY doc_id, q, k
            HAVING count(*) + q >= greatest({MIN_WORDS}, {REPEATS} * q)),
run AS MATERIALIZED (SELECT doc_id, s, len, min(q) AS q FROM stretch GROUP BY doc_id, s, len),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t
           FROM run GROUP BY doc_id),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len::DOUBLE / q DESC, s, q) = 1)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.len::BIGINT AS length,
       best.q::BIGINT AS period, (1000 * best.len // best.q)::BIGINT AS exponent_milli,
       sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
