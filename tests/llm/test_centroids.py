import hashlib
import math
import random

import numpy as np
import pytest

from driftwood.llm import centroids as C

from .helpers import by_id, vectors_of


def brute(rows, k=C.K, rounds=C.ROUNDS):
    kept = [(i, [math.floor(256 * x) if abs(x) < 1e15 else int(x) * 256 for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in seeds[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for n in range(len(cents)):
            mine = [v for (_, v), (_, m) in zip(kept, near) if m == n]
            if mine:
                cents[n] = [sum(col) // len(mine) for col in zip(*mine)]
    near = assign()

    def fits(x):
        return x if x is not None and x < 1 << 63 else None

    def total(ds):
        return fits(None if any(fits(d) is None for d in ds) else sum(ds))
    every = total([d for d, _ in near])
    return by_id((i, n, fits(d), total([e for e, m in near if m == n]), every,
                  hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, near))


def random_rows(n, seed, spread=1.0):
    rng = random.Random(seed)
    mid = [[rng.gauss(0, spread) for _ in range(64)] for _ in range(7)]
    return [(i, [float(np.float32(m + rng.gauss(0, 0.3))) for m in mid[i % 7]]) for i in range(n)]


def odd_rows():
    rows = random_rows(90, 3)
    a, b = rows[0][1], rows[1][1]
    return rows + [(100, None), (101, []), (102, a[:63]), (103, a + [1.0]), (104, [None, *a[1:]]), (105, [float("nan"), *a[1:]]),
                   (106, [float("inf"), *a[1:]]), (0, a), (7, a), (200, a), (None, a), (None, b), (201, [0.0] * 64),
                   (202, [-1e-9] + [0.0] * 63), (1, a)]


def test_edge_cases(spark):
    rows = odd_rows()
    df = C.query(vectors_of(spark, rows).repartition(3))
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert by_id(map(tuple, df.collect())) == brute(rows)


def test_ties_go_to_the_smaller_centroid(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(120)]  # fewer different vectors than centroids
    got = by_id(map(tuple, C.query(vectors_of(spark, rows)).collect()))
    assert got == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    rows = random_rows(n, 5)
    assert by_id(map(tuple, C.query(vectors_of(spark, rows)).collect())) == brute(rows)


def test_doubles_and_very_large_components(spark):
    rows = random_rows(45, 8) + [(100, [1e9] * 64), (101, [-1e25] * 64), (102, [3e6, *[0.1] * 63]), (103, [1e300] * 64)]
    assert by_id(map(tuple, C.query(vectors_of(spark, rows, "double")).collect())) == brute(rows)


def test_transform_keeps_distances_up_to_64():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-10**7, 10**7, (2, 50, 64))
    assert (((C.hadamard(a) - C.hadamard(b)) ** 2).sum(axis=1) == 64 * ((a - b) ** 2).sum(axis=1)).all()
    assert (C.hadamard(C.hadamard(a)) == 64 * a).all()


def test_progressive_search_is_a_full_search():
    rng = np.random.default_rng(2)
    for spread in (1, 3, 300):
        x, c = rng.integers(-spread, spread + 1, (5000, 64)), rng.integers(-spread, spread + 1, (40, 64))
        c[7], c[20] = c[3], x[11]
        number, d = C.nearest(x, c)
        every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (number == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()
        slow = C.nearest(x[:50].astype(object), c.astype(object))
        assert (slow[0] == number[:50]).all() and (slow[1] == d[:50]).all()


def test_limbs():
    for t in (0, 1, -1, 10**18, -10**18 + 1, 7 * 10**40 + 3, -(7 * 10**40 + 3)):
        assert sum(d * 10**(18 * k) for k, d in enumerate(C.limbs(t))) == t
