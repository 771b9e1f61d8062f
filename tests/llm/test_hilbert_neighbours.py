import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from driftwood.llm import hilbert_neighbours as H

from .helpers import vectors_of


def brute(rows, every=100, k=H.K):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    if good:
        sizes = Counter(len(v) for _, v in rows if v)
        dim = max(sizes, key=lambda n: (sizes[n], n))
        good = [(i, v) for i, v in good if len(v) == dim]
    out = []
    for a, (i, v) in enumerate(good):
        if i % every == 0:
            far = sorted((math.sqrt(_square(v, w)), j) for b, (j, w) in enumerate(good) if b != a)[:k]
            out += [(i, n + 1, j, d) for n, (d, j) in enumerate(far)]
    return sorted(out)


def _square(v, w):
    total = 0.0
    for a, b in zip(v, w):
        total += (a - b) * (a - b)
    return total


def random_rows(n, dim, seed, single=True):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim))
    v = v.astype(np.float32) if single else v
    return [(i, x) for i, x in enumerate(v.astype(float).tolist())]


def run(df):
    return sorted(map(tuple, H.query(df).collect()))


def test_random_vectors_have_recall_one(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 200)
    monkeypatch.setattr(H, "STRIP", 3)
    monkeypatch.setattr(H, "PIECE", 4)
    rows = random_rows(1500, 64, 1)
    df = vectors_of(spark, rows).repartition(5)
    assert run(df) == brute(rows)
    one = H.nearest_neighbours(df, F.col("id") % 50 == 0, k=3)
    assert sorted(map(tuple, one.collect())) == brute(rows, 50, 3)


def test_clustered_vectors_leave_blocks_closed(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 100)
    rng = random.Random(4)
    rows = [(i, [float(np.float32(10 * (i % 8 == d) + rng.gauss(0, 0.05))) for d in range(16)]) for i in range(1600)]
    met = []
    plain = H.Nearest.meet
    monkeypatch.setattr(H.Nearest, "meet", lambda self, ids, vecs: (met.append(len(ids)), plain(self, ids, vecs)))
    assert run(vectors_of(spark, rows)) == brute(rows)
    # in the driver's process, as a task would: the boxes of other clusters do not reach
    v = np.array([x for _, x in rows])
    curves = H.Curves(v)
    near, far = curves.box_point(v[::8]), curves.box_point(v[1::8])
    assert not H._reaches(near.min(0), near.max(0), far.min(0), far.max(0), 2.0)
    assert H._reaches(near.min(0), near.max(0), far.min(0), far.max(0), float("inf"))


def test_edge_cases(spark):
    rows = random_rows(40, 6, 2)
    a, b = rows[0][1], rows[1][1]
    rows += [(100, None), (200, []), (300, a[:5]), (400, [None, *a[1:]]), (500, [float("nan"), *a[1:]]),
             (600, [float("-inf"), *a[1:]]), (700, [0.0] * 6), (None, a), (0, a), (0, b), (800, a), (800, a), (3, a), (3, a)]
    assert run(vectors_of(spark, rows).repartition(3)) == brute(rows)


def test_many_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 64)
    rows = random_rows(900, 8, 3)
    hot = rows[0][1]
    rows = [(i, hot if i % 3 == 0 else v) for i, v in rows]
    assert run(vectors_of(spark, rows).repartition(4)) == brute(rows)


def test_one_row_repeated_a_third_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 64)
    rows = random_rows(300, 8, 6)
    rows += [rows[100]] * 150
    assert run(vectors_of(spark, rows).repartition(4)) == brute(rows)


def test_small_and_empty_tables(spark):
    for rows in ([], [(0, [1.0, 2.0])], [(1, [1.0, 2.0]), (0, [3.0, 2.0])], [(5, [1.0])], [(0, None)]):
        assert run(vectors_of(spark, rows)) == brute(rows)


def test_doubles_of_any_size(spark):
    rows = random_rows(50, 4, 7, single=False) + [(100, [1e200, 0.0, 0.0, 1.0]), (101, [1e200, 0.0, 0.0, 2.0]), (200, [1e-200, 0.0, 0.0, 0.0]),
                                                          (102, [1e308, -1e308, 1e308, 1e308]), (300, [-1e308] * 4)]
    assert run(vectors_of(spark, rows, "double")) == brute(rows)


def test_hilbert_keys_are_a_walk_through_all_cells():
    bits, dims = 3, 3
    side = np.arange(1 << bits)
    cells = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    key = H.hilbert_key(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()  # neighbouring keys are neighbouring cells


def test_sketch_error_is_proven():
    v = np.random.default_rng(5).standard_normal((200, 64)) * 10.0 ** np.arange(-100, 100)[:, None]
    small, unit, error = H.sketch(v)
    assert (np.sqrt(((small * unit[:, None] - v) ** 2).sum(axis=1)) <= error).all()


def test_windows_alone_have_some_recall(spark):
    """The curves do find neighbours: on vectors of few degrees of freedom
    the merged windows hold most of the nearest ones."""
    rng = np.random.default_rng(9)
    v = rng.standard_normal((3000, 3)) @ rng.standard_normal((3, 32))
    curves = H.Curves(v)
    ids, tie = np.arange(len(v)), H.mix(np.arange(len(v), dtype=np.uint64))
    hits = total = 0
    orders = [np.argsort(curves.keys(v, o, tie)) for o in range(H.ORDERINGS)]
    place = [np.argsort(o) for o in orders]
    for q in ids[::100]:
        near = np.argsort(((v - v[q]) ** 2).sum(axis=1), kind="stable")[1:11]
        seen = set()
        for order, at in zip(orders, place):
            seen |= set(order[max(0, at[q] - H.WINDOW):at[q] + H.WINDOW + 1].tolist())
        hits, total = hits + len(seen & set(near.tolist())), total + 10
    assert hits / total > 0.9
