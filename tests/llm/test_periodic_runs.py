import hashlib
import random
import zlib

import numpy as np

from driftwood.llm import periodic_runs as R

from .helpers import DOCS, by_id, docs_of, edge_docs, empty_docs


def brute_runs(x):
    n, out = len(x), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and not any((s, m) == (i, length) for s, m, _ in out):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows, find=brute_runs):
    out = []
    for i, t in rows:
        words = planted([w.decode() for w in (t or "").encode().split()], i)
        runs = find(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        out.append((i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone))))
    return by_id(out)


def numbered(words):
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return R.find_runs(np.array([number[w] for w in words], np.int64))


def test_find_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        n, k = rng.choice([5, 23, 24, 30, 60, 100, 200, 300]), rng.choice([1, 2, 3, 5, 50])
        x = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randrange(4)):
            a, p, m = rng.randrange(n), rng.choice([1, 2, 3, 4, 6, 7, 8, 9, 12, 15, 16, 17, 20, 31, 32, 33, 50, 66]), rng.randrange(n)
            for i in range(a, min(n, a + m)):
                x[i] = x[a + (i - a) % p]
        assert R.find_runs(np.array(x)) == brute_runs(x)


def test_every_period_at_its_shortest_run():
    for q in range(1, 70):
        for shift in range(9):
            n = max(24, 3 * q)
            x = [1000 + k for k in range(shift)] + [k % q for k in range(n)] + [2000 + k for k in range(5)]
            assert R.find_runs(np.array(x)) == [(shift, n, q)] == brute_runs(x)
            short = x[:shift] + x[shift:shift + n - 1] + x[shift + n:]
            assert R.find_runs(np.array(short)) == brute_runs(short) == []


def test_long_texts_are_quick():
    assert R.find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    assert R.find_runs(np.arange(300_000) % 100_000) == [(0, 300_000, 100_000)]
    assert R.find_runs(np.arange(300_000)) == []


def test_convolution_is_exact():
    rng = np.random.default_rng(3)
    for b, lags in ((8, 15), (16, 16), (64, 64), (256, 256)):
        fold = int(((R.PRIME - 1) // b) ** 0.5)
        x, y = rng.integers(0, fold, (5, b)).astype(np.uint64), rng.integers(0, fold, (5, b + lags - 1)).astype(np.uint64)
        x[0], y[0] = fold - 1, 0  # the largest sums there can be
        want = np.array([[((x[m].astype(int) - y[m, t:t + b].astype(int)) ** 2).sum() for t in range(lags)] for m in range(5)])
        assert (R.squared_differences(x, y) == want).all()
    a = rng.integers(0, R.PRIME, (3, 128)).astype(np.uint64)
    assert (R.inverse(R.transform(a)) == a).all()


def test_edge_cases(spark):
    rows = [(i, t) for i, t in DOCS if t is None or len(t) < 10_000]
    df = edge_docs(spark).where("text IS NULL OR length(text) < 10000")
    assert by_id(map(tuple, R.query(df).collect())) == brute(rows)
    long_rows = [(i, t) for i, t in DOCS if t is not None and len(t) >= 10_000]
    got = by_id(map(tuple, R.query(docs_of(spark, long_rows)).collect()))
    assert got == brute(long_rows, numbered)
    assert R.query(empty_docs(spark)).count() == 0


def test_planted_runs_ties_and_repeats(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        words = [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randrange(1, 160))]
        if i % 4 == 0:  # two runs of the same exponent, one inside other words
            words = ["p", "q"] * 15 + words + ["r", "s"] * 15
        rows.append((i, "\t".join(words) if i % 2 else " \n ".join(words)))
    rows += [rows[0], rows[7], (7, "a " * 400), (8, "é é " * 40), (9, "  　x " * 30)]
    assert by_id(map(tuple, R.query(docs_of(spark, rows).repartition(4)).collect())) == brute(rows)


def test_operator_without_the_planted_rule(spark):
    row = R.collapse_runs(docs_of(spark, [(1, "go " + "tick tock " * 20 + "stop")])).first()
    assert [tuple(r) for r in row.runs] == [(1, 40, 2)] and row.collapsed == "go tick tock stop" and row.n_words == 42
