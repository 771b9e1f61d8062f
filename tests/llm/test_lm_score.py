import math
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from driftwood.llm import lm_score as L
from driftwood.llm.common import fold_bytes

from .helpers import DOCS, docs_of, edge_docs, empty_docs


def held(i):
    return zlib.crc32((b"" if i is None else str(i).encode())) % 7 == 2


def brute(rows, depth):
    """Context-tree weighting with dictionaries, node by node."""
    counts = defaultdict(lambda: [0, 0])
    kids = defaultdict(set)
    texts = [(i, fold_bytes((t or "").encode())) for i, t in rows]

    def steps(t):
        s = b"\0" * depth + t + b"\0"
        for k in range(depth, len(s)):
            ctx = s[k - depth:k][::-1]
            for b in range(8):
                yield ctx, (b, s[k] >> (8 - b)), s[k] >> (7 - b) & 1

    for i, t in texts:
        if not held(i):
            for ctx, node, bit in steps(t):
                for d in range(depth + 1):
                    counts[ctx[:d], node][bit] += 1
                    if d:
                        kids[ctx[:d - 1], node].add(ctx[:d])
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def weight(ctx, node):
        own = kt(*counts[ctx, node])
        if len(ctx) == depth:
            return own
        return float(np.logaddexp(own, sum(weight(c, node) for c in kids[ctx, node]))) - math.log(2)

    def p_one(ctx, node, d):
        a, b = counts.get((ctx[:d], node), (0, 0))
        own = (b + .5) / (a + b + 1)
        if d == depth or (ctx[:d + 1], node) not in counts:
            return own
        stay = math.exp(kt(a, b) - math.log(2) - weight(ctx[:d], node))
        return stay * own + (1 - stay) * p_one(ctx, node, d + 1)

    return [sum(math.log10(p if bit else 1 - p) for ctx, node, bit in steps(t) for p in [p_one(ctx, node, 0)]) for _, t in texts]


def base(rows):
    c = Counter()
    toks = [(i, fold_bytes((t or "").encode()).split()) for i, t in rows]
    for i, w in toks:
        if not held(i):
            c.update(w)
            c[None] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for i, w in toks:
        w = [*w, None]
        out.append((i, held(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return out


SMALL = [r for r in DOCS if len(r[1] or "") < 2000]


@pytest.mark.parametrize("depth", [2, 3, 4])
def test_equals_brute_force(spark, depth):
    got = sorted(((r.id, r.n_tokens, round(r.score, 3)) for r in L.score(docs_of(spark, SMALL).repartition(3), depth).collect()), key=str)
    want = sorted(((i, b[2], round(s, 3)) for (i, _), b, s in zip(SMALL, base(SMALL), brute(SMALL, depth), strict=True)), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-5, atol=2e-3)


def test_base_and_edge_cases(spark):
    got = sorted((tuple(r)[:6] for r in L.query(edge_docs(spark)).collect()), key=lambda r: str(r[:5]))
    want = sorted(base(DOCS), key=lambda r: str(r[:5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert L.query(empty_docs(spark)).count() == 0
    only_held = [(i, "some text") for i in range(200) if held(i)]
    rows = L.query(docs_of(spark, only_held)).collect()
    assert {r.train_tokens for r in rows} == {0} and np.allclose([r.score for r in rows], -80 * math.log10(2))


def test_bytes_sum_to_one():
    """After any context the probabilities of the 256 bytes add up to one."""
    texts = [fold_bytes((t or "").encode()) for _, t in SMALL]
    train = np.concatenate([L.byte_strings(t, 3) for t in texts])
    for ctx in (b"the", b"zzz", b"\0\0\0"):
        asked = np.array([ctx[2] << 24 | ctx[1] << 16 | ctx[0] << 8 | b for b in range(256)], np.uint64)
        keys, counts = L._count(np.concatenate((train, asked)), train)
        rows = []
        for bit in range(8):
            deep = L.subtree(keys, counts.astype(float), 3, 2, bit)[-1]
            up, at = np.unique(deep.key >> np.uint64(16) << np.uint64(8) | deep.key & np.uint64(255), return_inverse=True)
            rows += [dict(zip(("node", "n0", "n1", "below"), x, strict=True)) for x in zip(
                up.astype(int), *[np.bincount(at, weights=w) for w in (deep.n0, deep.n1, deep.log_p)], strict=True)]
        logs = L.string_log10(keys, counts.astype(float), 3, L.weigh_top(rows))
        assert abs((10 ** logs[np.searchsorted(keys, asked)]).sum() - 1) < 1e-9


def test_log_gamma():
    n = np.array([0, 1, 2, 500, 511, 512, 513, 10_000, 1e9])
    assert np.allclose(L._lgamma_half(n), [math.lgamma(x + .5) for x in n], rtol=1e-12)
    assert np.allclose(L._lgamma_whole(n), [math.lgamma(x + 1) for x in n], rtol=1e-12)
