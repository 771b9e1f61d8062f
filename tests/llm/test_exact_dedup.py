import hashlib
from collections import defaultdict

from driftwood.llm import exact_dedup as X

from .helpers import DOCS, by_id, docs_of, edge_docs, empty_docs


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return by_id(out)


def test_edge_cases(spark):
    assert by_id(map(tuple, X.query(edge_docs(spark)).collect())) == brute(DOCS)
    assert X.query(empty_docs(spark)).count() == 0


def test_heavy_and_light_digests_agree(spark):
    rows = [(i, "hot" if i % 3 else f"t{i % 50}") for i in range(3000)]
    assert by_id(map(tuple, X.query(docs_of(spark, rows)).collect())) == brute(rows)


def test_heavy_candidates_are_bounded(spark):
    rows = [(i, f"t{i % 7}") for i in range(700)] + [(1000 + i, f"u{i}") for i in range(300)]
    digests = docs_of(spark, rows).select(X.text_digest("text").alias("digest"))
    assert X.heavy_candidates(digests, max_heavy=5).count() <= 5
    assert X.heavy_candidates(digests, min_share=0.05).count() == 7


def test_keep_exact_keeps_all_columns(spark):
    df = edge_docs(spark)
    kept = X.keep_exact(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    want = [i for i, _, _, keep, _ in brute(DOCS) if keep]
    assert by_id((i,) for i in ids) == by_id((i,) for i in want)


def test_keep_exact_by_broadcast_and_by_shuffle_agree(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 50}") for i in range(600)] + [(None, "hot"), (None, "alone"), (599, "t49"), (7, None)]
    df = docs_of(spark, rows).repartition(3)
    largest = lambda t: max((x for x, u in rows if (u or "") == (t or "") and x is not None), default=None)
    want = by_id({(i, t) for i, t in rows if i == largest(t)})
    for heavy, bound in ((1024, 1 << 19), (1, 1 << 19), (1, 0)):
        kept = X.keep_exact(df, max_heavy=heavy, bound=bound)
        assert by_id({(r.doc_id, r.text) for r in kept.collect()}) == want


def test_keep_exact_shuffles_no_texts(spark):
    plan = X.keep_exact(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan


def test_no_python_in_the_plan(spark):
    plan = X.query(edge_docs(spark))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
