import hashlib

from pyspark.sql import functions as F

from driftwood.llm import decontaminate as D

from .helpers import DOCS, LOREM, by_id, docs_of, edge_docs, empty_docs

ITEMS = [(1, " ".join(LOREM[3:20])), (2, "four WORDS; here"), (3, None), (4, "!!!"), (5, " ".join(LOREM[3:20])), (6, "x"),
         (7, "the the"), (10, " ".join(LOREM[-10:])), (11, " ".join(LOREM[-11:-1]) + " zebra")]


def bench_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("id", F.lit("x"))


def brute(rows, items, window=10):
    pats = {}
    for i, t in items:
        w = D.words_of(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1):
            if m:
                pats.setdefault(tuple(w[k:k + m]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = D.words_of(t), set(), set()
        for m in {len(p) for p in pats}:
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in pats:
                    hit.update(range(k, k + m))
                    found |= pats[tuple(w[k:k + m])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return by_id(out)


def test_words():
    assert D.words_of("A-b É9_中文\tÄ") == [b"a", b"b", "É9".encode(), "中文".encode(), "Ä".encode()]
    assert D.words_of(None) == []


def test_edge_cases(spark):
    got = D.query(edge_docs(spark), bench_of(spark, ITEMS)).collect()
    assert by_id(map(tuple, got)) == brute(DOCS, ITEMS)
    assert D.query(empty_docs(spark), bench_of(spark, ITEMS)).count() == 0
    assert not D.query(edge_docs(spark), bench_of(spark, [])).where("contaminated").count()


def test_several_blocks_give_the_same(spark):
    one = D.find_windows(edge_docs(spark), bench_of(spark, ITEMS)).select("id", "n_words", "hits", "items")
    many = D.find_windows(edge_docs(spark), bench_of(spark, ITEMS), block_words=12).select("id", "n_words", "hits", "items")
    assert by_id(tuple(map(str, r)) for r in one.collect()) == by_id(tuple(map(str, r)) for r in many.collect())


def test_items_without_an_id_hit_and_are_not_counted(spark):
    items = [(None, "alpha beta gamma"), (None, "delta"), (None, None), (7, "delta"), (8, "eps zeta")]
    rows = [(1, "an alpha beta gamma here"), (2, "some delta"), (3, "eps zeta alpha beta gamma"), (4, "clean"), (5, None)]
    want = [(1, 3, []), (2, 1, ["7"]), (3, 5, ["8"]), (4, 0, []), (5, 0, [])]
    got = D.query(docs_of(spark, rows), bench_of(spark, items)).collect()
    assert by_id((r.doc_id, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == by_id(
        (i, n, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), n > 0) for i, n, x in want)
    for words in (D.BLOCK_WORDS, 3):
        found = D.find_windows(docs_of(spark, rows), bench_of(spark, items), block_words=words).collect()
        assert by_id((r.id, len(r.hits), r["items"]) for r in found) == by_id(want)
        kept = D.drop_contaminated(docs_of(spark, rows), bench_of(spark, items), block_words=words).collect()
        assert sorted(r.doc_id for r in kept) == [4, 5]


def test_long_items_are_cut_with_overlap(spark):
    item = [(1, " ".join(f"w{k}" for k in range(100)))]
    docs = [(k, " ".join(f"w{j}" for j in range(k, k + 10))) for k in range(91)]
    got = D.find_windows(docs_of(spark, docs), bench_of(spark, item), block_words=17)
    assert got.where(F.size("hits") == 10).count() == 91


def test_shifts_skip_and_overlapping_occurrences_are_found():
    words = [b"a"] * 30
    t = D.tables_of([(0, [b"a"] * 12)], 10)
    hit, found = D.search(words, t)
    assert hit == list(range(30)) and found == [0]
    w = D.WuManber(10, {tuple(b"%d" % k for k in range(10)): [0]})
    assert min(w.shift.values()) == 0 and max(w.shift.values()) == 8
    looked = []
    w.shift = type("Seen", (dict,), {"get": lambda s, k, d: (looked.append(k), dict.get(s, k, d))[1]})(w.shift)
    assert list(w.find([b"z"] * 900)) == [] and len(looked) == 99


def test_drop_contaminated(spark):
    df = edge_docs(spark)
    want = by_id((r[0],) for r in brute(DOCS, ITEMS) if not r[5])
    for words in (D.BLOCK_WORDS, 12):
        kept = D.drop_contaminated(df, bench_of(spark, ITEMS), block_words=words)
        assert kept.dtypes == df.dtypes
        assert by_id((r.doc_id,) for r in kept.collect()) == want
