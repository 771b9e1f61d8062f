import math
import os
import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from driftwood import operators as op
from driftwood import sources as src
from driftwood.plans import jobs
from driftwood.sources import read_vectors

from .conftest import plan_text, rows

DIM = 3


def vocab(spark, tmp_path):
    p = os.path.join(str(tmp_path), "vec.txt")
    with open(p, "w") as f:
        f.write("a 1 0 0\nb 0 1 0\nc 0 0 1\na 9 9 9\nshort 1 1\nlong 1 1 1 1\n\n")
    return read_vectors(spark, p)


def test_read_vectors(spark, tmp_path):
    v = vocab(spark, tmp_path)
    assert v.count() == 6
    first = op.first_vectors(v)
    assert rows(first.where("word = 'a'").select("vec")) == [([1.0, 0.0, 0.0],)]


def toks(spark, data):
    return spark.createDataFrame(data, "id string, word string, weight double")


def test_tag_vector_semantics(spark, tmp_path):
    v = op.first_vectors(vocab(spark, tmp_path))
    t = toks(spark, [("x", "a", 2.0), ("x", "b", 1.0), ("x", "a", 0.5),     # repeats add up
                     ("y", "zzz", 3.0),                                      # unknown -> zeros
                     ("z", "short", 2.0), ("z", "long", 5.0), ("z", "c", 1.0)])
    got = {r.id: r.vec for r in op.tag_vector(t, v, "id", DIM).collect()}
    assert got["x"] == [2.5, 1.0, 0.0]
    assert got["y"] == [0.0, 0.0, 0.0]
    assert got["z"] == [2.0, 2.0, 1.0]       # short padded, long ignored


def test_tag_vector_linear_in_weight(spark, tmp_path):
    v = op.first_vectors(vocab(spark, tmp_path))
    t = toks(spark, [("x", "a", 1.5), ("x", "c", 2.0)])
    t3 = t.withColumn("weight", F.col("weight") * 3)
    a = op.tag_vector(t, v, "id", DIM).collect()[0].vec
    b = op.tag_vector(t3, v, "id", DIM).collect()[0].vec
    assert all(math.isclose(3 * x, y) for x, y in zip(a, b))


def test_tag_vector_plan(spark, tmp_path):
    v = op.first_vectors(vocab(spark, tmp_path))
    t = toks(spark, [("x", "a", 1.0)])
    out = op.tag_vector(t, v, "id", DIM)
    out.collect()
    p = plan_text(out)
    # fixed-width sum buffers: hash aggregation with a partial phase
    assert "HashAggregate" in p and "partial_sum" in p and "PythonUDF" not in p


def test_token_vectors(spark, tmp_path):
    v = op.first_vectors(vocab(spark, tmp_path))
    t = toks(spark, [("x", "a", 2.0), ("x", "", 1.0), ("x", "nope", 1.0)])
    got = sorted((r.word, r.vec) for r in op.token_vectors(t, v, DIM).collect())
    assert got == [("", [0.0] * 3), ("a", [2.0, 0.0, 0.0]), ("nope", [0.0] * 3)]
    b = sorted((r.word, r.vec) for r in op.token_vectors_broadcast(t, vocab(spark, tmp_path), DIM).collect())
    assert b == [("", [0.0] * 3), ("a", [1.0, 0.0, 0.0]), ("nope", [0.0] * 3)]   # weight ignored


def test_no_action_while_a_plan_is_built(spark, tmp_path):
    v = vocab(spark, tmp_path)
    t = toks(spark, [("x", "a", 2.0)])
    jobs_before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = op.token_vectors_broadcast(t, v, DIM)
    assert out.columns[-1] == "vec"
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs_before


def test_first_vector_is_the_first_of_the_first_file(spark, tmp_path):
    for name, lines in (("a.txt", ["x 1 0 0"] + [f"w{i} 0 0 1" for i in range(200)]), ("b.txt", ["x 2 0 0"] * 3000)):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    v = src.read_vectors(spark, str(tmp_path / "*.txt"))
    assert op.first_vectors(v).where("word = 'x'").first().vec == [1.0, 0.0, 0.0]
    left = op.first_vectors_unpartitioned(v)
    assert [r.vec for r in left.where("word = 'x'").collect()] == [[1.0, 0.0, 0.0]] and left.count() == 201


def test_category_vector_four_cases(spark, tmp_path):
    v = op.first_vectors(vocab(spark, tmp_path))
    rows_ = spark.createDataFrame([
        ("e", "", ""),                          # both empty -> zeros
        ("k", "1:-1;2:a=2 b;3:c", ""),          # keyword text, -1 skipped
        ("t", "", "c=4"),                       # title only
        ("kt", "1:-1;2:a=2", "b=1"),            # with a title the keyword text is plain tags
        ("s", "a=1 b=1", ""),                   # plain tags, no title
    ], "id string, s string, t string")
    got = {r.id: r.vec for r in op.category_vector(rows_, v, DIM, "id", "s", "t").collect()}
    assert got["e"] == [0.0, 0.0, 0.0]
    assert got["k"] == [2.0, 1.0, 1.0]
    assert got["t"] == [0.0, 0.0, 4.0]
    assert got["kt"] == [0.0, 1.0, 0.0]
    assert got["s"] == [1.0, 1.0, 0.0]


def test_content_vectors(spark, tmp_path):
    v = op.first_vectors(vocab(spark, tmp_path))
    cr = spark.createDataFrame([("1", "a=1 b=1", "a=2"), ("2", "", "")],
                               "content_id string, tags string, tags_title string")
    out = {r.content_id: r for r in jobs.content_vectors(cr, v, DIM).collect()}
    assert out["1"].tags_vec == [1.0, 1.0, 0.0] and out["1"].title_vec == [2.0, 0.0, 0.0]
    assert out["2"].tags_vec == [0.0] * 3


def test_versions_of_an_id_are_summed_apart(spark, tmp_path):
    v = op.first_vectors(vocab(spark, tmp_path))
    rows_ = spark.createDataFrame([("1", "a=1", None), ("1", "a=2 b=1", ""), ("1", "a=1", None), (None, "b=1", "a=1")],
                                  "content_id string, tags string, tags_title string")
    got = sorted((str(r.content_id), r.tags_vec, r.title_vec) for r in jobs.content_vectors(rows_, v, DIM).collect())
    zero = [0.0] * 3
    assert got == [("1", [1.0, 0.0, 0.0], zero), ("1", [1.0, 0.0, 0.0], zero), ("1", [2.0, 1.0, 0.0], zero),
                   ("None", [0.0, 1.0, 0.0], [1.0, 0.0, 0.0])]
    cat = spark.createDataFrame([("k", "a=1", ""), ("k", "1:-1;2:b=2", ""), ("k", "a=1", "")], "id string, s string, t string")
    assert sorted(r.vec for r in op.category_vector(cat, v, DIM, "id", "s", "t").collect()) == \
        [[0.0, 2.0, 0.0], [1.0, 0.0, 0.0], [1.0, 0.0, 0.0]]


def test_lookup_one_and_norm(spark, tmp_path):
    v = vocab(spark, tmp_path)
    r = jobs.word_norm(v, "a").collect()
    assert len(r) == 1 and r[0].l2 == 1.0          # first of the two "a" rows
    assert jobs.word_norm(v, "missing").count() == 0


def test_hot_word_join_is_split_and_whole(spark):
    # a plain vocabulary table: the join shuffles both sides, so AQE can split
    v = spark.createDataFrame([("a", [1.0, 0.0, 0.0]), ("b", [0.0, 1.0, 0.0]), ("c", [0.0, 0.0, 1.0])],
                              "word string, vec array<float>")
    hot = [(f"id{i % 500}", "a", 1.0) for i in range(3000)]
    cold = [(f"id{i % 500}", "bc"[i % 2], 1.0) for i in range(6000)]
    t = toks(spark, hot + cold).repartition(8)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, val in conf.items():
            spark.conf.set(k, val)
        tv = op.token_vectors(t, v, DIM)
        assert tv.count() == 9000
        tv.collect()
        assert "skew=true" in plan_text(tv)
        out = {r.id: r.vec for r in op.tag_vector(t, v, "id", DIM).collect()}
        unit = {"a": [1.0, 0.0, 0.0], "b": [0.0, 1.0, 0.0], "c": [0.0, 0.0, 1.0]}
        exp = {}
        for i, w, _ in hot + cold:
            exp[i] = [x + y for x, y in zip(exp.get(i, [0.0] * 3), unit[w])]
        assert out == exp
    finally:
        for k, val in old.items():
            if val is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, val)


def test_wide_vectors_by_blocks_of_positions(spark):
    """Beyond the width of generated code: sums by blocks equal a plain loop,
    shorter vectors add to their own positions, longer ones nothing."""
    rng = random.Random(2)
    dim = 120
    vocab = {f"w{k}": [rng.uniform(-1, 1) for _ in range(dim)] for k in range(20)}
    vocab |= {"short": [1.0] * 53, "long": [5.0] * (dim + 1), "empty": []}
    toks = [(rng.randrange(40) or None, rng.choice("ab"), rng.choice([*vocab, "unknown", "w1"]), rng.uniform(0, 3)) for _ in range(600)]
    toks += [(100, "a", "unknown", 1.0), (101, "b", "long", 1.0)]
    v = spark.createDataFrame(list(vocab.items()), "word string, vec array<double>")
    t = spark.createDataFrame(toks, "id long, part string, word string, weight double")
    want = {}
    for i, p, w, x in toks:
        for key in ((i, p), (i, None)):
            out = want.setdefault(key, [0.0] * dim)
            for k, c in enumerate(vocab.get(w, []) if len(vocab.get(w, [])) <= dim else []):
                out[k] += c * x
    near = lambda a, b: len(a) == len(b) and all(abs(x - y) < 1e-9 for x, y in zip(a, b))
    ids = t.select("id").distinct()
    one = op.vector_sums(t, v, ["id"], dim, present=ids)
    got = {r.id: r.vec for r in one.collect()}
    assert set(got) == {i for i, _ in want} and all(near(got[i], want[i, None]) for i in got)
    two = op.vector_sums(t, v, ["id"], dim, "part", ["a", "b"], present=ids)
    for r in two.collect():
        assert near(r.a_vec, want.get((r.id, "a"), [0.0] * dim)) and near(r.b_vec, want.get((r.id, "b"), [0.0] * dim))
    combined = op.vector_sums(op.combine_repeats(t, ["id"]), v, ["id"], dim, present=ids)
    assert all(near(r.vec, got[r.id]) for r in combined.collect())
    # the sums of a block stay in generated code
    assert "*(" in next(x for x in plan_text(one).split("\n") if "HashAggregate" in x and "partial_sum" in x)


def test_vectors_of_rows_are_not_joined_back(spark):
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "word string, vec array<double>")
    r = spark.createDataFrame([("1", "a=2 b=1", "a=1"), ("1", "a=2 b=1", "a=1"), ("1", "x", None), (None, "b=1", "z"), ("2", None, "")],
                              "content_id string, tags string, tags_title string")
    got = op.content_vectors(r, v, 2)
    assert sorted(map(str, got.collect())) == sorted(map(str, [
        Row(content_id="1", tags_vec=[5.0, 8.0], title_vec=[1.0, 2.0])] * 2 + [
        Row(content_id="1", tags_vec=[0.0, 0.0], title_vec=[0.0, 0.0]),
        Row(content_id=None, tags_vec=[3.0, 4.0], title_vec=[0.0, 0.0]),
        Row(content_id="2", tags_vec=[0.0, 0.0], title_vec=[0.0, 0.0])]))
    plan = plan_text(got)
    assert sum("Join" in x for x in plan.split("\n")) == 1  # the vocabulary's


def test_hot_words_are_joined_where_they_stand(spark):
    """A word of most tokens: same rows as the ordinary join, none of its
    tokens shuffled for the join, tasks as even as the input's."""
    rng = random.Random(5)
    vocab = [(f"w{k}", [float(k), 1.0, -2.0]) for k in range(50)]
    data = [(rng.randrange(300), rng.choice(["w1"] * 6 + ["nowhere", None, f"w{rng.randrange(60)}"]), 1.0 + k % 3) for k in range(6000)]
    t = spark.createDataFrame(data, "id long, word string, weight double").repartition(8)
    v = spark.createDataFrame(vocab, "word string, vec array<double>")
    hot = op.hot_words(t, max_hot=8, min_share=0.05)
    assert {r.word for r in hot.collect()} == {"w1", "nowhere"}
    assert op.hot_words(t, max_hot=1, min_share=0.0).count() == 1
    assert op.hot_words(t.where("false")).count() == 0 and op.hot_words(t.select(F.lit(None).cast("string").alias("word"))).count() == 0
    none = hot.where("false")
    for how in ("inner", "left"):
        want = rows(op.join_words(t, v, how))
        assert rows(op.join_words(t, v, how, hot)) == want == rows(op.join_words(t, v, how, none))
    assert rows(op.token_vectors(t, v, DIM, hot)) == rows(op.token_vectors(t, v, DIM))
    assert rows(op.tag_vector(t, v, "id", DIM, hot=hot)) == rows(op.tag_vector(t, v, "id", DIM))
    wide = v.withColumn("vec", F.array_repeat(F.lit(0.5), 95))
    assert rows(op.tag_vector(t, wide, "id", 95, hot=hot)) == rows(op.tag_vector(t, wide, "id", 95))

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, val in conf.items():
            spark.conf.set(k, val)

        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        n_hot = sum(w == "w1" for _, w, _ in data)
        assert largest(op.join_words(t, v)) >= n_hot
        split = op.join_words(t, v, hot=hot)
        assert largest(split) < n_hot / 4
        plan = plan_text(split)
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") >= 3
    finally:
        for k, val in old.items():
            spark.conf.unset(k) if val is None else spark.conf.set(k, val)


def exchanges(df) -> int:
    return sum("Exchange hashpartitioning" in x for x in plan_text(df).split("\n"))


def test_no_vector_is_shuffled_where_the_vocabulary_is_broadcast(spark, tmp_path):
    """Texts and tokens are dealt by id once; sums, parts and blocks of an id
    meet where they stand, with the rows of the path that shuffles."""
    dim = 120
    v = spark.createDataFrame([("a", [1.0] * dim), ("b", [float(k) for k in range(dim)]), ("", [9.0] * dim)], "word string, vec array<double>")
    v.write.parquet(str(tmp_path / "v"))  # a table whose size Spark knows
    v = spark.read.parquet(str(tmp_path / "v"))
    r = spark.createDataFrame([("1", "a=2 b=1", "a=1"), ("1", "a=2 b=1", "a=1"), ("2", " x", "b"), (None, "", "z b=2"), ("3", None, None)],
                              "id string, s string, t string")
    a, b = [1.0] * dim, [float(k) for k in range(dim)]
    mix = lambda x, y: [x * p + y * q for p, q in zip(a, b)]
    for n in (None, 5):
        got = op.content_vectors(r, v, dim, "id", "s", "t", n_rows=n)
        assert sorted(map(str, got.collect())) == sorted(map(str, [
            Row(id="1", tags_vec=mix(2, 1), title_vec=mix(1, 0))] * 2 + [
            Row(id="2", tags_vec=mix(0, 0), title_vec=mix(0, 1)), Row(id=None, tags_vec=mix(0, 0), title_vec=mix(0, 2)),
            Row(id="3", tags_vec=mix(0, 0), title_vec=mix(0, 0))]))
        assert exchanges(got) == 1
        cat = op.category_vector(r, v, dim, "id", "s", "t", n_rows=n)
        assert sorted(map(str, cat.collect())) == sorted(map(str, [
            Row(id="1", vec=mix(3, 1))] * 2 + [Row(id="2", vec=mix(0, 1)), Row(id=None, vec=mix(0, 2)), Row(id="3", vec=mix(0, 0))]))
        assert exchanges(cat) == 1
    t = toks(spark, [("x", "a", 2.0), ("x", "b", 1.0), ("x", "nope", 1.0), ("y", "nope", 1.0), ("y", None, 1.0), (None, "a", 1.0)])
    for every in (True, False):
        got = op.tag_vector(t, v, "id", dim, all_ids=every, n_tokens=6)
        assert rows(got) == rows(op.tag_vector(t, v, "id", dim, all_ids=every))
        got.collect()
        assert exchanges(got) == 1
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert op.vectors.dealt_parts(spark, 10, 64) == few and op.vectors.dealt_parts(spark, 10**9, 300) >= 30_000


def without_broadcasts(spark, run):
    """What ``run`` gives in a session that broadcasts no table by itself."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "-1")
        return run()
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def odd_vocabulary(spark, dim):
    v = [("a", [1.0] * dim), ("b", [float(k) for k in range(dim)]), ("short", [2.0, 3.0]), ("long", [5.0] * (dim + 1)), ("empty", []),
         ("none", None), (None, [7.0] * dim)]
    return spark.createDataFrame(v, "word string, vec array<float>")


ODD_ROWS = [("1", "a=2 b=1", "a=1"), ("1", "a=2 b=1", "a=1"), ("1", "a=2 b=1", None), ("2", " x", "b short=2"), (None, "", "z b=2"),
            (None, "long", "a"), ("3", None, None), ("4", "long=2 empty none", "empty")]


def test_a_counted_vocabulary_is_broadcast_whatever_spark_guesses(spark):
    """Content rows: dealt by id once, no vector shuffled, where the session
    broadcasts nothing by itself; nulls, versions and copies as before."""
    r = spark.createDataFrame(ODD_ROWS, "id string, s string, t string")
    for dim, make in ((4, op.category_vector), (120, op.content_vectors)):
        v = odd_vocabulary(spark, dim)
        assert op.vectors.vocab_fits(v, dim)
        want = rows(make(r, v, dim, "id", "s", "t"))
        assert len(want) == len(ODD_ROWS)

        def dealt(make=make, v=v, dim=dim):
            got = make(r, v, dim, "id", "s", "t", n_rows=len(ODD_ROWS))
            return rows(got), exchanges(got)
        assert without_broadcasts(spark, dealt) == (want, 1)


def test_a_vocabulary_too_large_to_broadcast_ships_whole_vectors(spark, monkeypatch):
    """Rows and words meet by a shuffle, and known vectors go to their row's
    part as they are: no partial sums are shuffled, twice."""
    monkeypatch.setattr(op.vectors, "VOCAB_BYTES", 0)
    r = spark.createDataFrame(ODD_ROWS, "id string, s string, t string")
    for dim, make in ((4, op.category_vector), (120, op.content_vectors)):
        v = odd_vocabulary(spark, dim)
        assert not op.vectors.vocab_fits(v, dim)
        want = rows(make(r, v, dim, "id", "s", "t"))

        def dealt(make=make, v=v, dim=dim):
            got = make(r, v, dim, "id", "s", "t", n_rows=len(ODD_ROWS))
            return rows(got), exchanges(got)
        assert without_broadcasts(spark, dealt) == (want, 4)  # texts, words, vocabulary, known vectors


def test_tokens_meet_a_counted_vocabulary_where_they_are_dealt(spark, monkeypatch):
    """Sums per id: tokens are shuffled once if the counted vocabulary can be
    broadcast, else they meet it and go on to their id with whole vectors."""
    data = [("x", "a", 2.0), ("x", "a", 0.5), ("x", "b", 1.0), ("x", "nope", 1.0), ("y", "nope", 1.0), ("y", None, 1.0), (None, "a", 1.0),
            ("z", "short", 2.0), ("z", "long", 1.0), ("w", "long", 1.0), ("w", "none", 1.0), ("v", "empty", 1.0)]
    t = toks(spark, data)
    for dim, every in ((4, False), (120, True)):
        v = odd_vocabulary(spark, dim)
        want = rows(op.tag_vector(t, v, "id", dim, all_ids=every))

        def dealt(hot=None, v=v, dim=dim, every=every):
            got = op.tag_vector(t, v, "id", dim, all_ids=every, n_tokens=len(data), hot=hot)
            return rows(got), exchanges(got)
        assert without_broadcasts(spark, dealt) == (want, 1)
        with monkeypatch.context() as m:
            m.setattr(op.vectors, "VOCAB_BYTES", 0)
            assert without_broadcasts(spark, dealt) == (want, 3)  # words, vocabulary, known vectors
            assert dealt(op.hot_words(t))[0] == want


def test_no_digest_is_shuffled(spark):
    """Versions of an id are dealt by a few bits of their texts' hash; the
    digest that tells them apart is made in the part."""
    r = spark.createDataFrame(ODD_ROWS, "id string, s string, t string")
    v = odd_vocabulary(spark, 4)
    plan = plan_text(op.content_vectors(r, v, 4, "id", "s", "t", n_rows=len(ODD_ROWS))).split("\n")
    deal = next(k for k, x in enumerate(plan) if "Exchange hashpartitioning(id#" in x)
    assert "_deal#" in plan[deal] and any("sha2(" in x for x in plan[:deal]) and not any("sha2(" in x for x in plan[deal:])
