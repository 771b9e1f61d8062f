from pyspark.sql import functions as F

from driftwood import operators as op
from driftwood.plans import jobs
from driftwood.schemas import CONTENT_COLUMNS
from driftwood.session import scratch_root

from .conftest import plan_text, rows

TAGS = '{"v8":{"词甲":{"weight":0.418},"词乙":{"weight":0.403}}}'
TITLE = '{"v4":{"词丙":{"weight":1.01}}}'
LOCAL = '{"v1":[{"country":"US","city":"Austin","state":null}]}'
GROUP = '{"v2":{"g17":{},"g03":{}}}'


def tables(spark):
    tc = spark.createDataFrame([
        ("201808001", "2018_08", "3", "ok", "9.5", "2018-08-01 00:00:00", "news"),
        ("201907001", "2019_07", "1", "ok", "7.0", "2019-07-02 00:00:00", "news"),
        ("201809002", "2018_09", "0", "no", "1.0", "2018-09-03 00:00:00", "video"),
        ("201807001", "2018_07", "2", "ok", "5.0", "2018-07-01 00:00:00", "news"),
    ], "content_id string, shard string, body_images_count string, image_auditstate string, "
       "publisher_score string, publish_time string, content_type string")
    ts = spark.createDataFrame([
        ("201808001", "2018_08", "300", "12", LOCAL, GROUP, TAGS, TITLE),
        ("201907001", "2019_07", "100", "8", None, '{"v2":{}}', None, None),
        ("201809002", "2018_09", "50", "4", LOCAL, GROUP, TAGS, TITLE),
        ("201807001", "2018_07", "10", "2", LOCAL, GROUP, TAGS, TITLE),
    ], "content_id string, shard string, content_words_num string, title_words_num string, "
       "local string, group_id string, tags string, tags_title string")
    tn = spark.createDataFrame([
        ("201808001", "2018_08", "0"), ("201907001", "2019_07", "1"), ("201807001", "2018_07", "0"),
    ], "content_id string, shard string, ero_cal_result string")
    return tc, ts, tn


def test_content_lookup(spark):
    ids = spark.createDataFrame([(x,) for x in [
        "201808001",   # found
        "201907001",   # found, shard without publisher_score, null JSON
        "201809002",   # no t_news_manager row -> miss
        "201807001",   # exists but the shard is before the first valid month
        "201713999",   # invalid shard
        "201808001",   # requested twice -> two rows
    ]], "content_id string")
    out = op.content_lookup(ids, *tables(spark))
    assert out.columns == CONTENT_COLUMNS
    got = {r.content_id: r for r in out.collect()}
    assert out.count() == 6
    a = got["201808001"]
    assert (a.publisher_score, a.country, a.city, a.state, a.group_key, a.tags, a.tags_title) == \
        ("9.5", "US", "Austin", " ", "g17", "词甲=0.418 词乙=0.403", "词丙=1.01")
    b = got["201907001"]
    assert (b.publisher_score, b.country, b.group_key, b.tags, b.tags_title) == (" ", " ", " ", "", "")
    for miss in ("201809002", "201807001", "201713999"):
        r = got[miss]
        assert [r[c] for c in CONTENT_COLUMNS[1:12]] == [" "] * 11
        assert (r.tags, r.tags_title) == ("", "")


def test_lookup_plan_is_a_join(spark):
    ids = spark.createDataFrame([("201808001",)], "content_id string")
    out = op.content_lookup(ids, *tables(spark))
    out.collect()
    p = plan_text(out)
    assert "Join" in p and "PythonUDF" not in p


def test_anti_semi_partition(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(20)], "content_id string")
    snap = spark.createDataFrame([(str(i),) for i in range(0, 40, 3)], "content_id string")
    new = {r[0] for r in op.new_ids(ids, snap).collect()}
    known = {r[0] for r in op.known_ids(ids, snap).collect()}
    assert new | known == {str(i) for i in range(20)} and not new & known
    c = op.id_counts(ids.union(ids), snap).collect()[0]
    assert (c.total_ids, c.new_ids, c.known_ids) == (20, len(new), len(known))


def test_ids_from_text_rows(spark):
    line = ",".join(["x"] * 24 + ["cid"] + ["y"] * 14)
    df = spark.createDataFrame([(line,), ("short,row",)], "value string")
    assert rows(op.ids_from_text_rows(df)) == [("cid",)]


def _row(cid, x="a"):
    return tuple([cid] + [x] * 13)


def test_snapshot_merge_and_dedup(spark):
    schema = ", ".join(f"{c} string" for c in CONTENT_COLUMNS)
    old = spark.createDataFrame([_row("1"), _row("2")], schema)
    new = spark.createDataFrame([_row("2"), _row("3"), _row("1", "b")], schema)
    m = op.snapshot_merge(new, old)
    assert m.count() == 4                                  # id 1 kept in two versions
    assert op.snapshot_merge(m, m).count() == 4            # idempotent
    d = op.dedup_content(m)
    assert rows(d.select("content_id", "tags")) == [("1", "a"), ("2", "a"), ("3", "a")]


def test_content_refresh(spark):
    schema = ", ".join(f"{c} string" for c in CONTENT_COLUMNS)
    old = spark.createDataFrame([_row("201808001", "old")], schema)
    logs = spark.createDataFrame([(x,) for x in ["201808001", "201907001", "201907001", None]],
                                 "content_id string")
    out = jobs.content_refresh(logs, old, *tables(spark))
    got = rows(out.select("content_id", "body_images_count"))
    # the known id is not looked up again; the new one is
    assert got == [("201808001", "old"), ("201907001", "1")]
    again = jobs.content_refresh(logs, out, *tables(spark))
    assert again.count() == out.count()
    fast = jobs.content_refresh(logs, out, *tables(spark), snapshot_is_distinct=True)
    assert rows(fast) == rows(again)
    fast.collect()
    assert "HashAggregate(keys=[content_id" not in plan_text(fast).split("Union")[0]


def test_first_per_id(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", None)], "content_id string, v string")
    assert rows(op.first_per_id(df)) == [("1", "a"), ("2", None)]


def test_content_row_without_score_column(spark):
    tc, ts, tn = tables(spark)
    j = op.content_join3(tc.drop("publisher_score"), ts, tn)
    r = op.content_row(j)
    assert {x.publisher_score for x in r.collect()} == {" "}


def test_hot_id_lookup_is_split_and_whole(spark):
    """One id holds a third of all requested rows: AQE splits its join
    partition (no broadcast here) and every input row still gets its row."""
    hot = [("201808001", f"log-{i:06d}") for i in range(3000)]
    cold = [(f"2018{8 + (i % 4):02d}{i:03d}", f"log-{i:06d}") for i in range(6000)]
    ids = spark.createDataFrame(hot + cold, "content_id string, log_id string").repartition(8)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = op.content_lookup(ids, *tables(spark))
        got = out.groupBy("content_id").count().where("content_id = '201808001'").collect()
        assert got[0]["count"] == 3000
        assert out.count() == 9000
        assert out.select("log_id").distinct().count() == 6000
        out.collect()
        assert "skew=true" in plan_text(out)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shards_parquet_with_missing_column(spark):
    from driftwood.session import scratch_path
    from driftwood.sources import read_shards_parquet
    tc, ts, tn = tables(spark)
    root = scratch_path(spark, "t-shards")
    early = tc.where("shard = '2019_07'").drop("publisher_score")
    late = tc.where("shard <> '2019_07'")
    early.write.partitionBy("shard").parquet(root + "/t_content")
    late.write.mode("append").partitionBy("shard").parquet(root + "/t_content")
    tc2 = read_shards_parquet(spark, root + "/t_content")
    assert set(tc2.columns) == set(tc.columns)
    ids = spark.createDataFrame([("201808001",), ("201907001",)], "content_id string")
    got = {r.content_id: r.publisher_score for r in op.content_lookup(ids, tc2, ts, tn).collect()}
    assert got == {"201808001": "9.5", "201907001": " "}


def test_shards_pruned_at_planning(spark):
    from driftwood.session import scratch_path
    from driftwood.sources import read_shards_parquet
    tc, ts, tn = tables(spark)
    root = scratch_path(spark, "t-prune")
    for name, t in (("c", tc), ("s", ts), ("n", tn)):
        t.write.partitionBy("shard").parquet(f"{root}/{name}")
    src3 = [read_shards_parquet(spark, f"{root}/{n}") for n in "csn"]
    ids = spark.createDataFrame([("201808001",), ("201907001",)], "content_id string")
    out = op.content_lookup(ids, *src3, shards=["2018_08"])
    got = {r.content_id: r.body_images_count for r in out.collect()}
    assert got == {"201808001": "3", "201907001": " "}
    assert "PartitionFilters: [isnotnull(shard" in plan_text(out) and "2018_08" in plan_text(out)


def test_lookup_with_checkpointed_ids(spark):
    ids = spark.createDataFrame([("201808001",), ("201713999",), ("201808001",)], "content_id string")
    a = rows(op.content_lookup(ids, *tables(spark)))
    b = rows(op.content_lookup(ids, *tables(spark), checkpoint_ids=True))
    assert a == b and len(a) == 3


def test_rows_of_other_months_go_before_they_are_shuffled(spark, tmp_path):
    """An id is looked up in the month it routes to; the sources' rows that
    lie elsewhere are dropped by the scan, not by the join with the ids."""
    stored = []
    for name, t in zip(("c", "s", "n"), tables(spark), strict=True):
        t.unionByName(t.where("content_id = '201808001'").withColumn("shard", F.lit("2019_01"))).write.parquet(f"{tmp_path}/{name}")
        stored.append(spark.read.parquet(f"{tmp_path}/{name}"))
    ids = spark.createDataFrame([("201808001",), ("201807001",), ("x",), (None,)], "content_id string")
    scratch_root(spark)
    got = op.content_lookup(ids, *stored, checkpoint_ids=True)
    assert [r.content_words_num for r in got.orderBy("content_id").collect()] == [" ", " ", "300", " "]
    # a filter on the label of the id below every semi join
    tree = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    own = [x for x in tree if "Filter" in x and "shard#" in x and "content_id#" in x and "substring" in x]
    assert len(own) >= 3
