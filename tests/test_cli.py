import os

from pyspark import SparkConf

from driftwood import cli
from driftwood.schemas import CONTENT_COLUMNS
from driftwood.session import scratch_path

from .test_content import tables
from .test_logs import S, log


def test_cli_flow(spark):
    root = scratch_path(spark, "cli")
    days = {"20240101": "201808001", "20240102": "201907001", "20240103": "201809002"}
    for d, cid in days.items():
        t = f"{d[:4]}-{d[4:6]}-{d[6:]} 08:00:00"
        spark.createDataFrame([(log("i" + d, cid, "dev", t, "e23"),)], "value string") \
            .write.text(f"{root}/imp/{d}/logs")
        spark.createDataFrame([(log("c" + d, cid, "dev", t, "e24"),)], "value string") \
            .write.text(f"{root}/clk/{d}/logs")
    # two days ending the day before 2024-01-04: 01-02 and 01-03 (01-01 is outside)
    r = cli.main(["training-rows", "--days", "2", "--from-day", "1", "--run-date", "2024-01-04",
                  "--imp-prefix", f"{root}/imp/", "--clk-prefix", f"{root}/clk/", "--suffix", "/logs",
                  "--strategy", str(S), "--out", f"{root}/rows"], spark=spark)
    assert (r["start"], r["end"]) == ("2024-01-02", "2024-01-03")
    rows = spark.read.parquet(f"{root}/rows")
    assert sorted(x.content_id for x in rows.collect()) == ["201809002", "201907001"]
    assert {x.is_click for x in rows.collect()} == {1}

    tc, ts, tn = tables(spark)
    for name, t in (("c", tc), ("s", ts), ("n", tn)):
        t.write.partitionBy("shard").parquet(f"{root}/{name}")
    schema = ", ".join(f"{c} string" for c in CONTENT_COLUMNS)
    old = tuple(["201808001"] + ["x"] * 11 + ["词甲=2 词乙", "词丙=1.5"])
    spark.createDataFrame([old], schema).write.parquet(f"{root}/old")
    r = cli.main(["content-refresh", "--days", "2", "--from-day", "1", "--run-date", "2024-01-04",
                  "--rows", f"{root}/rows", "--snapshot", f"{root}/old", "--content", f"{root}/c",
                  "--signal", f"{root}/s", "--news", f"{root}/n", "--snapshot-root", f"{root}/snap",
                  "--stamp", "202401040000", "--files", "1"], spark=spark)
    assert r["total_ids"] == 2 and r["new_ids"] == 2 and r["found"] == 1
    snap = spark.read.parquet(r["snapshot"])
    assert sorted(x.content_id for x in snap.collect()) == ["201808001", "201809002", "201907001"]

    vec_path = os.path.join(root.replace("file:", ""), "vec.txt")
    os.makedirs(os.path.dirname(vec_path), exist_ok=True)
    with open(vec_path, "w") as f:
        f.write("词甲 1 0 0\n词乙 0 1 0\n词丙 0 0 1\n词甲 5 5 5\n")   # repeated word: first wins
    r = cli.main(["content-vectors", "--snapshot", r["snapshot"], "--vectors", vec_path, "--dim", "3",
                  "--out", f"{root}/vec-out", "--files", "1"], spark=spark)
    got = {x.content_id: (x.tags_vec, x.title_vec) for x in spark.read.parquet(r["out"]).collect()}
    assert got["201808001"] == ([2.0, 1.0, 0.0], [0.0, 0.0, 1.5])     # from the old row's tags
    assert got["201907001"] == ([0.0, 0.0, 0.0], [0.0, 0.0, 0.0])     # found, no tags
    assert got["201809002"] == ([0.0, 0.0, 0.0], [0.0, 0.0, 0.0])     # not found -> empty tags

    spark.createDataFrame([("(a,b)",)], "value string").write.text(f"{root}/wrapped")
    r = cli.main(["repair", "--src", f"{root}/wrapped", "--dst", f"{root}/unwrapped", "--files", "1"],
                 spark=spark)
    assert [x.value for x in spark.read.text(r["out"]).collect()] == ["a,b"]


def test_cluster_settings_are_defaults(spark):
    from driftwood.session import CLUSTER_CONF, cluster_builder
    given = SparkConf()  # what this test session was started with counts as set by the deployment
    made = cluster_builder("x")._options
    assert {k: v for k, v in CLUSTER_CONF.items() if not given.contains(k)}.items() <= made.items()
    assert made["spark.sql.files.maxPartitionBytes"] == "256m"
    assert not [k for k in CLUSTER_CONF if given.contains(k) and k in made]
