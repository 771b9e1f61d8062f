import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from driftwood import sources as src
from driftwood.plans import jobs
from driftwood.session import scratch_path

from .conftest import plan_text


def test_partitioned_write_and_pruned_range(spark):
    df = spark.createDataFrame([(i, f"202401{d:02d}") for i, d in enumerate(range(1, 11))],
                               "v int, day string")
    path = scratch_path(spark, "t-part")
    src.write_partitioned(df, path, ["day"], n_files=2)
    got = src.read_day_range(spark, path, "20240103", "20240105")
    assert sorted(r.v for r in got.collect()) == [2, 3, 4]
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p and "20240103" in p


def test_rebalanced_write_few_files_per_day(spark):
    df = spark.range(4000).select((F.col("id") % 2).cast("string").alias("day"), "id").repartition(16)
    path = scratch_path(spark, "t-rebal")
    src.write_partitioned(df, path, ["day"], rebalance=True)
    for d in ("0", "1"):
        files = [f for f in os.listdir(os.path.join(path.replace("file:", ""), f"day={d}"))
                 if f.endswith(".parquet")]
        assert 1 <= len(files) < 16
    assert spark.read.parquet(path).count() == 4000


def test_dynamic_overwrite_keeps_other_days(spark):
    path = scratch_path(spark, "t-dyn")
    a = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "v int, day string")
    src.write_partitioned(a, path, ["day"])
    b = spark.createDataFrame([(3, "20240102")], "v int, day string")
    src.write_partitioned(b, path, ["day"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]


def test_snapshot_never_overwrites(spark):
    root = scratch_path(spark, "t-snap")
    df = spark.createDataFrame([("a,b",)], "value string")
    p = src.write_snapshot(df, root, "202401", "202401011200", n_files=1, fmt="text")
    assert p.endswith(os.path.join("202401", "contentInfo", "202401011200"))
    with pytest.raises(Exception):
        src.write_snapshot(df, root, "202401", "202401011200", n_files=1, fmt="text")
    back = src.read_positional(spark, p, ["x", "y", "z"]).collect()[0]
    assert (back.x, back.y, back.z) == ("a", "b", None)


def test_day_logs_carry_their_folder(spark):
    root = scratch_path(spark, "t-days")
    for d in ("20240101", "20240103"):
        spark.createDataFrame([(d,)], "value string").write.text(f"{root}/{d}/logs")
    paths = src.day_paths(f"{root}/", [dt.date(2024, 1, 1), dt.date(2024, 1, 3)], "/logs")
    got = src.read_day_logs(spark, paths)
    assert sorted((r.folder_day, r.value) for r in got.collect()) == [("20240101", "20240101"), ("20240103", "20240103")]


def test_fixed_file_count(spark):
    path = scratch_path(spark, "t-files")
    src.write_text(spark.range(1000).selectExpr("cast(id AS string) AS value").repartition(8), path, n_files=2)
    assert len([f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")]) == 2


def test_null_text_is_read_as_null(spark):
    df = spark.createDataFrame([("a,null,",)], "value string")
    assert tuple(src.split_positional(df, ["x", "y", "z"], null_text="null").first()) == ("a", None, "")


def test_repair_snapshot(spark):
    df = spark.createDataFrame([("(201901001, , , )",), ("(a(b)",)], "value string")
    assert [r.value for r in jobs.repair_snapshot(df).collect()] == ["201901001, , , ", "a"]


def test_scan_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(10).select(F.col("id"), (F.col("id") * 2).alias("b"), F.lit("x").alias("c")) \
        .write.parquet(path)
    df = spark.read.parquet(path).where("id > 5").select("b")
    df.collect()
    p = plan_text(df)
    assert "ReadSchema: struct<id:bigint,b:bigint>" in p and "PushedFilters: [IsNotNull(id), GreaterThan(id,5)]" in p


def test_csv_roundtrip_quotes_commas(spark):
    from driftwood.schemas import TRAINING_COLUMNS, TRAINING_SCHEMA
    vals = [1] + [f"v{i}" for i in range(1, 39)]
    vals[4] = 'a,b "c"'                       # p6 with a comma and quotes
    vals[10] = None
    df = spark.createDataFrame([tuple(vals)], TRAINING_SCHEMA)
    path = scratch_path(spark, "t-csv")
    df.write.option("header", "false").csv(path)
    back = src.read_csv(spark, path, TRAINING_SCHEMA).collect()[0]
    assert [back[c] for c in TRAINING_COLUMNS] == vals
