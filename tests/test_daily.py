import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from driftwood.plans import daily, inputs
from driftwood.plans import queries as Q
from driftwood.schemas import CONTENT_COLUMNS
from driftwood.session import scratch_path
from driftwood.sources import read_day_logs

from .conftest import plan_text
from .test_content import tables
from .test_logs import S, log


def write_days(spark, root, lines_by_day):
    for day, lines in lines_by_day.items():
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{root}/{day}/logs")


def folders(root, days):
    return [f"{root}/{d}/logs" for d in days]


def test_late_lines_leave_a_finished_day_alone(spark):
    """What one run writes does not depend on the order of runs or on how
    many days a run takes."""
    days = ["20240105", "20240106"]
    imp = {"20240105": [log(str(k), f"c{k}", "d", "2024-01-05 10:00:00", "e23") for k in range(5)],
           "20240106": [log("9", "c9", "d", "2024-01-05 23:59:59", "e23"), log("8", "c8", "d", "n/a", "e23"),
                        log("7", "c7", "d", None, "e23")]}
    clk = {"20240105": [], "20240106": [log("19", "c1", "d", "2024-01-05 23:59:58", "e24")]}
    root = scratch_path(spark, "late")
    write_days(spark, f"{root}/imp", imp)
    write_days(spark, f"{root}/clk", clk)
    got = []
    for windows in ([days], [days[:1], days[1:]], [days[1:], days[:1]]):
        out = scratch_path(spark, "late-rows")
        for w in windows:
            daily.run_training_rows(spark, folders(f"{root}/imp", w), folders(f"{root}/clk", w), S, out)
        got.append(sorted((r.day, r.p1, r.is_click) for r in spark.read.parquet(out).collect()))
    assert got[0] == got[1] == got[2]
    # the click logged a day late pairs within its own folder only; odd times stay in their folder's day
    assert got[0] == [(20240105, str(k), 0) for k in range(5)] + [(20240106, p, 0) for p in ("19", "7", "8", "9")]


def test_missing_side_or_day_fails(spark):
    root = scratch_path(spark, "missing")
    write_days(spark, f"{root}/imp", {"20240101": [log("1", "c", "d", "2024-01-01 08:00:00", "e23")]})
    write_days(spark, f"{root}/clk", {"20240101": [], "20240102": []})
    both, one = ["20240101", "20240102"], ["20240101"]
    for i, c in ((both, both), (one, ["20240103"])):
        with pytest.raises(AnalysisException):
            daily.run_training_rows(spark, folders(f"{root}/imp", i), folders(f"{root}/clk", c), S, scratch_path(spark, "no"))
    spark.createDataFrame([("{}",)], "value string").write.text(f"{root}/undated")
    with pytest.raises(Exception, match="no day folder"):
        read_day_logs(spark, f"{root}/undated").collect()


def test_found_rows_with_null_counts_are_counted(spark):
    root, rows = scratch_path(spark, "found"), scratch_path(spark, "found-rows")
    days = ["20240101"]
    write_days(spark, f"{root}/imp", {"20240101": [log("1", "201808001", "d", "2024-01-01 08:00:00", "e23"),
                                                   log("2", "201907001", "d", "2024-01-01 08:00:00", "e23")]})
    write_days(spark, f"{root}/clk", {"20240101": []})
    daily.run_training_rows(spark, folders(f"{root}/imp", days), folders(f"{root}/clk", days), S, rows)
    tc, ts, tn = tables(spark)
    old = spark.createDataFrame([], ", ".join(f"{c} string" for c in CONTENT_COLUMNS))
    _, m = daily.run_content_refresh(spark, rows, "20240101", "20240101", old,
                                     tc.withColumn("body_images_count", F.lit(None).cast("string")), ts, tn,
                                     scratch_path(spark, "found-snap"), "202401", "202401020000")
    assert m == {"total_ids": 2, "new_ids": 2, "found": 2}


def test_daily_jobs(spark):
    imp = [log("1", "201808001", "d1", "2024-01-01 08:00:00", "e23"),
           log("2", "201907001", "d1", "2024-01-02 08:00:00", "e23"),
           log("3", "201713999", "d2", "2024-01-03 08:00:00", "e23")]
    clk = [log("9", "201808001", "d1", "2024-01-01 09:00:00", "e24")]
    root = scratch_path(spark, "p-in")
    days = ["20240101", "20240102", "20240103"]
    write_days(spark, f"{root}/imp", dict(zip(days, [[x] for x in imp], strict=True)))
    write_days(spark, f"{root}/clk", dict(zip(days, [clk, [], []], strict=True)))
    out = scratch_path(spark, "p-rows")
    daily.run_training_rows(spark, folders(f"{root}/imp", days), folders(f"{root}/clk", days), S, out, n_files=1)
    saved = spark.read.parquet(out)
    assert saved.count() == 3
    assert {r.day for r in saved.select("day").collect()} == {20240101, 20240102, 20240103}

    schema = ", ".join(f"{c} string" for c in CONTENT_COLUMNS)
    old = spark.createDataFrame([tuple(["201808001"] + ["old"] * 13)], schema)
    snaps = scratch_path(spark, "p-snap")
    path, m = daily.run_content_refresh(spark, out, "20240101", "20240102", old,
                                           *tables(spark), snaps, "202401", "202401031200")
    new = spark.read.parquet(path)
    # day 3 is outside the range; 201808001 is already known, 201907001 is new
    assert sorted(r.content_id for r in new.collect()) == ["201808001", "201907001"]
    assert m == {"total_ids": 2, "new_ids": 1, "found": 1}


def test_repair_job(spark):
    src = scratch_path(spark, "p-wrapped")
    spark.createDataFrame([("(201901001,a, )",), ("(x)",)], "value string").write.text(src)
    dst = daily.run_repair(spark, src, scratch_path(spark, "p-repaired"), n_files=1)
    assert sorted(r.value for r in spark.read.text(dst).collect()) == ["201901001,a, ", "x"]


def test_daily_jobs_text_rows(spark):
    imp = [log("1", "201808001", "d1", "2024-01-01 08:00:00", "e23"),
           log("2", "201907001", "d1", "2024-01-02 08:00:00", "e23")]
    root = scratch_path(spark, "pt-in")
    days = ["20240101", "20240102"]
    write_days(spark, f"{root}/imp", dict(zip(days, [[x] for x in imp], strict=True)))
    write_days(spark, f"{root}/clk", {d: [] for d in days})
    out = scratch_path(spark, "pt-rows")
    daily.run_training_rows(spark, folders(f"{root}/imp", days), folders(f"{root}/clk", days), S, out, fmt="text")
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == 2 and all(len(v.split(",")) == 39 for v in lines)
    assert sorted(v.split(",")[24] for v in lines) == ["201808001", "201907001"]
    schema = ", ".join(f"{c} string" for c in CONTENT_COLUMNS)
    old = spark.createDataFrame([tuple(["201808001"] + ["old"] * 13)], schema)
    path, m = daily.run_content_refresh(spark, out, "20240101", "20240102", old,
                                           *tables(spark), scratch_path(spark, "pt-snap"),
                                           "202401", "202401031200", rows_format="text")
    assert m["total_ids"] == 2 and m["new_ids"] == 1


def test_day_folders_are_listed_without_making_the_logs_again(spark, monkeypatch):
    monkeypatch.setattr(Q, "LOG_FILE_LINES", 10)
    made = spark.sparkContext.accumulator(0)

    def line(k):
        made.add(1)
        return f"line {k}"
    text = F.udf(line, "string").asNondeterministic()
    days = F.concat(F.lit("2024010"), (F.col("id") % 3 + 1).cast("string")).alias("folder_day")
    imp = spark.range(90).select(days, text("id").alias("value"))
    clk = spark.range(0, 30, 3).select(days, text("id").alias("value"))
    paths, found = Q._day_folders((imp, clk), spark)
    assert made.value == 100 and found == ["20240101", "20240102", "20240103"]
    assert [spark.read.text(p).count() for p in paths["imp"]] == [30] * 3
    assert [spark.read.text(p).count() for p in paths["clk"]] == [10, 0, 0]
    files = spark.read.text(paths["imp"][0])
    assert max(r["count"] for r in files.groupBy(F.input_file_name()).count().collect()) <= 10


def test_line_logs_of_both_sides_come_from_one_join(spark, tmp_path):
    """Same lines as a join of its own for each side gave; orders are read once."""
    day = "cast('{}' as timestamp_ntz)"
    items = [(1, 1, 7, "R", "2001-02-03 00:00:00"), (1, 2, 8, "N", "2001-02-14 10:00:00"), (2, 1, 7, None, "2001-02-28 00:00:00"),
             (2, 1, 7, "R", "2001-02-28 00:00:00"), (9, 1, 7, "R", "2001-02-28 00:00:00"), (None, 1, 7, "R", "2001-02-28 00:00:00")]
    (spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_suppkey long, l_returnflag string, at string")
     .selectExpr("*", "l_suppkey l_partkey", "1.0D l_quantity", "cast(at as timestamp_ntz) l_shipdate").drop("at").write.parquet(f"{tmp_path}/lineitem.parquet"))
    spark.sql(f"select 1L o_orderkey, {day.format('1998-11-05')} o_orderdate union all select 2L, {day.format('2000-01-31')}").write.parquet(f"{tmp_path}/orders.parquet")
    got = inputs.line_logs(spark, str(tmp_path))

    def text(order, line, dd, cid, key):
        return (f'{{"p1":"{order}-{line}","p3":"2024-01-{dd} 08:00:00","p17":"dev{7 if line == 1 else 8}",'
                f'"{key}":{{"e15":"{cid}","o2":{{"e30":0}}}}}}')
    want = [("imp", "20240103", text(1, 1, "03", "1998111", "e23")), ("clk", "20240103", text(1, 1, "03", "1998111", "e24")),
            ("imp", "20240114", text(1, 2, "14", "1998111", "e23")), ("clk", "20240128", text(2, 1, "28", "2000012", "e24"))]
    want += [("imp", "20240128", text(2, 1, "28", "2000012", "e23"))] * 2
    assert sorted((r.side, r.folder_day, r.value) for r in got.collect()) == sorted(want)
    assert sum("Join" in x for x in plan_text(got).split("\n")) == 1
    paths, days = Q._day_folders(got, spark)
    assert days == ["20240103", "20240114", "20240128"]
    assert [[spark.read.text(p).count() for p in paths[side]] for side in ("imp", "clk")] == [[1, 1, 2], [1, 0, 1]]


def test_a_snapshot_out_of_the_distinct_is_not_dealt_again(spark, monkeypatch):
    root, saved = scratch_path(spark, "once"), scratch_path(spark, "once-rows")
    write_days(spark, f"{root}/imp", {"20240101": [log("1", "201808001", "d", "2024-01-01 08:00:00", "e23")]})
    write_days(spark, f"{root}/clk", {"20240101": []})
    daily.run_training_rows(spark, folders(f"{root}/imp", ["20240101"]), folders(f"{root}/clk", ["20240101"]), S, saved)
    old = spark.createDataFrame([], ", ".join(f"{c} string" for c in CONTENT_COLUMNS))
    seen, write = [], daily.write_snapshot

    def noted(df, *args, rebalance=True, **more):
        seen.append(rebalance)
        return write(df, *args, rebalance=rebalance, **more)
    monkeypatch.setattr(daily, "write_snapshot", noted)
    for k, distinct in enumerate((False, True)):
        path, m = daily.run_content_refresh(spark, saved, "20240101", "20240101", old, *tables(spark), scratch_path(spark, "once-snap"),
                                            "202401", f"20240102000{k}", snapshot_is_distinct=distinct)
        assert spark.read.parquet(path).count() == 1 and m == {"total_ids": 1, "new_ids": 1, "found": 1}
    assert seen == [False, True]
