"""Published days: whole days only, whatever a stopped or later run leaves."""

import os

import pytest

from driftwood.plans import daily
from driftwood.schemas import CONTENT_COLUMNS, DAY_SCHEMA
from driftwood.session import scratch_path
from driftwood.sources import days as P

from .test_content import tables
from .test_daily import folders, write_days
from .test_logs import S, log

SCHEMA = "v long, month string, day string"


def rows(spark, *pairs):
    return spark.createDataFrame([(v, d[:6], d) for v, d in pairs], SCHEMA)


def read(spark, root, start="00000000", end="99999999"):
    return sorted((r.v, r.day) for r in P.read_published(spark, root, start, end, SCHEMA).collect())


def test_the_newest_published_run_of_a_day_counts(spark):
    root = scratch_path(spark, "pub")
    assert read(spark, root) == [] and P.published_days(spark, root, "0", "9") == {}
    assert P.publish_days(rows(spark, (1, "20240131"), (2, "20240201")), root, "01", ["20240131", "20240201", "20240202"]) == [
        "20240131", "20240201"]
    assert read(spark, root) == [(1, "20240131"), (2, "20240201")]
    assert read(spark, root, "20240201", "20240202") == [(2, "20240201")]
    held = P.read_published(spark, root, "0", "9", SCHEMA)
    # a day run again is replaced as a whole, another by no rows, and a reader keeps what it had
    P.publish_days(rows(spark, (3, "20240131"), (4, "20240131")), root, "02", ["20240131", "20240201"])
    assert read(spark, root) == [(3, "20240131"), (4, "20240131")]
    assert P.published_days(spark, root, "20240201", "99999999") == {"20240201": None, "20240202": None}
    assert held.count() == 2
    # an older stamp published late does not win
    P.publish_days(rows(spark, (9, "20240131")), root, "015", ["20240131"])
    assert read(spark, root) == [(3, "20240131"), (4, "20240131")]
    with pytest.raises(ValueError, match="is published"):
        P.publish_days(rows(spark, (5, "20240131")), root, "02", ["20240131"])


def test_a_stopped_writer_leaves_nothing_to_read(spark, monkeypatch):
    root = scratch_path(spark, "stopped")
    P.publish_days(rows(spark, (1, "20240131")), root, "1", ["20240131"])
    # stopped while writing its rows: a day that is not listed fails the write half way
    with pytest.raises(Exception, match="not published: 20240302"):
        P.publish_days(rows(spark, *[(k, "20240131") for k in range(50)], (7, "20240302")), root, "2", ["20240131"])
    assert read(spark, root) == [(1, "20240131")]
    # stopped after its rows, before its manifest
    P.stage_days(rows(spark, (2, "20240131"), (3, "20240201")), root, "2")
    # stopped while the manifest was written: its file is there, its end is not
    os.makedirs(os.path.join(root.removeprefix("file:"), "manifests", "2"))
    with open(os.path.join(root.removeprefix("file:"), "manifests", "2", "part-0.json"), "w") as f:
        f.write('{"day": "20240131"}')
    assert read(spark, root) == [(1, "20240131")] and P.published_runs(spark, root) == ["1"]
    # the same run again replaces its remains
    P.publish_days(rows(spark, (4, "20240201")), root, "2", ["20240201"])
    assert read(spark, root) == [(1, "20240131"), (4, "20240201")]


def test_days_of_paths():
    assert P.folder_days(["/a/20240102/part", "x/day=20240101", "hdfs:///l/20240102"]) == ["20240101", "20240102"]
    with pytest.raises(ValueError, match="no day folder"):
        P.folder_days(["/a/2024010*/part"])


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_refresh_reads_published_days_only(spark, fmt):
    root, out = scratch_path(spark, "pub-in"), scratch_path(spark, "pub-out")
    days = ["20240101", "20240102"]
    for side, lines in (("imp", [[log("1", "201808001", "d", "2024-01-01 08:00:00", "e23")],
                                 [log("2", "201907001", "d", "2024-01-02 08:00:00", "e23")]]), ("clk", [[], []])):
        write_days(spark, f"{root}/{side}", dict(zip(days, lines, strict=True)))
    daily.run_training_rows(spark, folders(f"{root}/imp", days[:1]), folders(f"{root}/clk", days[:1]), S, out, fmt=fmt, publish="1")
    if fmt == "parquet":
        assert P.read_published(spark, out, *days, DAY_SCHEMA).count() == 1
    old = spark.createDataFrame([], ", ".join(f"{c} string" for c in CONTENT_COLUMNS))

    def refresh(stamp):
        return daily.run_content_refresh(spark, out, *days, old, *tables(spark), scratch_path(spark, "pub-snap"), "202401", stamp,
                                         rows_format=fmt, published=True)[1]
    assert refresh("202401020000")["total_ids"] == 1
    daily.run_training_rows(spark, folders(f"{root}/imp", days), folders(f"{root}/clk", days), S, out, fmt=fmt, publish="2")
    assert refresh("202401030000")["total_ids"] == 2
