"""Command-line entry points (``spark-submit --py-files driftwood.zip driftwood_job.py <command> ...``
or ``python -m driftwood.cli``), one per job of the source system:

``training-rows``    logs of ``--days`` days ending ``--from-day`` days ago ->
                     training rows partitioned by month/day
``content-refresh``  saved rows of the same window -> new content snapshot
``content-vectors``  content snapshot + word vectors -> (id, tags vector,
                     title vector)
``repair``           wrapped snapshot text -> unwrapped text

Paths, the strategy code, the shard rule and the snapshot location are
arguments (the source kept them in a configuration object that is not
available).  The run date defaults to today.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from .functions.dates import day_range, days_in_range
from .functions.ids import DEFAULT_START_MONTH, DEFAULT_START_YEAR, DEFAULT_YEARS, valid_shards
from .operators.vectors import first_vectors_unpartitioned
from .plans import daily
from .plans.jobs import content_vectors
from .schemas import CONTENT_COLUMNS, T_CONTENT_COLUMNS, T_NEWS_COLUMNS, T_SIGNAL_COLUMNS
from .sources.content import read_shards_jdbc, read_shards_parquet
from .session import cluster_builder
from .sources.logs import day_paths
from .sources.sinks import balanced
from .sources.text_rows import read_positional
from .sources.vectors import read_vectors


def _window(a) -> tuple[dt.date, dt.date]:
    run = dt.date.fromisoformat(a.run_date) if a.run_date else dt.date.today()
    return day_range(run, a.days, a.from_day)


def _add_window(p: argparse.ArgumentParser) -> None:
    p.add_argument("--days", type=int, default=1, help="number of days")
    p.add_argument("--from-day", type=int, default=0, help="0 = today, 1 = yesterday, ...")
    p.add_argument("--run-date", default=None, help="yyyy-mm-dd; default today")


def _read_snapshot(spark: SparkSession, path: str, fmt: str):
    if fmt == "text":
        return read_positional(spark, path, CONTENT_COLUMNS, null_text="null")
    return spark.read.parquet(path)


def cmd_training_rows(spark: SparkSession, a) -> dict:
    start, end = _window(a)
    days = days_in_range(start, end)
    imp = day_paths(a.imp_prefix, days, a.suffix)
    clk = day_paths(a.clk_prefix, days, a.suffix)
    out = daily.run_training_rows(spark, imp, clk, a.strategy, a.out, n_files=a.files,
                                     fmt=a.format, publish=a.publish)
    return {"out": out, "start": str(start), "end": str(end)}


def _shards(a) -> list[str]:
    return a.shards or valid_shards(tuple(a.years), a.start_year, a.start_month)


def _content_tables(spark: SparkSession, a) -> list:
    if a.jdbc_url:
        shards = _shards(a)
        props = json.loads(a.jdbc_props) if a.jdbc_props else {}
        cols = (T_CONTENT_COLUMNS, T_SIGNAL_COLUMNS, T_NEWS_COLUMNS)
        names = (a.content, a.signal, a.news)
        return [read_shards_jdbc(spark, a.jdbc_url, n, shards, c, props, num_partitions=a.jdbc_partitions,
                                 partition_column=a.jdbc_column, bounds=a.jdbc_bounds and tuple(a.jdbc_bounds))
                for n, c in zip(names, cols)]
    return [read_shards_parquet(spark, p) for p in (a.content, a.signal, a.news)]


def cmd_content_refresh(spark: SparkSession, a) -> dict:
    start, end = _window(a)
    tables = _content_tables(spark, a)
    old = _read_snapshot(spark, a.snapshot, a.snapshot_format)
    stamp = a.stamp or dt.datetime.now().strftime("%Y%m%d%H%M")
    path, metrics = daily.run_content_refresh(
        spark, a.rows, start.strftime("%Y%m%d"), end.strftime("%Y%m%d"), old, *tables,
        a.snapshot_root, stamp[:6], stamp, shards=_shards(a), n_files=a.files, snapshot_is_distinct=a.snapshot_is_distinct, rows_format=a.rows_format,
        published=a.published_rows,
        years=tuple(a.years), start_year=a.start_year, start_month=a.start_month)
    return {"snapshot": path, **metrics}


def cmd_content_vectors(spark: SparkSession, a) -> dict:
    rows = _read_snapshot(spark, a.snapshot, a.snapshot_format)
    # one vector per word (first in the file), keeping the raw layout
    vocab = first_vectors_unpartitioned(read_vectors(spark, a.vectors))
    out = content_vectors(rows, vocab, a.dim)
    balanced(out, a.files).write.mode("errorifexists").parquet(a.out)
    return {"out": a.out}


def cmd_repair(spark: SparkSession, a) -> dict:
    return {"out": daily.run_repair(spark, a.src, a.dst, n_files=a.files)}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="driftwood")
    sub = ap.add_subparsers(dest="command", required=True)

    p = sub.add_parser("training-rows")
    _add_window(p)
    p.add_argument("--imp-prefix", required=True, help="impression logs: <prefix>yyyyMMdd<suffix>")
    p.add_argument("--clk-prefix", required=True, help="click logs: <prefix>yyyyMMdd<suffix>")
    p.add_argument("--suffix", default="")
    p.add_argument("--strategy", type=int, required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--files", type=int, default=None, help="fixed output file count (coalesce)")
    p.add_argument("--format", choices=["parquet", "text"], default="parquet",
                   help="text = comma-joined positional rows")
    p.add_argument("--publish", default=None, metavar="STAMP",
                   help="publish the days as a whole under this stamp (newest stamp wins); --files does not apply")
    p.set_defaults(fn=cmd_training_rows)

    p = sub.add_parser("content-refresh")
    _add_window(p)
    p.add_argument("--rows", required=True, help="training rows written by training-rows")
    p.add_argument("--rows-format", choices=["parquet", "text"], default="parquet")
    p.add_argument("--published-rows", action="store_true", help="read the days published by training-rows --publish only")
    p.add_argument("--snapshot", required=True, help="previous snapshot")
    p.add_argument("--snapshot-format", choices=["parquet", "text"], default="parquet")
    p.add_argument("--snapshot-is-distinct", action="store_true")
    p.add_argument("--content", required=True,
                   help="t_content: parquet partitioned by shard, or the JDBC table prefix")
    p.add_argument("--signal", required=True, help="t_signal: parquet path or JDBC table prefix")
    p.add_argument("--news", required=True, help="t_news_manager: parquet path or JDBC table prefix")
    p.add_argument("--jdbc-url", default=None,
                   help="read <prefix>_<yyyy_MM> tables over JDBC for every valid month")
    p.add_argument("--jdbc-props", default=None, help='JSON of reader options, e.g. {"user": "..."}')
    p.add_argument("--jdbc-column", default=None, help="numeric column by which a month is read in parts")
    p.add_argument("--jdbc-bounds", nargs=2, type=int, default=None)
    p.add_argument("--jdbc-partitions", type=int, default=None)
    p.add_argument("--shards", nargs="+", default=None,
                   help="months (yyyy_MM) that may be asked for; default every valid one")
    p.add_argument("--snapshot-root", required=True)
    p.add_argument("--stamp", default=None, help="yyyyMMddHHmm; default now")
    p.add_argument("--years", nargs="+", default=list(DEFAULT_YEARS))
    p.add_argument("--start-year", default=DEFAULT_START_YEAR)
    p.add_argument("--start-month", type=int, default=DEFAULT_START_MONTH)
    p.add_argument("--files", type=int, default=None, help="fixed file count; default adaptive")
    p.set_defaults(fn=cmd_content_refresh)

    p = sub.add_parser("content-vectors")
    p.add_argument("--snapshot", required=True)
    p.add_argument("--snapshot-format", choices=["parquet", "text"], default="parquet")
    p.add_argument("--vectors", required=True, help="word-vector text: word v1 ... vd")
    p.add_argument("--dim", type=int, default=300)
    p.add_argument("--out", required=True)
    p.add_argument("--files", type=int, default=None, help="fixed file count; default adaptive")
    p.set_defaults(fn=cmd_content_vectors)

    p = sub.add_parser("repair")
    p.add_argument("--src", required=True)
    p.add_argument("--dst", required=True)
    p.add_argument("--files", type=int, default=None, help="fixed file count; default as read")
    p.set_defaults(fn=cmd_repair)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = spark or cluster_builder(f"driftwood-{a.command}").getOrCreate()
    result = a.fn(spark, a)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
