"""The daily jobs end to end, with storage between them.

1. ``run_training_rows``: impression + click log text of any day folders ->
   training rows written partitioned by ``month``/``day`` of the scanned
   folder (only the days of these folders are replaced).
2. ``run_content_refresh``: the saved rows of a day range (partition
   pruning) -> ids new to the previous snapshot -> lookup -> new snapshot in
   a fresh stamped folder.  Totals (ids seen, new ids, rows fetched) are
   collected with ``DataFrame.observe`` during that one write instead of
   separate counting jobs.
3. ``run_repair``: saved rows wrapped in parentheses -> unwrapped text.

Each step reads what the previous one wrote, so a lost executor only
recomputes within one step, and the snapshot being read is never the one
being written.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.content import (content_lookup, distinct_ids, ids_from_text_rows, new_ids,
                                 snapshot_merge)
from ..operators.logs import CLICK, IMP, KEPT, MALFORMED, NO_SIDE, OTHER_STRATEGY
from ..schemas import CONTENT_COLUMNS, DAY_SCHEMA, DAY_TEXT_SCHEMA
from ..sources.days import folder_days, publish_days, read_published
from ..sources.logs import read_day_logs, read_day_range
from ..sources.sinks import write_partitioned, write_snapshot, write_text
from .jobs import rejected_lines, repair_snapshot, training_rows_by_day


def run_training_rows(spark: SparkSession, imp_paths: str | Iterable[str],
                      clk_paths: str | Iterable[str], strategy: int, out_root: str,
                      n_files: int | None = None, fmt: str = "parquet", publish: str | None = None) -> str:
    """``fmt="text"`` writes the comma-joined positional rows the source
    wrote (``flatten_text``) instead of typed parquet columns.  Each path is
    a day folder (or below one); a missing one fails the job.  With
    ``publish`` (the run's stamp) the days are published as a whole once all
    are written (``sources.days``), and no earlier file is touched."""
    if publish:
        imp_paths, clk_paths = ([p] if isinstance(p, str) else list(p) for p in (imp_paths, clk_paths))
        days = folder_days([*imp_paths, *clk_paths])
    rows = training_rows_by_day(read_day_logs(spark, imp_paths), read_day_logs(spark, clk_paths),
                                strategy, text=fmt == "text")
    if publish:
        publish_days(rows, out_root, publish, days, fmt)
    else:
        write_partitioned(rows, out_root, ["month", "day"], fmt=fmt, n_files=n_files,
                          rebalance=n_files is None)
    return out_root


def run_rejects(spark: SparkSession, imp_paths: str | Iterable[str], clk_paths: str | Iterable[str], strategy: int,
                out_root: str) -> dict[str, int]:
    """Write the lines that ``run_training_rows`` drops, by folder day, side
    and reason, and return how many lines were read, kept and dropped for
    each reason, observed during that write: a bad collector day shows."""
    lines = rejected_lines(read_day_logs(spark, imp_paths), read_day_logs(spark, clk_paths), strategy, keep=("folder_day",))
    seen = Observation("line_fates")
    by_side = [F.when(F.col("side") == side, F.col("fate")).alias(f"_{side}") for side in (IMP, CLICK)]
    counts = [F.count(f"_{side}").alias(f"{side}_read") for side in (IMP, CLICK)]
    counts += [F.count_if(F.col(f"_{side}") == fate).alias(f"{side}_{fate}") for side in (IMP, CLICK)
               for fate in (KEPT, MALFORMED, NO_SIDE, OTHER_STRATEGY)]
    dropped = lines.select("*", *by_side).observe(seen, *counts).where(F.col("fate") != KEPT)
    write_partitioned(dropped.select("value", F.col("folder_day").alias("day"), "side", "fate"), out_root,
                      ["day", "side", "fate"], rebalance=True)
    return dict(seen.get)


def run_content_refresh(spark: SparkSession, training_root: str, start_day: str, end_day: str,
                        old_snapshot: DataFrame, t_content: DataFrame, t_signal: DataFrame,
                        t_news: DataFrame, snapshot_root: str, month: str, stamp: str,
                        n_files: int | None = None, snapshot_is_distinct: bool = False,
                        shards: list[str] | None = None, rows_format: str = "parquet", published: bool = False,
                        **shard_rule) -> tuple[str, dict]:
    """``rows_format="text"`` reads positional text rows and takes the id
    from field 24, as the source did.  With ``published`` only days that a
    run has published are read."""
    if published:
        schema = DAY_TEXT_SCHEMA if rows_format == "text" else DAY_SCHEMA
        saved = read_published(spark, training_root, start_day, end_day, schema, fmt=rows_format)
    else:
        saved = read_day_range(spark, training_root, start_day, end_day, fmt=rows_format)
    if rows_format == "text":
        saved = ids_from_text_rows(saved)
    ids = distinct_ids(saved.select("content_id"))
    seen, fetched = Observation("ids_seen"), Observation("rows_fetched")
    ids = ids.observe(seen, F.count(F.lit(1)).alias("total_ids"))
    fresh = new_ids(ids, old_snapshot)
    # the ids' lineage is the saved rows and the snapshot: read once, then from the shared folder
    looked = content_lookup(fresh, t_content, t_signal, t_news, ids_distinct=True, shards=shards,
                            checkpoint_ids=True, with_found=True, **shard_rule)
    looked = looked.observe(fetched, F.count(F.lit(1)).alias("new_ids"),
                            F.count_if("_found").alias("found"))
    merged = snapshot_merge(looked, old_snapshot.select(*CONTENT_COLUMNS),
                            disjoint_distinct=snapshot_is_distinct)
    # the distinct has dealt the rows; only a plain union has the layout of its inputs
    path = write_snapshot(merged, snapshot_root, month, stamp, n_files=n_files, rebalance=snapshot_is_distinct)
    return path, {**seen.get, **fetched.get}


def run_repair(spark: SparkSession, src_path: str, dst_path: str, n_files: int | None = None) -> str:
    """Narrow map job: without ``n_files`` the output keeps the input's split layout."""
    write_text(repair_snapshot(spark.read.text(src_path)), dst_path, n_files=n_files,
               mode="errorifexists")
    return dst_path
