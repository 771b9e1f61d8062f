"""Registered queries: one per operator of the inventory, each running the
library operator over stand-in inputs derived from the supplied tables
(``plans.inputs``).  Vector results are summarised (element sum, L2 norm,
position-weighted sum, dimension, rounded) so they compare as scalars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from .. import operators as op
from .. import sources as src
from ..schemas import (CLICK_KEY, CONTENT_COLUMNS, DAY_SCHEMA, IMPRESSION_KEY, TRAINING_COLUMNS,
                       TRAINING_SCHEMA)
from ..session import scratch_path
from ..sources import days as published
from ..sources import versions
from ..sources.logs import read_day_logs
from . import daily, jobs
from . import inputs as inp

DIM = inp.VECTOR_DIM
Query = Callable[[SparkSession, str], DataFrame]


def _r(c: Column) -> Column:
    # +0.0 folds -0.0 into 0.0
    return F.round(c, 4) + F.lit(0.0)


def vec_summary(c: Column, p: str) -> list[Column]:
    return [
        _r(fn.element_sum(c)).alias(f"{p}_sum"),
        _r(fn.l2_norm(c)).alias(f"{p}_l2"),
        _r(fn.element_sum(c, weighted=True)).alias(f"{p}_wsum"),
        F.size(c).cast("bigint").alias(f"{p}_dim"),
    ]


# ------------------------------------------------------------------ logs

def _parsed_lines(spark, sf):
    imp, clk = inp.log_text(spark, sf)
    return src.parse_logs(imp), src.parse_logs(clk)


def q_log_scan(spark, sf):
    imp, clk = _parsed_lines(spark, sf)
    both = imp.unionByName(clk)
    log = F.col("log")
    return both.select(
        log["p1"].alias("p1"), log["p5"].alias("p5"),
        log[IMPRESSION_KEY].isNotNull().alias("has_imp"),
        log[CLICK_KEY].isNotNull().alias("has_click"),
        op.logs.item_of(log)["o2"]["e30"].alias("e30"))


def _filtered(spark, sf):
    imp_t, clk_t = inp.log_text(spark, sf)

    def side(t, key):
        pre = op.strategy_prefilter(t, key, inp.STRATEGY)
        return op.strategy_filter(src.parse_logs(pre), key, inp.STRATEGY)
    return side(imp_t, IMPRESSION_KEY), side(clk_t, CLICK_KEY)


def q_strategy_filter(spark, sf):
    imp, clk = _filtered(spark, sf)
    return (imp.select(F.col("log.p1").alias("p1"), F.lit("imp").alias("side"))
            .unionByName(clk.select(F.col("log.p1").alias("p1"), F.lit("click").alias("side"))))


def q_reject_totals(spark, sf):
    """Lines by side and fate: what was read is what was kept and dropped."""
    lines = jobs.rejected_lines(*inp.log_text(spark, sf), inp.STRATEGY)
    return lines.groupBy("side", "fate").agg(F.count(F.lit(1)).alias("n"))


def q_pair_key(spark, sf):
    imp, clk = _filtered(spark, sf)
    u = imp.unionByName(clk)
    return op.with_pair_key(u).select(F.col("log.p1").alias("p1"), "content_id", "device_id", "day")


def q_dedup_daily(spark, sf):
    out = [op.dedup_daily(op.with_pair_key(t)).select("content_id", "device_id", "day", F.lit(side).alias("side"),
                                                      F.col("log.p1").alias("log_id"))
           for t, side in zip(_filtered(spark, sf), ("imp", "click"), strict=True)]
    return out[0].unionByName(out[1])


def _labelled(spark, sf):
    imp_t, clk_t = inp.log_text(spark, sf)
    return jobs.labelled_logs(imp_t, clk_t, inp.STRATEGY)


def q_click_label(spark, sf):
    return _labelled(spark, sf).select("content_id", "device_id", "day", "is_click", "side",
                                       F.col("log.p1").alias("log_id"))


def q_label_json(spark, sf):
    lab = _labelled(spark, sf)
    txt = op.label_json(lab, keep=("content_id", "device_id", "day"))
    return txt.select("content_id", "device_id", "day",
                      F.get_json_object("value", "$.isClick").alias("is_click"),
                      F.get_json_object("value", "$.log.p1").alias("log_id"))


def q_flatten_log(spark, sf):
    """Flatten every labelled record, all strategies (no strategy filter)."""
    imp, clk = _parsed_lines(spark, sf)
    imp = op.with_pair_key(imp.where(F.col("log")[IMPRESSION_KEY].isNotNull()))
    clk = op.with_pair_key(clk.where(F.col("log")[CLICK_KEY].isNotNull()))
    return op.flatten_log(op.click_label(imp, clk))


def q_training_rows(spark, sf):
    imp_t, clk_t = inp.log_text(spark, sf)
    return jobs.training_rows(imp_t, clk_t, inp.STRATEGY)


def q_flatten_log_text(spark, sf):
    return op.flatten_text(_labelled(spark, sf))


def q_training_rows_variant(spark, sf):
    """Training rows, each line parsed once."""
    return jobs.training_rows_variant(*inp.log_text(spark, sf), inp.STRATEGY)


def q_flatten_text_variant(spark, sf):
    """Text rows, absent and null keys told apart from the one parse."""
    return jobs.training_rows_variant(*inp.log_text(spark, sf), inp.STRATEGY, text=True)


def q_split_field(spark, sf):
    txt = op.flatten_text(_labelled(spark, sf))
    return txt.select(fn.split_field(F.col("value"), 1).alias("p1"),
                      fn.split_field(F.col("value"), 24).alias("content_id"))


def q_csv_roundtrip(spark, sf):
    rows = q_training_rows(spark, sf)
    path = scratch_path(spark, "training-csv")
    rows.write.mode("errorifexists").option("header", "false").csv(path)
    return src.read_csv(spark, path, TRAINING_SCHEMA)


def q_sink_partitioned(spark, sf):
    imp_t, clk_t = inp.log_text(spark, sf)
    rows = jobs.training_rows_by_day(imp_t, clk_t, inp.STRATEGY)
    path = scratch_path(spark, "training-by-day")
    src.write_partitioned(rows, path, ["month", "day"], rebalance=True)
    return spark.read.schema(DAY_SCHEMA).parquet(path).select(*TRAINING_COLUMNS, "month", "day")


#: A compressed file is read as a whole; files of so many lines keep a reading task small.
LOG_FILE_LINES = 50_000


def _day_folders(logs: DataFrame | tuple[DataFrame, DataFrame], spark) -> tuple[dict[str, list[str]], list[str]]:
    """Both sides (impressions and clicks, or one table with their ``side``)
    written as ``<side>/<day folder>``, as log collectors do; a day that one
    side lacks gets an empty folder there.  Returns the paths of each side by
    day (as many as there are days) and the days, both as the written folders
    have them: the logs are not made again to list them."""
    root, sides = scratch_path(spark, "day-logs"), ("imp", "clk")
    if isinstance(logs, tuple):
        imp, clk = (t.select(F.lit(side).alias("side"), "folder_day", "value") for side, t in zip(sides, logs, strict=True))
        logs = imp.unionByName(clk)
    (logs.select("side", "folder_day", "value").write.partitionBy("side", "folder_day").option("compression", "gzip")
     .option("maxRecordsPerFile", LOG_FILE_LINES).text(root))
    have = {side: set() for side in sides}
    for f in spark.read.text(root).inputFiles():
        side, day = f.split("/side=")[1].split("/")[:2]
        have[side].add(day.removeprefix("folder_day="))
    days = sorted(have["imp"] | have["clk"])
    for side, found in have.items():
        for d in set(days) - found:
            spark.createDataFrame([], "value string").write.text(f"{root}/side={side}/folder_day={d}")
    return {side: [f"{root}/side={side}/folder_day={d}" for d in days] for side in sides}, days


def q_daily_rows(spark, sf):
    """The writer job over two windows of day folders, one after the other;
    some lines of a day are logged in the next day's folder."""
    paths, days = _day_folders(inp.log_text(spark, sf), spark)
    out = scratch_path(spark, "daily-rows")
    cut = (len(days) + 1) // 2
    for part in (slice(0, cut), slice(cut, None)):
        if paths["imp"][part]:
            daily.run_training_rows(spark, paths["imp"][part], paths["clk"][part], inp.STRATEGY, out)
    return spark.read.schema(DAY_SCHEMA).parquet(out).select(*TRAINING_COLUMNS, "month", "day")


def q_published_rows(spark, sf):
    """The writer job publishing all days, the first half of them once more,
    and a run that stopped after writing; read back as published."""
    paths, days = _day_folders(inp.log_text(spark, sf), spark)
    out = scratch_path(spark, "published-rows")
    half = (len(days) + 1) // 2
    for stamp, n in (("1", len(days)), ("2", half)):
        if n:
            daily.run_training_rows(spark, paths["imp"][:n], paths["clk"][:n], inp.STRATEGY, out, publish=stamp)
    if days:
        logs = [read_day_logs(spark, paths[side][:1]) for side in ("imp", "clk")]
        published.stage_days(jobs.training_rows_by_day(*logs, inp.STRATEGY), out, "3")
    return published.read_published(spark, out, "00000000", "99999999", DAY_SCHEMA)


REFRESH_START, REFRESH_END = "20240101", "20240120"


def _refresh_chain(spark, sf):
    """Logs -> saved rows -> refresh of a day range of them -> new snapshot."""
    paths, _ = _day_folders(inp.line_logs(spark, sf), spark)
    rows = scratch_path(spark, "chain-rows")
    daily.run_training_rows(spark, paths["imp"], paths["clk"], inp.STRATEGY, rows)
    return daily.run_content_refresh(spark, rows, REFRESH_START, REFRESH_END, _old_snapshot(spark, sf),
                                     *inp.content_tables(spark, sf), scratch_path(spark, "chain-snapshots"),
                                     "202401", "202401311200", **inp.SHARD_RULE)


def q_refresh_from_rows(spark, sf):
    return spark.read.parquet(_refresh_chain(spark, sf)[0])


def q_refresh_totals(spark, sf):
    totals = _refresh_chain(spark, sf)[1]
    return spark.createDataFrame([tuple(totals[k] for k in ("total_ids", "new_ids", "found"))],
                                 "total_ids long, new_ids long, found long")


def q_repaired_rows(spark, sf):
    """Saved rows in parentheses -> the repair job's text, read back."""
    text = op.render_content_text(op.content_row(op.content_join3(*inp.content_tables(spark, sf))))
    path = scratch_path(spark, "wrapped")
    src.write_text(text.select(F.concat(F.lit("("), "value", F.lit(")")).alias("value")), path, mode="errorifexists")
    return src.read_positional(spark, daily.run_repair(spark, path, scratch_path(spark, "repaired")), CONTENT_COLUMNS)


def q_day_part(spark, sf):
    e = inp.table(spark, sf, "events")
    return e.select("event_id", fn.day_part(F.concat(F.lit("  "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))).alias("day"))


def q_date_label(spark, sf):
    e = inp.table(spark, sf, "events")
    n = (F.get_json_object("props", "$.k").try_cast("int") % 10)
    run = F.to_date("ts")
    return e.select("event_id",
                    fn.date_label(run, n).alias("day_label"),
                    fn.date_label(run, n, month=True).alias("month_label"),
                    fn.snapshot_stamp(F.col("ts")).alias("stamp"))


def _day_partitioned_logs(spark, sf) -> str:
    imp, clk = inp.log_text(spark, sf)
    path = scratch_path(spark, "logs-by-day")
    both = imp.withColumn("side", F.lit("imp")).unionByName(clk.withColumn("side", F.lit("click")))
    both.select("side", "day", "value").write.mode("errorifexists").partitionBy("side", "day").text(path)
    return path


RANGE_START, RANGE_END = "20240105", "20240111"


def q_day_range_scan(spark, sf):
    path = _day_partitioned_logs(spark, sf)
    rng = src.read_day_range(spark, path, RANGE_START, RANGE_END, fmt="text")
    p = src.parse_logs(rng)
    return p.select("side", "day", F.col("log.p1").alias("p1"))


def q_multi_path_scan(spark, sf):
    root = _day_partitioned_logs(spark, sf)
    paths = [f"{root}/side=*/day={{20240103,20240110}}", f"{root}/side=*/day=2024012*"]
    df = src.read_log_text(spark, paths)
    p = src.parse_logs(df.select("value"))
    return (p.select(fn.day_part(F.col("log.p3")).alias("day"))
            .where(F.col("day").isNotNull())
            .groupBy("day").agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------- content

def q_is_numeric(spark, sf):
    o = inp.table(spark, sf, "orders")
    cid = inp.content_id_of(F.col("o_orderdate"), F.col("o_orderkey"))
    return o.select("o_orderkey",
                    fn.is_numeric(cid).alias("id_numeric"),
                    fn.is_numeric(F.col("o_orderpriority")).alias("priority_numeric"),
                    fn.is_numeric(F.substring("o_orderpriority", 1, 1)).alias("prefix_numeric"),
                    fn.is_numeric(F.regexp_replace("o_orderpriority", r"\D", "")).alias("digits_numeric"))


def q_shard_route(spark, sf):
    o = inp.table(spark, sf, "orders")
    cid = inp.content_id_of(F.col("o_orderdate"), F.col("o_orderkey"))
    s = inp.routed_shard(cid)
    return o.select("o_orderkey", cid.alias("content_id"), s.alias("shard"),
                    F.coalesce(fn.shard_has_score(s), F.lit(False)).alias("has_score"))


def q_distinct_ids(spark, sf):
    return op.distinct_ids(inp.log_content_ids(spark, sf))


def q_new_ids(spark, sf):
    return op.new_ids(op.distinct_ids(inp.log_content_ids(spark, sf)), inp.snapshot_ids(spark, sf))


def q_known_ids(spark, sf):
    return op.known_ids(op.distinct_ids(inp.log_content_ids(spark, sf)), inp.snapshot_ids(spark, sf))


def q_id_counts(spark, sf):
    ids, known = inp.log_content_ids(spark, sf), inp.snapshot_ids(spark, sf)
    fresh = op.new_ids(op.distinct_ids(ids), known)
    looked = op.content_lookup(fresh, *inp.content_tables(spark, sf), ids_distinct=True, with_found=True, **inp.SHARD_RULE)
    counts = op.id_counts(ids, known).withColumn("fetched_rows", F.lit(0).cast("long"))
    fetched = looked.agg(F.count_if("_found").alias("fetched_rows"))
    none = [F.lit(0).cast("long").alias(c) for c in ("total_ids", "new_ids", "known_ids")]
    both = counts.unionByName(fetched.select(*none, "fetched_rows"))
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def q_content_join3(spark, sf):
    j = op.content_join3(*inp.content_tables(spark, sf))
    return j.select("content_id", "shard", "image_auditstate", "content_words_num", "ero_cal_result")


def q_content_row(spark, sf):
    return op.content_row(op.content_join3(*inp.content_tables(spark, sf)))


def _lookup(ids, spark, sf, ids_distinct=False):
    return op.content_lookup(ids, *inp.content_tables(spark, sf), ids_distinct=ids_distinct,
                             **inp.SHARD_RULE)


def q_content_lookup(spark, sf):
    fresh = op.new_ids(op.distinct_ids(inp.log_content_ids(spark, sf)), inp.snapshot_ids(spark, sf))
    return _lookup(fresh, spark, sf, ids_distinct=True)


def _new(spark, sf):
    return op.new_ids(op.distinct_ids(inp.log_content_ids(spark, sf)), inp.snapshot_ids(spark, sf))


def q_sharded_lookup(spark, sf):
    """Tables in month folders: only the months of the requested ids are read."""
    return op.content_lookup(_new(spark, sf), *inp.shard_tables(spark, sf), ids_distinct=True, by_month=True,
                             **inp.SHARD_RULE)


def q_stored_lookup(spark, sf):
    """Tables in month folders with buckets by id: no content is shuffled.
    The requested ids are found once and read back by the scans and the join."""
    return op.content_lookup(_new(spark, sf), *inp.store_tables(spark, sf), ids_distinct=True, by_month=True,
                             by_bucket=True, checkpoint_ids=True, **inp.SHARD_RULE)


def q_stored_join3(spark, sf):
    j = op.stored_join3(*inp.store_tables(spark, sf))
    return j.select("content_id", "shard", "image_auditstate", "content_words_num", "ero_cal_result")


def q_new_ids_filtered(spark, sf):
    ids = op.distinct_ids(inp.log_content_ids(spark, sf))
    return op.new_ids_filtered(ids, inp.snapshot_ids(spark, sf), n_ids=ids.count())


def q_content_lookup_all(spark, sf):
    return _lookup(inp.log_content_ids(spark, sf).select("content_id"), spark, sf)


def _old_snapshot(spark, sf):
    # order keys are unique, so the snapshot ids are distinct
    return _lookup(inp.snapshot_ids(spark, sf), spark, sf, ids_distinct=True)


def q_content_refresh(spark, sf):
    return jobs.content_refresh(inp.log_content_ids(spark, sf), _old_snapshot(spark, sf),
                                *inp.content_tables(spark, sf), **inp.SHARD_RULE)


def q_incremental_snapshot(spark, sf):
    """The old snapshot as a first version, the looked-up new ids as a second one."""
    root = scratch_path(spark, "versions")
    # one bucket a month: the stand-in has 80 small months
    versions.write_version(spark, root, "202401300000", _old_snapshot(spark, sf), buckets=1)
    versions.write_version(spark, root, "202401310000", q_content_lookup(spark, sf), buckets=1)
    return versions.read_version(spark, root)


def _slice(spark, sf, lo, hi):
    o = inp.table(spark, sf, "orders").where(
        F.col("o_orderdate").between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))
    return _lookup(o.select(inp.content_id_of(F.col("o_orderdate"), F.col("o_orderkey")).alias("content_id")),
                   spark, sf, ids_distinct=True)


# two overlapping parts that together hold every order
PARTS = (("1998-06-01", "9999-12-31"), ("0001-01-01", "1998-12-31"))


def q_snapshot_merge(spark, sf):
    return op.snapshot_merge(*(_slice(spark, sf, *p) for p in PARTS))


def q_dedup_content(spark, sf):
    a, b = (_slice(spark, sf, *p) for p in PARTS)
    b = b.withColumn("image_auditstate", F.lower("image_auditstate"))
    return op.dedup_content(op.snapshot_merge(a, b))


def q_sink_snapshot(spark, sf):
    text = op.render_content_text(q_content_refresh(spark, sf))
    root = scratch_path(spark, "snapshots")
    path = src.write_snapshot(text, root, "202401", "202401311200", fmt="text")
    return src.read_positional(spark, path, CONTENT_COLUMNS)


def q_location_fields(spark, sf):
    s = inp.t_signal(spark, sf)
    loc = fn.location_fields(F.col("local"))
    return s.select("content_id", loc["country"].alias("country"), loc["city"].alias("city"),
                    loc["state"].alias("state"))


def q_first_group_key(spark, sf):
    s = inp.t_signal(spark, sf)
    return s.select("content_id", fn.first_key(F.col("group_id")).alias("group_key"))


def q_format_tags(spark, sf):
    s = inp.t_signal(spark, sf)
    return s.select("content_id", fn.format_content_tags(F.col("tags")).alias("tags"),
                    fn.format_title_tags(F.col("tags_title")).alias("tags_title"))


def q_parse_tags(spark, sf):
    s = inp.t_signal(spark, sf).select("content_id", fn.format_content_tags(F.col("tags")).alias("t"))
    return op.tag_tokens(s, "t", ["content_id"])


def q_parse_keywords(spark, sf):
    return op.keyword_segments(inp.keyword_rows(spark, sf), "keywords", ["o_orderkey"])


def q_unwrap_parens(spark, sf):
    p = inp.table(spark, sf, "pages")
    return p.select("page_id", fn.unwrap_parens(F.col("html")).alias("inner"))


# --------------------------------------------------------------- vectors

def q_vector_table_scan(spark, sf):
    path = scratch_path(spark, "vectors")
    src.write_text(inp.vector_text(spark, sf), path, mode="errorifexists")
    v = src.read_vectors(spark, path)
    return v.select("word", *vec_summary(F.col("vec"), "vec"))


def q_vector_lookup_one(spark, sf):
    r = jobs.word_norm(inp.vectors(spark, sf), "7")
    return r.select("word", _r(F.col("l2")).alias("l2"))


def q_vector_norms(spark, sf):
    n = op.vector_norms(inp.vectors(spark, sf))
    return n.select("word", _r(F.col("l1")).alias("l1"), _r(F.col("l2")).alias("l2"))


def q_token_vectors(spark, sf):
    t = op.token_vectors(inp.line_tokens(spark, sf), inp.vectors(spark, sf), DIM)
    return t.select("l_orderkey", "l_linenumber", *vec_summary(F.col("vec"), "vec"))


def q_token_vectors_broadcast(spark, sf):
    t = op.token_vectors_broadcast(inp.line_tokens(spark, sf), inp.vectors(spark, sf), DIM)
    return t.select("l_orderkey", "l_linenumber", *vec_summary(F.col("vec"), "vec"))


def q_tag_vector(spark, sf):
    t = op.tag_vector(inp.line_tokens(spark, sf), inp.vectors(spark, sf), "l_orderkey", DIM)
    return t.select("l_orderkey", *vec_summary(F.col("vec"), "vec"))


def q_tag_vector_hot(spark, sf):
    """A word of a seventh of all tokens is joined map-side."""
    toks = inp.hot_tokens(spark, sf)
    t = op.tag_vector(toks, inp.vectors(spark, sf), "l_orderkey", DIM, hot=op.hot_words(toks))
    return t.select("l_orderkey", *vec_summary(F.col("vec"), "vec"))


def q_tag_vector_wide(spark, sf):
    """At the source's 300 dimensions."""
    toks = inp.line_tokens(spark, sf)
    t = op.tag_vector(toks, inp.wide_vectors(spark, sf), "l_orderkey", inp.WIDE_DIM, n_tokens=toks.count())
    return t.select("l_orderkey", *vec_summary(F.col("vec"), "vec"))


def q_content_vectors_wide(spark, sf):
    rows = op.content_row(op.content_join3(*inp.content_tables(spark, sf)))
    v = jobs.content_vectors(rows, inp.wide_vectors(spark, sf), inp.WIDE_DIM)
    return v.select("content_id", *vec_summary(F.col("tags_vec"), "tags"), *vec_summary(F.col("title_vec"), "title"))


def q_content_vectors(spark, sf):
    rows = op.content_row(op.content_join3(*inp.content_tables(spark, sf)))
    # ids come in two versions and as repeated rows, as snapshots hold them
    rows = rows.unionByName(rows.where("content_id LIKE '%7'").withColumn("tags", F.concat("tags", F.lit(" 7=2")))) \
        .unionByName(rows.where("content_id LIKE '%3'"))
    v = jobs.content_vectors(rows, inp.vectors(spark, sf), DIM)
    return v.select("content_id", *vec_summary(F.col("tags_vec"), "tags"),
                    *vec_summary(F.col("title_vec"), "title"))


def q_category_vector(spark, sf):
    k = inp.keyword_rows(spark, sf)
    k = k.unionByName(k.where("o_orderkey % 10 = 7").withColumn("title", F.concat("title", F.lit(" 9=3")))) \
        .unionByName(k.where("o_orderkey % 10 = 3"))
    v = op.category_vector(k, inp.vectors(spark, sf), DIM, "o_orderkey", "keywords", "title", n_rows=k.count())
    return v.select("o_orderkey", *vec_summary(F.col("vec"), "vec"))


def q_cosine_pairs(spark, sf):
    toks = inp.line_tokens(spark, sf)
    # Both vectors of an order come out of one aggregate; the cosine is then
    # a row-wise expression (no second aggregate, no join).
    v = op.tag_vectors_multi(toks, inp.vectors(spark, sf), ["l_orderkey"], "l_returnflag", ["A", "R"], DIM)
    return v.select("l_orderkey", _r(fn.cosine(F.col("A_vec"), F.col("R_vec"))).alias("cosine"))


QUERIES: dict[str, Query] = {
    "log_scan": q_log_scan,
    "strategy_filter": q_strategy_filter,
    "reject_totals": q_reject_totals,
    "pair_key": q_pair_key,
    "dedup_daily": q_dedup_daily,
    "click_label": q_click_label,
    "label_json": q_label_json,
    "flatten_log": q_flatten_log,
    "training_rows": q_training_rows,
    "flatten_log_text": q_flatten_log_text,
    "training_rows_variant": q_training_rows_variant,
    "flatten_text_variant": q_flatten_text_variant,
    "split_field": q_split_field,
    "csv_roundtrip": q_csv_roundtrip,
    "sink_partitioned": q_sink_partitioned,
    "daily_rows": q_daily_rows,
    "published_rows": q_published_rows,
    "refresh_from_rows": q_refresh_from_rows,
    "refresh_totals": q_refresh_totals,
    "repaired_rows": q_repaired_rows,
    "day_part": q_day_part,
    "date_label": q_date_label,
    "day_range_scan": q_day_range_scan,
    "multi_path_scan": q_multi_path_scan,
    "is_numeric": q_is_numeric,
    "shard_route": q_shard_route,
    "distinct_ids": q_distinct_ids,
    "new_ids": q_new_ids,
    "known_ids": q_known_ids,
    "id_counts": q_id_counts,
    "content_join3": q_content_join3,
    "content_row": q_content_row,
    "content_lookup": q_content_lookup,
    "sharded_lookup": q_sharded_lookup,
    "stored_lookup": q_stored_lookup,
    "stored_join3": q_stored_join3,
    "new_ids_filtered": q_new_ids_filtered,
    "content_lookup_all": q_content_lookup_all,
    "content_refresh": q_content_refresh,
    "incremental_snapshot": q_incremental_snapshot,
    "snapshot_merge": q_snapshot_merge,
    "dedup_content": q_dedup_content,
    "sink_snapshot": q_sink_snapshot,
    "location_fields": q_location_fields,
    "first_group_key": q_first_group_key,
    "format_tags": q_format_tags,
    "parse_tags": q_parse_tags,
    "parse_keywords": q_parse_keywords,
    "unwrap_parens": q_unwrap_parens,
    "vector_table_scan": q_vector_table_scan,
    "vector_lookup_one": q_vector_lookup_one,
    "vector_norms": q_vector_norms,
    "token_vectors": q_token_vectors,
    "token_vectors_broadcast": q_token_vectors_broadcast,
    "tag_vector": q_tag_vector,
    "tag_vector_hot": q_tag_vector_hot,
    "tag_vector_wide": q_tag_vector_wide,
    "content_vectors_wide": q_content_vectors_wide,
    "content_vectors": q_content_vectors,
    "category_vector": q_category_vector,
    "cosine_pairs": q_cosine_pairs,
}


# Which inventory rows each registered query exercises.
INVENTORY: dict[str, tuple[str, ...]] = {
    "log_scan": ("S1", "S4", "X6"),
    "strategy_filter": ("F1", "F2", "F3"),
    "reject_totals": ("F3",),
    "pair_key": ("P1", "X1"),
    "dedup_daily": ("A1", "A8"),
    "click_label": ("J1", "A1", "A3", "A8", "U1"),
    "label_json": ("P4",),
    "flatten_log": ("P2", "X6"),
    "training_rows": ("S1", "F1", "F2", "J1", "P2"),
    "flatten_log_text": ("P3",),
    "training_rows_variant": ("S1", "F1", "F2", "J1", "P1", "P2"),
    "flatten_text_variant": ("P3", "X6"),
    "split_field": ("P5", "S5"),
    "csv_roundtrip": ("S5",),
    "sink_partitioned": ("K1",),
    "daily_rows": ("G1", "K1", "S2", "S3"),
    "published_rows": ("G1", "K1", "G5"),
    "refresh_from_rows": ("G1", "G2", "G5", "K1", "K2"),
    "refresh_totals": ("A5", "G5"),
    "repaired_rows": ("G4", "K3", "P7"),
    "day_part": ("X1",),
    "date_label": ("X2", "X3"),
    "day_range_scan": ("S2", "S3"),
    "multi_path_scan": ("S4",),
    "is_numeric": ("F4",),
    "shard_route": ("F5", "X4", "X5"),
    "distinct_ids": ("A2",),
    "new_ids": ("J4", "U3"),
    "known_ids": ("J4",),
    "id_counts": ("A5",),
    "content_join3": ("J2",),
    "content_row": ("P6", "X5", "X7", "X8", "X9"),
    "content_lookup": ("S6", "J3", "L1", "L3", "U4"),
    "sharded_lookup": ("S6", "J3", "L1"),
    "stored_lookup": ("S6", "J2", "J3"),
    "stored_join3": ("J2",),
    "new_ids_filtered": ("J4", "U3"),
    "content_lookup_all": ("S9", "J3"),
    "content_refresh": ("G2", "J4", "U2", "A4"),
    "incremental_snapshot": ("U2", "A4", "K2"),
    "snapshot_merge": ("U2", "A4"),
    "dedup_content": ("A4",),
    "sink_snapshot": ("K2",),
    "location_fields": ("X7",),
    "first_group_key": ("X8",),
    "format_tags": ("X9",),
    "parse_tags": ("X10",),
    "parse_keywords": ("X11", "F7"),
    "unwrap_parens": ("P7",),
    "vector_table_scan": ("S7", "S8", "X17"),
    "vector_lookup_one": ("F6", "L2", "G6", "X14"),
    "vector_norms": ("X14", "X15"),
    "token_vectors": ("J5", "X12"),
    "token_vectors_broadcast": ("J6",),
    "tag_vector": ("A6", "X13"),
    "tag_vector_hot": ("A6", "J5"),
    "tag_vector_wide": ("A6", "X13"),
    "content_vectors_wide": ("P8", "G3", "A6"),
    "content_vectors": ("P8", "G3", "A6", "X10"),
    "category_vector": ("A7", "F7", "X11", "X13"),
    "cosine_pairs": ("X16", "X14"),
}
assert set(INVENTORY) == set(QUERIES)
for _name, _fn in QUERIES.items():
    _fn.__doc__ = " ".join(filter(None, [_fn.__doc__, f"Inventory rows: {', '.join(INVENTORY[_name])}."]))
