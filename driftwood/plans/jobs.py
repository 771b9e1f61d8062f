"""Composed jobs.  Each returns a lazy DataFrame; the caller decides where it
is written (``sources.sinks``), so one job is one plan and one action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import unwrap_parens
from ..functions.vectors import l2_norm
from ..operators.content import (content_lookup, distinct_ids, new_ids, snapshot_merge)
from ..operators.logs import (CLICK, IMP, PAIR_KEY, click_label, dedup_clicks, flatten_log, flatten_text, line_fate,
                              strategy_filter, strategy_prefilter, with_pair_key)
from ..operators.variant_logs import flatten_variant_text, kept_docs, pair_docs, with_log
from ..operators.vectors import content_vectors as _content_vectors
from ..operators.vectors import vector_lookup_one
from ..schemas import CLICK_KEY, IMPRESSION_KEY, PAIR_SCHEMA
from ..sources.logs import parse_logs


def labelled_logs(imp_text: DataFrame, clk_text: DataFrame, strategy: int,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines of both sides -> one labelled record per (content, device,
    day, *keep): strategy pre-test on the text, the pairing fields of the
    kept lines parsed, exact strategy test, pairing in one aggregate that
    carries the raw line, and one full parse of the surviving lines.
    ``keep`` columns are part of the key.  Clicks are deduplicated by the
    content id of their own object before they are paired by that of the
    impression object, if the line holds one; the clicks' own shuffle is the
    small one of the two sides."""
    def parse(text: DataFrame) -> DataFrame:
        return parse_logs(text, schema=PAIR_SCHEMA, keep_value=True)

    def side(text: DataFrame, key: str) -> DataFrame:
        return strategy_filter(parse(strategy_prefilter(text.select(*keep, "value"), key, strategy)), key, strategy)
    clicks = dedup_clicks(side(clk_text, CLICK_KEY), keep, parse=parse)
    paired = click_label(with_pair_key(side(imp_text, IMPRESSION_KEY)), clicks,
                         [*PAIR_KEY, *keep], keep_col="value", clicks_distinct=True)
    return parse_logs(paired, keep_value=True)


def rejected_lines(imp_text: DataFrame, clk_text: DataFrame, strategy: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """``side, fate, *keep, value`` of every line of both sides, kept ones too."""
    def side(text: DataFrame, key: str, name: str) -> DataFrame:
        parsed = parse_logs(text.select(*keep, "value"), schema=PAIR_SCHEMA, keep_value=True)
        return line_fate(parsed, key, strategy).select(F.lit(name).alias("side"), "fate", *keep, "value")
    return side(imp_text, IMPRESSION_KEY, IMP).unionByName(side(clk_text, CLICK_KEY, CLICK))


def training_rows(imp_text: DataFrame, clk_text: DataFrame, strategy: int) -> DataFrame:
    """Impression and click log lines -> the 39-column training rows, one per
    (content, device, day)."""
    return flatten_log(labelled_logs(imp_text, clk_text, strategy))


def training_rows_variant(imp_text: DataFrame, clk_text: DataFrame, strategy: int, text: bool = False) -> DataFrame:
    """``training_rows`` on one parse a line (``operators.variant_logs``);
    ``text``: the rows as comma-joined ``value``, as ``flatten_text``."""
    lab = pair_docs(kept_docs(imp_text, IMPRESSION_KEY, strategy), kept_docs(clk_text, CLICK_KEY, strategy))
    return flatten_variant_text(lab) if text else flatten_log(with_log(lab))


def training_rows_by_day(imp_text: DataFrame, clk_text: DataFrame, strategy: int, text: bool = False) -> DataFrame:
    """Training rows plus ``month``/``day`` folder columns.  Every scanned
    day folder (``folder_day``) is paired by itself and written to its own
    day, whatever times its lines carry, so a late line neither changes a
    finished day nor depends on how many days one run takes; lines without a
    usable time stay in their folder's day.  ``text``: rows as ``value``."""
    lab = labelled_logs(imp_text, clk_text, strategy, keep=("folder_day",))
    folder = {"month": F.substring("folder_day", 1, 6), "day": F.col("folder_day")}
    if text:
        return flatten_text(lab, keep=("folder_day",)).withColumns(folder).drop("folder_day")
    return flatten_log(lab, keep=("folder_day",)).withColumns(folder).drop("folder_day")


def content_refresh(log_rows: DataFrame, snapshot: DataFrame, t_content: DataFrame,
                    t_signal: DataFrame, t_news: DataFrame, id_col: str = "content_id",
                    snapshot_is_distinct: bool = False, **shard_rule) -> DataFrame:
    """New snapshot = old snapshot union the content rows of ids seen in the
    logs but not yet in the snapshot (whole-row distinct).  Only new ids
    are looked up; the lookup is a join, not a per-id query.

    Looked-up rows carry ids absent from the snapshot and one row per id, so
    when the old snapshot is known to be distinct (it was written by this
    job) ``snapshot_is_distinct=True`` skips the whole-snapshot shuffle."""
    ids = distinct_ids(log_rows.select(F.col(id_col).alias("content_id")))
    fresh = new_ids(ids, snapshot)
    looked_up = content_lookup(fresh, t_content, t_signal, t_news, ids_distinct=True, **shard_rule)
    return snapshot_merge(looked_up, snapshot, disjoint_distinct=snapshot_is_distinct)


def content_vectors(content_rows: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """Job G3: content rows -> ``(content_id, tags_vec, title_vec)``.  The
    rows are counted first (their columns are not read for it), so that the
    sums of a task stay in memory however many there are."""
    return _content_vectors(content_rows, vectors, dim, n_rows=content_rows.count())


def repair_snapshot(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Saved rows wrapped as ``( ... )`` -> the text inside the first
    parentheses."""
    return lines.select(unwrap_parens(F.col(value_col)).alias(value_col))


def word_norm(vectors: DataFrame, key: str) -> DataFrame:
    """Single word's vector and its L2 norm."""
    return vector_lookup_one(vectors, key).select("word", l2_norm(F.col("vec")).alias("l2"))
