"""The log job on one parse a line.

A line that may be kept is parsed once, to a ``VARIANT`` column ``doc``.  The
strategy test, the pairing key, the 39 columns and the text rendering (which
tells an absent key from a null one) all read ``doc``, and ``doc`` itself is
carried through the aggregates, so no stage reads the line again.

Where ``operators.logs`` and this module differ: a ``VARIANT`` holds numbers
by value, so a number that is written in another form than Spark's
(``1.50``, ``1e3``) is rendered as Spark writes it; of an object its keys
are in order; a line that names a key twice is no JSON; and records that
agree in log time and record id are settled by a hash of the line, then
arbitrarily among lines of one hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CLICK_KEY, E2_FIELDS, IMPRESSION_KEY, LOG_SCHEMA, PAIR_SCHEMA, TOP_FIELDS, TRAINING_COLUMNS
from .logs import CLICK, IMP, PAIR_KEY, default_order, strategy_filter, with_pair_key


def parse_variant(text: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """JSON lines (``value``) -> ``*keep, doc, line_hash``; ``doc`` is null
    where the line is no JSON.  The parse goes through a one-row generator:
    a filter on ``doc`` pushed below it would parse the line once more."""
    row = F.struct(*keep, F.try_parse_json("value").alias("doc"), F.xxhash64("value").alias("line_hash"))
    return text.select(F.inline(F.array(row)))


def with_log(docs: DataFrame, schema=LOG_SCHEMA) -> DataFrame:
    """Add the ``log`` struct that ``operators.logs`` works on, read from ``doc``."""
    return docs.withColumn("log", F.try_variant_get("doc", "$", schema.simpleString()))


def kept_docs(text: DataFrame, side_key: str, code: int, keep: Sequence[str] = ()) -> DataFrame:
    """``*keep, doc, line_hash, log`` (pairing fields only) of the lines that
    carry ``side_key`` and the strategy ``code``."""
    docs = parse_variant(text.where(F.col("value").contains(side_key)), keep)
    e30 = F.try_variant_get("doc", f"$.{side_key}.o2.e30", "string").try_cast("int")
    return strategy_filter(with_log(docs.where(e30 == F.lit(code)), PAIR_SCHEMA), side_key, code)


def pair_docs(impressions: DataFrame, clicks: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Deduplicated and paired records of both sides (as ``dedup_clicks`` and
    ``click_label`` do): ``content_id, device_id, day, *keep, is_click, side,
    doc``, one row a key."""
    order = [*default_order(), F.col("line_hash")]
    own = with_pair_key(clicks, side_key=CLICK_KEY).groupBy(*PAIR_KEY, *keep).agg(
        F.min_by(F.struct("doc", "line_hash", "log"), F.struct(*order)).alias("_r"))
    one = own.select(*keep, "_r.doc", "_r.line_hash", "_r.log")

    def side(docs: DataFrame, is_click: int) -> DataFrame:
        return with_pair_key(docs).select(*PAIR_KEY, *keep, F.lit(is_click).alias("_clk"), "doc",
                                          F.struct(F.lit(is_click), *order).alias("_o"))

    g = side(impressions, 0).unionByName(side(one, 1)).groupBy(*PAIR_KEY, *keep).agg(
        F.min_by("doc", "_o").alias("doc"), F.min("_clk").alias("_lo"), F.max("_clk").alias("_hi"),
        F.sum("_clk").alias("_clicks"))
    paired = (F.col("_lo") < F.col("_hi")) | (F.col("_clicks") > 1)
    return g.select(*PAIR_KEY, *keep, F.when(paired, 1).otherwise(0).alias("is_click"),
                    F.when(F.col("_lo") == 0, IMP).otherwise(CLICK).alias("side"), "doc")


def flatten_variant_text(labelled: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Labelled ``doc`` records -> the 39 columns as one comma-joined
    ``value``, as ``flatten_text``: columns 1-17 are ``null`` when absent or
    null, a later one is empty when its key is absent and ``null`` when it is
    there with a null."""
    null = F.lit("null")
    log = F.try_variant_get("doc", "$", LOG_SCHEMA.simpleString())
    src = labelled.select(F.inline(F.array(F.struct(*keep, "is_click", "doc", log.alias("log")))))

    def there(path: str) -> Column:
        return F.try_variant_get("doc", f"$.{path}", "variant").isNotNull()

    def shown(path: str) -> Column:
        """The value; only where there is none, whether its key is there."""
        return F.coalesce(F.col(f"log.{path}"), F.when(there(path), null).otherwise(""))

    def of_item(path: str) -> Column:
        return (F.when(F.col(f"log.{IMPRESSION_KEY}").isNotNull(), shown(f"{IMPRESSION_KEY}.{path}"))
                .otherwise(shown(f"{CLICK_KEY}.{path}")))

    parts = [F.col("is_click").cast("string"), *(F.coalesce(F.col(f"log.{n}"), null) for n in TOP_FIELDS)]
    parts += [shown(f"p30.{n}") for n in ("p31", "p32", "p33")]
    parts += [F.when(F.col("log.p30.e11").isNotNull() | there("p30.e11"), F.coalesce("log.e11", null)).otherwise("")]
    parts += [of_item(n) for n in ("e12", "e14", "e15")]
    parts += [of_item(f"o2.{n}") for n in ("e31", "e35", "e36", "e37.l1", "e37.l2", "e38")]
    parts += [shown(f"e2.{n}") for n in E2_FIELDS]
    assert len(parts) == len(TRAINING_COLUMNS)
    return src.select(F.concat_ws(",", *parts).alias("value"), *keep)
