"""Content-id tests: all-digit check and month-shard routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shard years that exist and the first month of the first
# year; both are parameters of ``shard_label``.
DEFAULT_YEARS = ("2018", "2019")
DEFAULT_START_YEAR = "2018"
DEFAULT_START_MONTH = 8
# Shards whose month number is below this have no publisher_score column.
DEFAULT_SCORE_FROM_MONTH = 8


def is_numeric(s: Column) -> Column:
    """True when every character is a decimal digit; the empty string is
    numeric, null is not."""
    return F.coalesce(s.rlike(r"^\p{Nd}*\z"), F.lit(False))


def shard_month(content_id: Column) -> Column:
    """Month number encoded in characters 5-6 of the id (null if unparsable)."""
    return F.substring(content_id, 5, 2).try_cast("int")


def shard_label(content_id: Column, years=DEFAULT_YEARS,
                start_year: str = DEFAULT_START_YEAR,
                start_month: int = DEFAULT_START_MONTH) -> Column:
    """``yyyy_MM`` label of the month shard holding ``content_id``, or null
    when the id cannot belong to any shard.

    Valid: length >= 6, year in ``years``, months of ``start_year`` from
    ``start_month`` on, month number <= 12 (month ``00`` passes, as in the
    source rule).
    """
    year = F.substring(content_id, 1, 4)
    month = shard_month(content_id)
    invalid = (
        content_id.isNull()
        | (F.length(content_id) < 6)
        | month.isNull()
        | ~year.isin(*years)
        | ((year == F.lit(start_year)) & (month < F.lit(start_month)))
        | (month > F.lit(12))
    )
    return F.when(~invalid, F.concat(year, F.lit("_"), F.substring(content_id, 5, 2)))


def shard_has_score(shard: Column, from_month: int = DEFAULT_SCORE_FROM_MONTH) -> Column:
    """Whether a shard's content table carries ``publisher_score``: the rule
    looks at the month number alone, so every year's early months lack it."""
    return F.substring(shard, 6, 2).try_cast("int") >= F.lit(from_month)


def valid_shards(years=DEFAULT_YEARS, start_year: str = DEFAULT_START_YEAR,
                 start_month: int = DEFAULT_START_MONTH) -> list[str]:
    """Every ``yyyy_MM`` shard label the rule accepts (months 01-12), e.g.
    the month tables a lookup may need to read."""
    out = []
    for y in years:
        for m in range(1, 13):
            if y == start_year and m < start_month:
                continue
            out.append(f"{y}_{m:02d}")
    return out
