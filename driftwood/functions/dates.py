"""Date and time-text functions (day part, day/month labels, snapshot stamp)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FMT = "yyyyMMdd"
MONTH_FMT = "yyyyMM"
STAMP_FMT = "yyyyMMddHHmm"


def day_part(ts_text: Column) -> Column:
    """Day part of a log time text: trim, split on a space, first piece."""
    return F.element_at(F.split(F.trim(ts_text), " "), 1)


def date_label(run_date: Column, days_back, month: bool = False) -> Column:
    """``run_date`` minus ``days_back`` days as ``yyyyMMdd`` (or ``yyyyMM``).

    ``run_date`` is explicit so that a job is reproducible; the caller passes
    ``current_date()`` for "today".
    """
    n = days_back if isinstance(days_back, Column) else F.lit(int(days_back))
    return F.date_format(F.date_sub(run_date, n), MONTH_FMT if month else DAY_FMT)


def snapshot_stamp(ts: Column) -> Column:
    """Timestamp as the ``yyyyMMddHHmm`` folder stamp of a content snapshot."""
    return F.date_format(ts, STAMP_FMT)


def day_range(run_date: _dt.date, days: int, from_day: int = 0) -> tuple[_dt.date, _dt.date]:
    """Inclusive [start, end] of ``days`` days ending ``from_day`` days before
    ``run_date`` (``from_day=0`` includes ``run_date`` itself)."""
    end = run_date - _dt.timedelta(days=from_day)
    start = end - _dt.timedelta(days=days - 1)
    return start, end


def days_in_range(start: _dt.date, end: _dt.date) -> list[_dt.date]:
    """Every day from ``start`` to ``end`` inclusive."""
    return [start + _dt.timedelta(days=i) for i in range((end - start).days + 1)]
