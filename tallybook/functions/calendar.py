"""Calendar parts and elapsed time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.coerce import col


def date_key(ts: Column | str) -> Column:
    """``YYYYMMDD`` as an integer."""
    c = col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def year_month(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour periods from ``start`` to ``end``, rounded down (not a calendar difference)."""
    micros = F.timestamp_diff("MICROSECOND", col(start), col(end))
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")


def calendar_parts(day: Column | str) -> dict[str, Column]:
    d = col(day)
    weekday = F.weekday(d)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d),
        "day_of_week": (weekday + 1).cast("int"),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": weekday >= 5,
    }
