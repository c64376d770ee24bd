"""Exact rounding of ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions.coerce import col


def cents(c: Column | str) -> Column:
    """Two-decimal amount as a whole number of cents."""
    return (col(c) * 100).cast("decimal(38,0)")


def ratio(numerator: Column | str, denominator: Column | str, places: int = 2) -> Column:
    """``numerator / denominator`` of whole numbers, rounded half away from zero.

    Worked out in whole numbers, so a tie rounds the same way on every engine and partitioning.
    A zero denominator gives 0.
    """
    num = col(numerator).cast("decimal(38,0)")
    den = col(denominator).cast("decimal(38,0)")
    scaled = F.abs(num) * F.lit(2 * 10**places).cast("decimal(9,0)") + den
    whole = F.call_function("div", scaled.cast("decimal(38,0)"), (den * 2).cast("decimal(38,0)"))
    signed = F.when(num < 0, -whole).otherwise(whole).cast("decimal(20,0)")
    step = Decimal(1).scaleb(-places)
    value = (signed * F.lit(step)).cast(f"decimal(20,{places})")
    return F.when(den == 0, F.lit(0).cast(f"decimal(20,{places})")).otherwise(value)


def mean_amount(total: Column | str, count: Column | str, places: int = 2) -> Column:
    """Mean of a two-decimal amount, rounded exactly."""
    return ratio(cents(total), col(count).cast("decimal(20,0)") * 100, places)


def share_pct(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    """``100 * part / whole`` of two-decimal amounts."""
    return ratio(cents(part) * 100, cents(whole), places)
