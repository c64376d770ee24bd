"""Standardise clean lines and drop copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.calendar import date_key
from tallybook.functions.coerce import col, strip, title_case, to_moment, to_number, to_whole
from tallybook.schemas import GUEST_ID, LINE_KEYS, SOURCE_COLUMNS

def standardise(clean: DataFrame) -> DataFrame:
    return clean.select(
        strip("InvoiceNo").alias("InvoiceNo"),
        F.upper(strip("StockCode")).alias("StockCode"),
        F.upper(strip(F.coalesce(col("Description"), F.lit("UNKNOWN_PRODUCT")))).alias("Description"),
        title_case(strip(F.coalesce(col("Country"), F.lit("United Kingdom")))).alias("Country"),
        to_moment("InvoiceDate").alias("InvoiceDate"),
        to_number("Quantity").try_cast("int").alias("Quantity"),
        to_number("UnitPrice").try_cast("decimal(10,2)").alias("UnitPrice"),
        F.coalesce(to_whole("CustomerID"), F.lit(GUEST_ID)).alias("customer_id"),
        *[c for c in (*SOURCE_COLUMNS, "batch_id") if c in clean.columns],
    )


def drop_copies(lines: DataFrame, keys: Sequence[str] = LINE_KEYS, first_by: Sequence[str] = ()) -> DataFrame:
    """Keep one line per key: the lowest by ``first_by`` (say file and row), else by its content.

    An aggregate, so copies collapse before the shuffle however many there are of one line.
    """
    rest = [c for c in lines.columns if c not in keys]
    ordered = [*first_by, *[c for c in rest if c not in first_by]]
    kept = lines.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}") for c in lines.columns])


def derive(lines: DataFrame, batch_id: Column | str) -> DataFrame:
    amount = (col("Quantity") * col("UnitPrice")).cast("decimal(12,2)")
    cancelled = F.upper(col("InvoiceNo")).startswith("C") | (col("Quantity") < 0)
    return lines.withColumns(
        {
            "date_key": date_key("InvoiceDate"),
            "total_amount": amount,
            "is_cancelled": cancelled,
            "batch_id": F.lit(batch_id) if isinstance(batch_id, str) else batch_id,
        })


def clean_and_transform(clean: DataFrame, batch_id: Column | str | None = None) -> DataFrame:
    """Standardised, deduplicated lines with amount, flags and batch.

    Lines delivered in batches keep their ``batch_id``, and copies collapse within a batch only.
    """
    lines = standardise(clean)
    keys = [*LINE_KEYS, *[c for c in ("batch_id",) if c in lines.columns]]
    lines = drop_copies(lines, keys, first_by=[c for c in SOURCE_COLUMNS if c in lines.columns])
    return derive(lines.drop(*SOURCE_COLUMNS), F.col("batch_id") if batch_id is None else batch_id)
