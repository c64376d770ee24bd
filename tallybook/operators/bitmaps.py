"""Exact distinct counts that merge: bitmaps of surrogate keys, kept per group and stretch of keys.

A surrogate key is a small dense number, so the keys of a group are bits: one bitmap of 4 KB for each 32,768 keys that occur. Bitmaps
of several days or batches are or-ed, so the distinct keys of any range of days come from what is stored, not from the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"


def bitmaps_of(df: DataFrame, key: str, *by: str) -> DataFrame:
    """``by``, ``bucket`` and ``bits``: the keys that occur in each group. Null keys count nothing; keys are from 1 on."""
    known = df.filter(F.col(key).isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(key).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(BITS))


def merged(bitmaps: DataFrame, *by: str | Column) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_keys(bitmaps: DataFrame, name: str, *by: str) -> DataFrame:
    """Number of distinct keys of each group (of all, without ``by``)."""
    whole = merged(bitmaps, *by)
    return whole.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("bigint").alias(name))
