"""Opt-in estimates that merge, beside the exact counts and percentiles (which stay the default).

Distinct counts: HyperLogLog sketches of 2 ** ``LOG_BUCKETS`` buckets, with a standard error of about 1.04 / sqrt(2 ** LOG_BUCKETS).
Percentiles: Spark's quantile summaries, whose rank is off by at most n / accuracy.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS = 12
ACCURACY = 10_000


def distinct_error(log_buckets: int = LOG_BUCKETS) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / math.sqrt(1 << log_buckets)


def distinct_sketches(df: DataFrame, key: str, *by: str, log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """``by`` and ``sketch``, to be stored per day or batch; null keys count nothing."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(key, log_buckets).alias("sketch"))


def estimated_distinct(sketches: DataFrame, name: str, *by: str) -> DataFrame:
    """Estimate for coarser groups, from stored sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def estimated_percentiles(df: DataFrame, column: str, shares: list[float], *by: str, accuracy: int = ACCURACY) -> DataFrame:
    """Values near the given shares of the sorted column, each a value that occurs."""
    return df.groupBy(*by).agg(F.percentile_approx(column, shares, accuracy).alias("percentiles"))
