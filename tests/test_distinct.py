"""Bitmaps and sketches of distinct keys, exact and within the stated error."""

import pytest
from pyspark.sql import functions as F
from tallybook.operators import bitmaps, sketches


@pytest.fixture(scope="module")
def visits(spark):
    """A million keys over days, a third of the rows of one key, keys beyond one bitmap, and nulls."""
    key = F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 1000 == 1, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(200_000)) + 1)
    return spark.range(0, 300_000, 1, 8).select((F.col("id") % 20).cast("int").alias("day"), key.alias("k"))


def test_bitmaps_merge_over_days(visits):
    stored = bitmaps.bitmaps_of(visits, "k", "day")
    for low, high in ((0, 19), (3, 3), (4, 11), (30, 40)):
        days = F.col("day").between(low, high)
        want = visits.filter(days).agg(F.count_distinct("k")).first()[0]
        assert bitmaps.distinct_keys(stored.filter(days), "n").first()[0] == want
    by_day = {r["day"]: r["n"] for r in bitmaps.distinct_keys(stored, "n", "day").collect()}
    assert by_day == {r["day"]: r["n"] for r in visits.groupBy("day").agg(F.count_distinct("k").alias("n")).collect()}


def test_bitmaps_of_the_same_keys_count_once(visits):
    twice = bitmaps.bitmaps_of(visits, "k", "day").unionAll(bitmaps.bitmaps_of(visits, "k", "day"))
    assert bitmaps.distinct_keys(twice, "n").first()[0] == visits.agg(F.count_distinct("k")).first()[0]
    assert bitmaps.bitmaps_of(visits.limit(0), "k", "day").count() == 0


def test_sketches_stay_within_their_error(visits):
    stored = sketches.distinct_sketches(visits, "k", "day")
    for low, high in ((0, 19), (4, 11)):
        days = F.col("day").between(low, high)
        want = visits.filter(days).agg(F.count_distinct("k")).first()[0]
        got = sketches.estimated_distinct(stored.filter(days), "n").first()[0]
        assert abs(got - want) <= 4 * sketches.distinct_error() * want
    shares = [0.1, 0.5, 0.9]
    values = sorted(r[0] for r in visits.filter("k is not null").select("k").collect())
    got = sketches.estimated_percentiles(visits.filter("k is not null"), "k", shares, accuracy=1000).first()["percentiles"]
    for share, value in zip(shares, got):  # the rank is near; equal values hold a stretch of ranks
        low, high = sum(v < value for v in values), sum(v <= value for v in values)
        assert low - len(values) / 1000 <= share * len(values) <= high + len(values) / 1000
