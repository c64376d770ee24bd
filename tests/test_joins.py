import pytest
from pyspark.sql import functions as F
from tallybook.operators.joins import fits_broadcast, hot_keys, lookup_join


@pytest.fixture
def sides(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 700)
    left = spark.range(0, 9000, 1, 4).select("id", key.alias("k"))
    right = spark.range(0, 650).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return left, right


def test_hot_keys_are_few(sides):
    assert set(hot_keys(sides[0], "k", 0.1)) == {1}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_shuffled_lookup_equals_plain_join(sides, how):
    left, right = sides
    assert not fits_broadcast(right, 10) and fits_broadcast(right, 650)
    ours = lookup_join(left, right, "k", how, max_rows=10)
    assert "BroadcastHashJoin" in lookup_join(left, right, "k", how)._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(
        map(tuple, left.join(right, "k", how).collect()), key=repr)


def test_hot_null_keys_are_spread(spark):
    left = spark.range(0, 3000, 1, 4).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"))
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") + 1).alias("w"))
    assert None in hot_keys(left, "k", 0.1)
    ours = lookup_join(left, right, "k", "left", max_rows=1)
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(
        map(tuple, left.join(right, "k", "left").collect()), key=repr)


def test_null_keys_stay_in_a_left_lookup(spark):
    left = spark.createDataFrame([(1, None), (2, 5)], "id int, k bigint")
    right = spark.range(3, 9).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    assert sorted(map(tuple, lookup_join(left, right, "k", max_rows=1).collect()), key=repr) == [(5, 2, "x"), (None, 1, None)]
