"""Accepted date spellings."""

import datetime

import pytest
from pyspark.sql import functions as F
from tallybook.functions.coerce import to_moment


@pytest.mark.parametrize("text,second", [("01-Dec-2010 08:26:05", 5), ("1-Dec-2010 8:26", 0), ("12/1/2010 8:26:05", 5)])
def test_named_month_with_seconds(spark, text, second):
    got = spark.range(1).select(to_moment(F.lit(text)).alias("m")).first().m
    assert got == datetime.datetime(2010, 12, 1, 8, 26, second)
