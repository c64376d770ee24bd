import datetime

import pytest
from pyspark.sql import functions as F
from tallybook.functions import business
from tallybook.functions.calendar import calendar_parts, date_key, elapsed_days
from tallybook.functions.coerce import is_blank, strip, title_case, to_moment, to_number, to_whole
from tallybook.functions.money import ratio, share_pct

TEXTS = ["o'neil-smith", "EIRE", " united kingdom ", "hong\tkong", "3d x1y", "", "channel islands", "a.b c", " x ",
         "café-au LAIT", "\x1fq\x85", "  "]


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column).first()[0]


@pytest.mark.parametrize("text", TEXTS)
def test_strip_and_title_follow_python(spark, text):
    assert one(spark, strip("x"), x=text) == text.strip()
    assert one(spark, title_case(strip("x")), x=text) == text.strip().title()


@pytest.mark.parametrize("text, number", [
    ("1.5", 1.5), (" 12 ", 12.0), ("1e3", 1000.0), ("-3", -3.0), ("1d", None), ("2f", None), ("0x1p3", None),
    ("abc", None), ("", None), ("inf", None)])
def test_numbers(spark, text, number):
    assert one(spark, to_number("x"), x=text) == number


def test_whole_and_blank(spark):
    assert one(spark, to_whole("x"), x="17850.0") == 17850
    assert one(spark, to_whole("x"), x="nan") is None
    assert [one(spark, is_blank("x"), x=t) for t in ("", " ", "NaN", " nan ", "None", "a")] == [
        True, True, True, True, False, False]
    assert spark.range(1).select(is_blank(F.lit(None).cast("string"))).first()[0]


def test_moments(spark):
    assert one(spark, to_moment("x"), x="2010-12-01 08:26:00") == datetime.datetime(2010, 12, 1, 8, 26)
    assert one(spark, to_moment("x"), x="not-a-date") is None
    assert one(spark, date_key(to_moment("x")), x="2010-12-01 08:26:00") == 20101201


def test_elapsed_days_are_whole_periods(spark):
    days = elapsed_days(to_moment("a"), to_moment("b"))
    assert one(spark, days, a="2010-12-07 14:57:00", b="2011-01-26 14:30:00") == 49
    assert one(spark, days, a="2010-12-07 14:30:00", b="2011-01-26 14:30:00") == 50


def test_calendar(spark):
    parts = calendar_parts(F.lit("2010-12-05").cast("date"))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    assert row == {"year": 2010, "quarter": 4, "month": 12, "month_name": "December", "day": 5, "day_of_week": 7,
                   "day_name": "Sunday", "is_weekend": True}


@pytest.mark.parametrize("score, segment", [
    ("555", "Champions"), ("444", "Champions"), ("443", "Loyal Customers"), ("244", "At Risk - Needs Attention"),
    ("111", "Lost Customers"), ("412", "New / Potential Loyalists"), ("222", "Hibernating"),
    ("311", "Promising Customers")])
def test_segments(spark, score, segment):
    r, f, m = (int(c) for c in score)
    assert one(spark, business.rfm_segment("r", "f", "m"), r=r, f=f, m=m) == segment


@pytest.mark.parametrize("text, category", [
    ("VINTAGE CHRISTMAS TREE HANGER", "Seasonal & Festive"), ("CERAMIC COFFEE MUG WITH SPOON", "Kitchen & Dining"),
    ("MINI FUNKY DESIGN TAPES", "Home Decor & Furnishing"), ("PAPER POCKET TRAVELING FAN", "Bags & Travel"),
    ("DOGGY RUBBER", "Gifts & Accessories"), ("wooden toy", "Toys & Children")])
def test_categories(spark, text, category):
    assert one(spark, business.product_category("d"), d=text) == category


@pytest.mark.parametrize("country, region, tier", [
    ("United Kingdom", "Domestic UK", "Tier 1 - Domestic"), ("GERMANY", "Western Europe", "Tier 2 - Core Europe"),
    ("eire", "Western Europe", "Tier 2 - Core Europe"), ("RSA", "Africa", "Tier 3 - International"),
    ("Lithuania", "Eastern Europe", "Tier 3 - Extended EU"), ("Atlantis", "Other / Overseas", "Tier 3 - International")])
def test_regions(spark, country, region, tier):
    assert one(spark, business.geography_region("c"), c=country) == region
    assert one(spark, business.market_tier("c"), c=country) == tier


def test_risk_and_codes(spark):
    levels = [one(spark, business.risk_level("p"), p=p) for p in (0.70, 0.6999, 0.40, 0.3999)]
    assert levels == ["High Risk", "Medium Risk", "Medium Risk", "Low Risk"]
    assert one(spark, business.customer_code("i"), i=0) == "GUEST_UNREGISTERED"
    assert one(spark, business.customer_code("i"), i=7) == "CUST_7"
    assert one(spark, business.drift_alert("s", "p"), s=0.0, p=0.005) == "HIGH DRIFT (ALERT)"
    assert one(spark, business.drift_alert("s", "p"), s=0.1, p=0.5) == "MODERATE DRIFT (WARNING)"
    assert one(spark, business.drift_alert("s", "p"), s=0.09, p=0.5) == "STABLE (NO DRIFT)"


def test_ratios_round_half_away(spark):
    assert [float(one(spark, ratio("a", "b", 2), a=a, b=b)) for a, b in [(1, 8), (-1, 8), (2, 3), (5, 0)]] == [
        0.13, -0.13, 0.67, 0.0]
    got = spark.sql("select cast(1 as decimal(12,2)) a, cast(3 as decimal(12,2)) b").select(share_pct("a", "b"))
    assert float(got.first()[0]) == 33.33
