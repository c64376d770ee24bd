"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import business
from tallybook.functions.calendar import calendar_parts, date_key
from tallybook.functions.coerce import to_whole
from tallybook.operators.ordering import dense_key
from tallybook.schemas import GUEST_CODE, GUEST_ID, conform
from tallybook.staging import Stage

# Attributes of the guest and of customers without a profile.
GUEST_PROFILE = {
    "customer_code": GUEST_CODE, "gender": "Unknown", "age_group": "Unknown",
    "loyalty_tier": "None", "preferred_device": "Guest Checkout",
}
NO_PROFILE = {
    "gender": "Unknown", "age_group": "Unknown", "loyalty_tier": "Bronze", "preferred_device": "Desktop Web",
}
NO_MASTER = {**NO_PROFILE, "signup_date": "2010-01-01", "country": "United Kingdom"}


def build_dim_date(transactions: DataFrame) -> DataFrame:
    """One row per day from the first to the last invoice."""
    return calendar_of(transactions.agg(
        F.min("InvoiceDate").cast("date").alias("low"), F.max("InvoiceDate").cast("date").alias("high")))


def calendar_of(span: DataFrame) -> DataFrame:
    """One row per day from ``low`` to ``high``; no days for nulls."""
    days = span.filter("low is not null").select(
        F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias("full_date"))
    return conform(
        days.select(date_key("full_date").alias("date_key"), "full_date",
                    *[c.alias(n) for n, c in calendar_parts("full_date").items()]),
        "dim_date")


def build_dim_customer(
    transactions: DataFrame, master: DataFrame | None, stage: Stage | None = None
) -> DataFrame:
    """Every customer seen in a line or in the master, with defaults for what is unknown."""
    ids = transactions.select("customer_id").filter("customer_id is not null").distinct()
    filled = customer_profiles(ids, master)
    return conform(dense_key(filled, ["customer_id"], "customer_key", stage), "dim_customer")


def customer_profiles(ids: DataFrame, master: DataFrame | None) -> DataFrame:
    """Attributes of the given customers (``customer_id``, distinct) and of those in the master."""
    if master is not None and not master.isEmpty():
        known = master.select(
            F.col("customer_id").cast("bigint").alias("customer_id"), "customer_code", "gender", "age_group",
            "loyalty_tier", F.col("signup_date").cast("date").alias("signup_date"), "preferred_device", "country")
        profiles = ids.unionByName(known.select("customer_id")).distinct().join(known, "customer_id", "left")
        defaults = NO_PROFILE
    else:
        profiles = ids.withColumns(
            {**{n: F.lit(None).cast("string") for n in ["customer_code", *NO_PROFILE, "country"]},
             "signup_date": F.lit(None).cast("date")})
        defaults = NO_MASTER
    guest = F.col("customer_id") == GUEST_ID
    filled = profiles.withColumns(
        {n: F.coalesce(F.col(n), F.lit(v).cast("date") if n == "signup_date" else F.lit(v))
         for n, v in defaults.items()})
    filled = filled.withColumn(
        "customer_code", F.coalesce("customer_code", business.customer_code("customer_id")))
    return filled.withColumns({n: F.when(guest, v).otherwise(F.col(n)) for n, v in GUEST_PROFILE.items()})


def build_dim_product(transactions: DataFrame, stage: Stage | None = None) -> DataFrame:
    """First description and median price of each stock code.

    Lines collapse to (code, description, price) first: no hot product reaches one task whole, and
    the median works on price counts.
    """
    described = described_products(product_variants(transactions))
    return conform(dense_key(described, ["stock_code"], "product_key", stage), "dim_product")


def product_variants(transactions: DataFrame, *by: str) -> DataFrame:
    """How often and since when each price and description of a stock code occurs; these add up over batches."""
    return transactions.groupBy("StockCode", "Description", "UnitPrice", *by).agg(
        F.min("InvoiceDate").alias("seen"), F.count("*").alias("n"))


def described_products(variants: DataFrame) -> DataFrame:
    """Attributes of each stock code."""
    pence = (F.col("UnitPrice") * 100).cast("bigint")
    products = variants.groupBy(F.col("StockCode").alias("stock_code")).agg(
        F.min_by("Description", F.struct("seen", "Description")).alias("description"),
        F.percentile(pence, F.lit(0.5), F.col("n")).alias("median"),
    )
    return products.select(
        "stock_code",
        "description",
        business.product_category("description").alias("category"),
        (F.floor(F.col("median") + 0.5).cast("decimal(10,0)") * F.lit(0.01).cast("decimal(3,2)"))
        .alias("unit_price_nominal"),
    )


def build_dim_geography(transactions: DataFrame, stage: Stage | None = None) -> DataFrame:
    names = transactions.select(F.col("Country").alias("country_name")).filter("country_name is not null").distinct()
    return conform(dense_key(regions_of(names), ["country_name"], "geography_key", stage), "dim_geography")


def regions_of(names: DataFrame) -> DataFrame:
    """Region and market tier beside ``country_name``."""
    return names.withColumns(
        {"region": business.geography_region("country_name"), "market_tier": business.market_tier("country_name")})


def modal_country(raw: DataFrame) -> DataFrame:
    """Most frequent country per registered customer as it stands in the raw lines; ties to the first name."""
    lines = raw.select(to_whole("CustomerID").alias("customer_id"), F.col("Country").alias("country"))
    counts = lines.filter("customer_id is not null").groupBy("customer_id", "country").agg(F.count("*").alias("n"))
    named = F.col("country").isNotNull()
    best = F.min_by("country", F.when(named, F.struct(-F.col("n"), F.col("country"))))
    return counts.groupBy("customer_id").agg(F.coalesce(best, F.lit("United Kingdom")).alias("country"))


def build_customer_master(raw: DataFrame, attributes: DataFrame | None = None) -> DataFrame:
    """Customer master: ids from the lines plus the guest, modal country, code, joined attributes.

    ``attributes`` (customer_id, gender, age_group, loyalty_tier, signup_date, preferred_device) is
    an input table; customers missing there keep nulls.
    """
    spark = raw.sparkSession
    guest = spark.range(1).select(
        F.lit(GUEST_ID).cast("bigint").alias("customer_id"), F.lit("United Kingdom").alias("country"))
    people = guest.unionByName(modal_country(raw).filter(F.col("customer_id") != GUEST_ID))
    names = ["gender", "age_group", "loyalty_tier", "signup_date", "preferred_device"]
    if attributes is None:
        people = people.withColumns(
            {n: F.lit(None).cast("date" if n == "signup_date" else "string") for n in names})
    else:
        people = people.join(attributes.select("customer_id", *names), "customer_id", "left")
    is_guest = F.col("customer_id") == GUEST_ID
    people = people.withColumn("customer_code", business.customer_code("customer_id"))
    people = people.withColumns({n: F.when(is_guest, v).otherwise(F.col(n)) for n, v in GUEST_PROFILE.items()})
    return people.select("customer_id", "customer_code", "gender", "age_group", "loyalty_tier", "signup_date",
                         "preferred_device", "country")
