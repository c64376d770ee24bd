"""Figures behind each dashboard view, with the interactive filters as arguments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.functions.money import mean_amount, ratio, share_pct
from tallybook.operators.ordering import running_totals
from tallybook.staging import Stage

# Day order of the weekly view (Saturday is not in it) and the "no filter" choices.
WEEK_VIEW = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Sunday"]
ALL_MARKETS, ALL_CATEGORIES, ALL_TIERS = "All Markets", "All Categories", "All Loyalty Tiers"


def filter_sales(
    sales: DataFrame, country: str = ALL_MARKETS, start: date | None = None, end: date | None = None
) -> DataFrame:
    """``sales`` is the sales mart view; both dates are inclusive."""
    if country != ALL_MARKETS:
        sales = sales.filter(F.col("country_name") == country)
    if start is not None:
        sales = sales.filter(F.col("full_date") >= F.lit(start))
    if end is not None:
        sales = sales.filter(F.col("full_date") <= F.lit(end))
    return sales


def filter_products(products: DataFrame, category: str = ALL_CATEGORIES) -> DataFrame:
    return products if category == ALL_CATEGORIES else products.filter(F.col("category") == category)


def filter_customers(profiles: DataFrame, tier: str = ALL_TIERS, country: str = ALL_MARKETS) -> DataFrame:
    if tier != ALL_TIERS:
        profiles = profiles.filter(F.col("loyalty_tier") == tier)
    if country != ALL_MARKETS:
        profiles = profiles.filter(F.col("country") == country)
    return profiles


def filter_options(sales: DataFrame, products: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every choice a filter offers, with the date bounds as text."""
    span = sales.agg(
        F.min("full_date").cast("string").alias("low"), F.max("full_date").cast("string").alias("high"))

    def choices(df, column, name):
        values = df.select(F.col(column).alias("choice")).filter("choice is not null").distinct()
        return values.select(F.lit(name).alias("filter"), "choice")

    return (
        choices(sales, "country_name", "country")
        .unionAll(choices(products, "category", "category"))
        .unionAll(choices(profiles, "loyalty_tier", "loyalty_tier"))
        .unionAll(span.select(F.lit("first_date"), "low"))
        .unionAll(span.select(F.lit("last_date"), "high"))
        .orderBy("filter", "choice")
    )


def kpi_scorecard(sales: DataFrame, profiles: DataFrame) -> DataFrame:
    totals = sales.agg(
        F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("revenue"),
        F.coalesce(F.sum("total_orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("total_units_sold"), F.lit(0)).alias("units"),
    )
    active = profiles.agg(F.count_distinct("customer_id")).scalar()
    return totals.select(
        "revenue", "orders", "units", mean_amount("revenue", "orders").alias("aov"), active.alias("active_customers"))


def monthly_trend(sales: DataFrame) -> DataFrame:
    return sales.groupBy("year_month").agg(
        F.sum("total_revenue").alias("revenue"),
        F.sum("total_orders").alias("orders"),
        F.sum("total_units_sold").alias("units"),
    ).orderBy("year_month")


def day_of_week_revenue(sales: DataFrame) -> DataFrame:
    """Revenue of the listed days in their order; a listed day without sales stays, as null."""
    spark = sales.sparkSession
    days = spark.createDataFrame(list(enumerate(WEEK_VIEW)), "position int, day_name string")
    revenue = sales.groupBy("day_name").agg(F.sum("total_revenue").alias("total_revenue"))
    return days.join(revenue, "day_name", "left").orderBy("position").select("day_name", "total_revenue")


def top15_products(products: DataFrame, category: str = ALL_CATEGORIES) -> DataFrame:
    best = filter_products(products, category).orderBy(F.desc("total_revenue"), "stock_code").limit(15)
    return best.orderBy("total_revenue", F.desc("stock_code"))


def category_share(products: DataFrame) -> DataFrame:
    grouped = products.groupBy("category").agg(F.sum("total_revenue").alias("total_revenue"))
    return grouped.withColumn("_total", F.sum("total_revenue").over(W.partitionBy())).select(
        "category", "total_revenue", share_pct("total_revenue", "_total").alias("share_pct"))


def pareto_products(products: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Cumulative revenue over products, best first, with the 80 % and 20 % marks."""
    ranked = running_totals(
        products.select("stock_code", "category", "total_revenue"), [F.desc("total_revenue"), F.col("stock_code")],
        {"cumulative_revenue": "total_revenue"}, rank="sku_rank", stage=stage)
    totals = products.agg(F.sum("total_revenue").cast("double").alias("t"), F.count("*").alias("n"))
    total, count = totals.select("t").scalar(), totals.select("n").scalar()
    curve = ranked.withColumns(
        {
            "cumulative_revenue_pct": F.col("cumulative_revenue").cast("double") / total * 100,
            "sku_pct": F.col("sku_rank") / count * 100,
        })
    return curve.withColumns(
        {
            "within_80_pct_revenue": F.col("cumulative_revenue_pct") <= 80,
            "within_20_pct_skus": F.col("sku_pct") <= 20,
        })


def segment_summary(profiles: DataFrame) -> DataFrame:
    grouped = profiles.groupBy("customer_segment").agg(
        F.count("customer_id").alias("customer_count"),
        F.sum("monetary_total").alias("total_spend"),
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
    )
    return grouped.withColumn("avg_spend", mean_amount("total_spend", "customer_count")).orderBy(
        F.desc("total_spend"), "customer_segment")


def sample_customers(profiles: DataFrame, n: int = 1500, seed: int = 42) -> DataFrame:
    """Reproducible sample of at most ``n`` customers (the view shows that many points)."""
    mark = F.md5(F.concat_ws(":", F.col("customer_id").cast("string"), F.lit(str(seed))).cast("binary"))
    return profiles.orderBy(mark, "customer_id").limit(n)


def tier_gender_spend(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("loyalty_tier", "gender").agg(F.sum("monetary_total").alias("monetary_total"))


def device_customers(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("preferred_device").agg(F.count("customer_id").alias("customers"))


def geo_summary(sales: DataFrame) -> DataFrame:
    """Per market; ``customers`` adds up daily counts, so returning customers count again."""
    return sales.groupBy("country_name", "region", "market_tier").agg(
        F.sum("total_revenue").alias("revenue"),
        F.sum("total_orders").alias("orders"),
        F.sum("total_units_sold").alias("units"),
        F.sum("unique_customers").alias("customers"),
    ).orderBy(F.desc("revenue"), "country_name")


def top_export_markets(sales: DataFrame, n: int = 10) -> DataFrame:
    abroad = geo_summary(sales.filter(F.col("country_name") != "United Kingdom"))
    return abroad.orderBy(F.desc("revenue"), "country_name").limit(n)


def order_sequence_profile(retention: DataFrame, n: int = 10) -> DataFrame:
    grouped = retention.groupBy("order_sequence").agg(
        F.count("order_value").alias("order_count"), F.sum("order_value").alias("total_revenue"))
    return grouped.orderBy("order_sequence").limit(n)


def repeat_latency_histogram(retention: DataFrame, bins: int = 40) -> DataFrame:
    """Orders by days since the previous order in ``bins`` equal bins from the least to the most, empty ones too."""
    days = retention.filter("is_repeat_customer").groupBy("days_since_prior_order").agg(F.count("*").alias("n"))
    bounds = days.agg(F.min("days_since_prior_order").alias("low"), F.max("days_since_prior_order").alias("high"))
    bounds = bounds.filter("low is not null").select("low", F.greatest(F.col("high") - F.col("low"), F.lit(1)).alias("span"))
    placed = days.withColumns({"low": bounds.select("low").scalar(), "span": bounds.select("span").scalar()})
    slot = F.call_function("div", (F.col("days_since_prior_order") - F.col("low")) * bins, F.col("span"))
    binned = placed.withColumn("bin", F.least(slot, F.lit(bins - 1)).cast("int")).groupBy("bin").agg(
        F.min("days_since_prior_order").alias("least_days"), F.max("days_since_prior_order").alias("most_days"),
        F.sum("n").alias("n"))
    every = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))

    def edge(n):
        return F.col("low") + (F.col("bin") + n) * F.col("span") / bins

    return every.join(binned, "bin", "left").select(
        "bin", edge(0).alias("from_days"), edge(1).alias("to_days"), "least_days", "most_days",
        F.coalesce("n", F.lit(0).cast("long")).alias("orders")).orderBy("bin")


def cohort_value(retention: DataFrame) -> DataFrame:
    grouped = retention.groupBy("cohort_month").agg(
        F.count("order_value").alias("total_orders"), F.sum("order_value").alias("lifetime_revenue"))
    return grouped.withColumn("avg_basket", mean_amount("lifetime_revenue", "total_orders")).orderBy("cohort_month")


def quality_scorecard(gated: DataFrame, transactions: DataFrame) -> DataFrame:
    """Pass rate, quarantined lines and copies removed, from the data itself."""
    counts = gated.agg(
        F.count("*").alias("total_records"), F.count_if(F.col("rejection_reason").isNull()).alias("valid_records"))
    kept = transactions.agg(F.count("*")).scalar()
    return counts.select(
        "total_records",
        "valid_records",
        ratio(F.col("valid_records") * 100, "total_records").alias("pass_rate_pct"),
        (F.col("total_records") - F.col("valid_records")).alias("quarantined"),
        (F.col("valid_records") - kept).alias("duplicates_removed"),
    )


def drift_status(report: DataFrame) -> DataFrame:
    """Number of strongly drifted features and whether all is stable."""
    high = F.count_if(F.col("alert_level").contains("HIGH"))
    return report.agg(high.alias("high_drift_features"), (high == 0).alias("is_stable"))
