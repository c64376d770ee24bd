"""Business queries over the star schema and marts.

Facts collapse on a surrogate key before a dimension joins, so joins run on grouped rows and a hot
key costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.functions.money import mean_amount, ratio, share_pct


def _sold(fact_sales: DataFrame) -> DataFrame:
    return fact_sales.filter(~F.col("is_cancelled"))


def monthly_revenue(fact_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Orders, units, revenue, mean line and mean order per month."""
    invoices = _sold(fact_sales).groupBy("date_key", "invoice_no").agg(
        F.sum("quantity").alias("units"), F.sum("total_amount").alias("amount"), F.count("*").alias("lines"))
    dated = invoices.join(dim_date.select("date_key", "year", "month", "month_name"), "date_key")
    months = dated.groupBy("year", "month", "month_name").agg(
        F.count_distinct("invoice_no").alias("total_orders"),
        F.sum("units").alias("total_units_sold"),
        F.sum("amount").alias("gross_revenue_gbp"),
        F.sum("lines").alias("lines"),
    )
    return months.orderBy("year", "month").select(
        "year",
        "month_name",
        "total_orders",
        "total_units_sold",
        "gross_revenue_gbp",
        mean_amount("gross_revenue_gbp", "lines").alias("average_line_item_value"),
        mean_amount("gross_revenue_gbp", "total_orders").alias("average_order_value_gbp"),
    )


def product_revenue(fact_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Units, revenue and mean price of every product sold, best first."""
    sold = _sold(fact_sales).groupBy("product_key").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("unit_price").alias("_prices"),
        F.count("*").alias("_lines"),
    )
    named = sold.join(dim_product.select("product_key", "stock_code", "description", "category"), "product_key")
    return named.select(
        "stock_code", "description", "category", "units_sold", "total_revenue",
        mean_amount("_prices", "_lines").alias("avg_price"),
    ).orderBy(F.desc("total_revenue"), "stock_code")


def top_products(fact_sales: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    best = product_revenue(fact_sales, dim_product).limit(n)
    return best.withColumnsRenamed({"total_revenue": "total_revenue_gbp", "avg_price": "avg_unit_price"})


def rfm_segments(mart_customer_rfm: DataFrame) -> DataFrame:
    """Size, means and revenue share of each segment."""
    segments = mart_customer_rfm.groupBy("customer_segment").agg(
        F.count("customer_key").alias("customer_count"),
        F.sum("recency_days").alias("_recency"),
        F.sum("frequency").alias("_frequency"),
        F.sum("monetary_total").alias("segment_total_spend_gbp"),
    )
    total = F.sum("segment_total_spend_gbp").over(W.partitionBy())
    return segments.withColumn("_total", total).select(
        "customer_segment",
        "customer_count",
        ratio("_recency", "customer_count", 1).alias("avg_recency_days"),
        ratio("_frequency", "customer_count", 1).alias("avg_frequency_orders"),
        mean_amount("segment_total_spend_gbp", "customer_count").alias("avg_monetary_spend_gbp"),
        "segment_total_spend_gbp",
        share_pct("segment_total_spend_gbp", "_total").alias("revenue_share_pct"),
    ).orderBy(F.desc("segment_total_spend_gbp"), "customer_segment")


def geography_performance(fact_sales: DataFrame, dim_geography: DataFrame, n: int = 15) -> DataFrame:
    """Orders, revenue and revenue share of the best markets."""
    invoices = _sold(fact_sales).groupBy("geography_key", "invoice_no").agg(F.sum("total_amount").alias("amount"))
    markets = invoices.groupBy("geography_key").agg(
        F.count("*").alias("total_orders"), F.sum("amount").alias("market_revenue_gbp"))
    # Every line has a market, so the grand total is the sum over the few groups.
    total = F.sum("market_revenue_gbp").over(W.partitionBy())
    named = markets.withColumn("_total", total).join(dim_geography, "geography_key")
    return named.select(
        "region", "market_tier", "country_name", "total_orders", "market_revenue_gbp",
        share_pct("market_revenue_gbp", "_total").alias("revenue_contribution_pct"),
    ).orderBy(F.desc("market_revenue_gbp"), "country_name").limit(n)


def cohort_retention(retention: DataFrame) -> DataFrame:
    """Customers, repeat orders, days between orders and lifetime value per first-purchase month."""
    people = retention.groupBy("cohort_month", "customer_key").agg(
        F.count("*").alias("orders"),
        F.count_if("is_repeat_customer").alias("repeats"),
        F.sum("days_since_prior_order").alias("days"),
        F.sum("order_value").alias("value"),
    )
    cohorts = people.groupBy("cohort_month").agg(
        F.count("*").alias("total_cohort_customers"),
        F.sum("repeats").alias("repeat_orders_placed"),
        F.sum("days").alias("_days"),
        F.sum("orders").alias("_orders"),
        F.sum("value").alias("cohort_lifetime_value_gbp"),
    )
    return cohorts.select(
        "cohort_month", "total_cohort_customers", "repeat_orders_placed",
        ratio("_days", "_orders", 1).alias("avg_days_between_orders"),
        "cohort_lifetime_value_gbp",
    ).orderBy("cohort_month")


def sales_mart_view(mart: DataFrame, dim_date: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Sales mart with calendar and geography attributes, by day."""
    days = dim_date.select("date_key", "year", "month", "month_name", "full_date", "day_name", "is_weekend")
    places = dim_geography.select("country_name", "region", "market_tier")
    return mart.join(days, "date_key").join(places, "country_name").orderBy("full_date", "mart_id")


def rfm_profile(mart_customer_rfm: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """RFM rows with demographics."""
    people = dim_customer.select("customer_key", "gender", "age_group", "preferred_device", "country")
    return mart_customer_rfm.join(people, "customer_key")


def retention_view(retention: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select("date_key", "year", "month")
    return retention.join(days, "date_key").select(
        "cohort_month", "order_sequence", "days_since_prior_order", "order_value", "is_repeat_customer",
        "year", "month")


def audit_trail(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.desc("extraction_timestamp"), F.desc("audit_id"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
               for n, df in tables.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionAll(c)
    return out
