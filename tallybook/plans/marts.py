"""Mart builders."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import business
from tallybook.functions.calendar import elapsed_days
from tallybook.functions.money import mean_amount
from tallybook.operators.ordering import dense_key, lay_out
from tallybook.schemas import GUEST_ID, conform
from tallybook.staging import Stage, stage_of


def build_mart_sales_performance(
    fact_sales: DataFrame, dim_date: DataFrame, dim_geography: DataFrame, stage: Stage | None = None
) -> DataFrame:
    """Daily sales per country, cancellations included."""
    mart = daily_sales(sold_invoices(fact_sales), dim_date, dim_geography)
    return conform(
        dense_key(mart, ["date_key", "year_month", "country_name"], "mart_id", stage), "mart_sales_performance")


def sold_invoices(fact_sales: DataFrame, *by: str) -> DataFrame:
    """Lines collapsed to (day, country, invoice, customer): distinct counts then run on invoices, which add up over batches."""
    return fact_sales.groupBy("date_key", "geography_key", "invoice_no", "customer_key", *by).agg(
        F.sum("total_amount").alias("amount"),
        F.sum("quantity").alias("units"),
        F.sum(F.col("is_cancelled").cast("int")).alias("cancelled"),
    )


def daily_sales(invoices: DataFrame, dim_date: DataFrame, dim_geography: DataFrame) -> DataFrame:
    # Grouping by key before naming is the same as grouping by name: both dimensions are unique.
    daily = invoices.groupBy("date_key", "geography_key").agg(
        F.sum("amount").alias("total_revenue"),
        F.count_distinct("invoice_no").alias("total_orders"),
        F.sum("units").alias("total_units_sold"),
        F.count_distinct("customer_key").alias("unique_customers"),
        F.sum("cancelled").alias("cancelled_orders_count"),
    )
    months = dim_date.select("date_key", F.date_format("full_date", "yyyy-MM").alias("year_month"))
    named = daily.join(months, "date_key").join(dim_geography.select("geography_key", "country_name"), "geography_key")
    return named.withColumn("average_order_value", mean_amount("total_revenue", "total_orders"))


def quintile_by_rank(value: str, tie_break: str, ranked, column_type) -> Column:
    """1..5 score from the rank of ``(value, tie_break)``.

    The highest rank scoring at most j is ``1 + j (n-1) / 5``; comparing with the rows at those four
    ranks scores every row in place, without joining ranks back.
    """
    n = ranked.rows
    cuts = [1 + j * (n - 1) // 5 for j in range(1, 5)]
    rows = ranked.at_ranks(cuts) if n else {}
    score = F.lit(5)
    for j in reversed(range(4)):
        cut = rows.get(cuts[j])
        if cut is not None:
            at = F.lit(cut[value]).cast(column_type)
            below = (F.col(value) < at) | ((F.col(value) == at) & (F.col(tie_break) <= cut[tie_break]))
            score = F.when(below, j + 1).otherwise(score)
    return score.cast("int")


def build_mart_customer_rfm(
    fact_sales: DataFrame, dim_customer: DataFrame, stage: Stage | None = None
) -> DataFrame:
    """Recency, frequency and monetary scores and segment per registered customer."""
    # Lines collapse to invoices, then to customers, before the customer lookup.
    customers = purchased_invoices(fact_sales).groupBy("customer_key").agg(
        F.max("last_ts").alias("last_ts"),
        F.count("*").alias("frequency"),
        F.sum("spend").cast("decimal(14,2)").alias("monetary_total"),
    )
    return scored_customers(customers, dim_customer, stage)


def purchased_invoices(fact_sales: DataFrame, *by: str) -> DataFrame:
    purchases = fact_sales.filter(~F.col("is_cancelled") & (F.col("total_amount") > 0))
    return purchases.groupBy("customer_key", "invoice_no", *by).agg(
        F.max("invoice_timestamp").alias("last_ts"), F.sum("total_amount").alias("spend"))


def scored_customers(customers: DataFrame, dim_customer: DataFrame, stage: Stage | None = None) -> DataFrame:
    """The mart from one row per customer (``last_ts``, ``frequency``, ``monetary_total``); ties go by customer id."""
    stage = stage_of(customers, stage)
    people = dim_customer.select("customer_key", "customer_id", "loyalty_tier")
    registered = customers.join(people, "customer_key").filter(F.col("customer_id") != GUEST_ID)  # one row per key
    base = stage.table(registered, "rfm-base")

    snapshot = base.agg(F.max("last_ts") + F.expr("interval 1 day")).scalar()
    base = base.withColumn("recency_days", elapsed_days("last_ts", snapshot))
    days = base.groupBy("recency_days").agg(F.count("*").alias("n"))
    quintiles = F.percentile("recency_days", F.array(*[F.lit(p) for p in (0.2, 0.4, 0.6, 0.8)]), F.col("n"))

    def by(column: str):
        return lay_out(base.select(column, "customer_id"), [column, "customer_id"], stage, f"rfm-{column}")

    with ThreadPoolExecutor(3) as pool:  # three independent jobs
        recency, frequency, spend = (
            pool.submit(lambda: days.agg(quintiles).first()[0]), pool.submit(by, "frequency"),
            pool.submit(by, "monetary_total"))
        edges, by_frequency, by_spend = recency.result(), frequency.result(), spend.result()
    recency_score = F.lit(1)
    for score, edge in zip((2, 3, 4, 5), reversed(edges or [])):
        recency_score = F.when(F.col("recency_days") <= edge, score).otherwise(recency_score)

    scored = base.withColumns(
        {
            "r_score": recency_score.cast("int"),
            "f_score": quintile_by_rank("frequency", "customer_id", by_frequency, "bigint"),
            "m_score": quintile_by_rank("monetary_total", "customer_id", by_spend, "decimal(14,2)"),
        })
    mart = scored.withColumns(
        {
            "rfm_score": business.rfm_score("r_score", "f_score", "m_score"),
            "customer_segment": business.rfm_segment("r_score", "f_score", "m_score"),
            "loyalty_tier": F.coalesce("loyalty_tier", F.lit("Bronze")),
            "last_order_date": F.col("last_ts").cast("date"),
        })
    return conform(mart, "mart_customer_rfm")
