"""Fact builders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.calendar import elapsed_days, year_month
from tallybook.operators.joins import lookup_join
from tallybook.operators.ordering import dense_key, sequence_within
from tallybook.schemas import GUEST_ID, SALES_ORDER, conform
from tallybook.staging import Stage


def registered_purchases(lines: DataFrame) -> DataFrame:
    """Lines of known customers that are real purchases."""
    return lines.filter(
        (F.col("customer_id") != GUEST_ID) & ~F.col("is_cancelled") & (F.col("total_amount") > 0))


def build_fact_sales(
    transactions: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_geography: DataFrame,
    stage: Stage | None = None,
) -> DataFrame:
    """Lines with surrogate keys; nothing is dropped, unknown references fall back to defaults.

    ``transactions`` may already carry ``sales_key`` (its rank in sales order).
    """
    if "sales_key" not in transactions.columns:
        transactions = dense_key(transactions, SALES_ORDER, "sales_key", stage)
    if "batch_id" not in transactions.columns:
        transactions = transactions.withColumn("batch_id", F.lit("historical"))
    guest_key = dim_customer.filter(F.col("customer_id") == GUEST_ID).agg(F.min("customer_key")).scalar()
    lookups = [
        (dim_customer.select("customer_id", "customer_key"), "customer_id"),
        (dim_product.select(F.col("stock_code").alias("StockCode"), "product_key"), "StockCode"),
        (dim_geography.select(F.col("country_name").alias("Country"), "geography_key"), "Country"),
    ]
    joined = transactions
    for lookup, key in lookups:
        joined = lookup_join(joined, lookup, key, "left", probe=transactions)
    fact = joined.select(
        "sales_key",
        F.col("InvoiceNo").alias("invoice_no"),
        F.coalesce("customer_key", guest_key, F.lit(1)).alias("customer_key"),
        F.coalesce("product_key", F.lit(1)).alias("product_key"),
        F.coalesce("geography_key", F.lit(1)).alias("geography_key"),
        "date_key",
        F.col("InvoiceDate").alias("invoice_timestamp"),
        F.col("Quantity").alias("quantity"),
        F.col("UnitPrice").alias("unit_price"),
        "total_amount",
        "is_cancelled",
        "batch_id",
    )
    return conform(fact, "fact_sales")


def build_fact_customer_retention(
    transactions: DataFrame, dim_customer: DataFrame, stage: Stage | None = None
) -> DataFrame:
    """One row per (customer, invoice, day) with its place in the customer's history."""
    placed = placed_orders(customer_orders(transactions), stage)
    return named_retention(placed, dim_customer, registered_purchases(transactions))


def customer_orders(transactions: DataFrame, *by: str) -> DataFrame:
    """Moment and value of each (customer, invoice, day)."""
    return registered_purchases(transactions).groupBy("customer_id", "InvoiceNo", "date_key", *by).agg(
        F.min("InvoiceDate").alias("order_date"), F.sum("total_amount").alias("order_value"))


def placed_orders(orders: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Orders with their place in the customer's history, the order before and the first one."""
    return sequence_within(
        orders, "customer_id", ["order_date", "InvoiceNo", "date_key"], "order_sequence",
        previous={"prior_date": "order_date"}, first={"first_date": "order_date"},
        rank="retention_key", stage=stage)


def named_retention(placed: DataFrame, dim_customer: DataFrame, probe: DataFrame | None = None) -> DataFrame:
    customers = dim_customer.select("customer_id", "customer_key")
    keyed = lookup_join(placed, customers, "customer_id", "left", probe=probe)
    retention = keyed.select(
        "retention_key",
        F.coalesce("customer_key", F.lit(1)).alias("customer_key"),
        "date_key",
        year_month("first_date").alias("cohort_month"),
        "order_sequence",
        F.coalesce(elapsed_days("prior_date", "order_date"), F.lit(0)).alias("days_since_prior_order"),
        "order_value",
        (F.col("order_sequence") > 1).alias("is_repeat_customer"),
    )
    return conform(retention, "fact_customer_retention")
