"""Churn features: what a customer did before the cutoff, labelled by what happened after it."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.calendar import elapsed_days
from tallybook.functions.money import mean_amount, ratio
from tallybook.operators.ordering import sequence_within
from tallybook.schemas import GUEST_ID
from tallybook.staging import Stage, stage_of

NUMERIC_FEATURES = [
    "recency_days", "frequency_orders", "monetary_spend", "avg_order_value", "total_units",
    "cancellation_rate", "inter_purchase_mean", "inter_purchase_std", "product_variety",
]
CATEGORICAL_FEATURES = ["gender", "age_group", "loyalty_tier", "preferred_device", "country"]
LABEL = "is_churned"


def extract_customer_features(
    fact_sales: DataFrame,
    dim_customer: DataFrame,
    inactivity_days: int = 90,
    observation_days: int = 180,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per customer with a purchase in the observation window.

    The windows hang on the last line of any registered customer, cancellations included; that moment is read first (two columns)
    so that the windows reach the scan as plain date bounds, which skip most of a fact stored in date order. One more pass groups
    the lines of both windows into visits and into products at once.
    """
    stage = stage_of(fact_sales, stage)
    guest = dim_customer.filter(F.col("customer_id") == GUEST_ID).agg(F.min("customer_key")).scalar()
    lines = fact_sales.filter(~F.col("customer_key").eqNullSafe(guest))
    latest = lines.agg(F.max("invoice_timestamp")).first()[0]
    ts, valid = F.col("invoice_timestamp"), ~F.col("is_cancelled")
    if latest is None:
        cutoff = start = F.lit(None).cast("timestamp_ntz")
        end = cutoff
    else:
        cut = latest - timedelta(days=inactivity_days)
        cutoff, start, end = F.lit(cut), F.lit(cut - timedelta(days=observation_days)), F.lit(latest)
    observed = ts < cutoff
    # Lines collapse to visits (customer, invoice, moment) and to products before anything is done per customer.
    grouped = stage.table(
        lines.filter((ts >= start) & (ts <= end)).groupingSets(
            [["customer_key", "invoice_no", "invoice_timestamp"], ["customer_key", "product_key"]],
            "customer_key", "invoice_no", "invoice_timestamp", "product_key").agg(
            (F.grouping("product_key") == 1).alias("is_visit"),
            F.count_if(observed).alias("lines"),
            F.count_if(F.col("is_cancelled")).alias("cancelled"),
            F.count_if(observed & valid).alias("bought"),
            F.count_if(~observed & valid).alias("bought_later"),
            F.sum(F.when(observed & valid, F.col("total_amount"))).alias("spend"),
            F.sum(F.when(observed & valid, F.col("quantity"))).alias("units"),
        ),
        "visits-and-products",
    )
    every_visit = grouped.filter("is_visit")
    active = every_visit.filter("bought_later > 0").select("customer_key").distinct()
    visits = every_visit.filter("lines > 0")
    bought = F.col("bought") > 0
    habits = visits.groupBy("customer_key").agg(
        F.max(F.when(bought, ts)).alias("last_ts"),
        F.count_distinct(F.when(bought, F.col("invoice_no"))).alias("frequency_orders"),
        F.sum("spend").alias("spend"),
        F.sum("units").alias("total_units"),
        F.sum("cancelled").alias("cancelled"),
        F.sum("lines").alias("lines"),
    ).filter("last_ts is not null")

    moments = visits.filter(bought).select("customer_key", "invoice_timestamp", "invoice_no")
    steps = sequence_within(
        moments, "customer_key", ["invoice_timestamp", "invoice_no"], "step",
        previous={"prior_ts": "invoice_timestamp"}, stage=stage)
    gap = elapsed_days("prior_ts", "invoice_timestamp").cast("bigint")
    gaps = steps.withColumn("gap", gap).groupBy("customer_key").agg(
        F.count("gap").alias("gaps"), F.sum("gap").alias("gap_sum"), F.sum(F.col("gap") * F.col("gap")).alias("gap_sq"))

    variety = grouped.filter("not is_visit and bought > 0").groupBy("customer_key").agg(F.count("*").alias("product_variety"))
    n, total, squares = F.col("gaps"), F.col("gap_sum"), F.col("gap_sq")
    variance = (n * squares - total * total) / (n * (n - 1))
    people = dim_customer.filter(F.col("customer_id") != GUEST_ID).select(
        "customer_key", "customer_id", *CATEGORICAL_FEATURES)
    joined = (
        habits.join(gaps, "customer_key", "left")
        .join(variety, "customer_key", "left")
        .join(active.withColumn("_active", F.lit(True)), "customer_key", "left")
    )
    return joined.join(people, "customer_key").select(
        "customer_id",
        elapsed_days("last_ts", cutoff).alias("recency_days"),
        "frequency_orders",
        F.col("spend").cast("decimal(14,2)").alias("monetary_spend"),
        mean_amount("spend", "frequency_orders").alias("avg_order_value"),
        "total_units",
        ratio("cancelled", "lines", 4).alias("cancellation_rate"),
        F.when(n > 0, ratio("gap_sum", "gaps", 2)).otherwise(F.lit(observation_days)).cast("decimal(20,2)")
        .alias("inter_purchase_mean"),
        F.when(n > 1, F.round(F.sqrt(variance), 2)).otherwise(0.0).alias("inter_purchase_std"),
        "product_variety",
        *CATEGORICAL_FEATURES,
        F.when(F.col("_active"), 0).otherwise(1).alias(LABEL),
    )
