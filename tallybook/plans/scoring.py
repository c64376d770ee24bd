"""Batch scoring: input contract, prediction, risk tier and advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.business import MODEL_VERSION, risk_advice, risk_level
from tallybook.plans.features import CATEGORICAL_FEATURES
from tallybook.plans.models import ChurnModel

# Numeric inputs as (name, least, most, default or None when required), then text defaults.
NUMERIC_INPUTS = [
    ("recency_days", 0.0, None, None),
    ("frequency_orders", 1.0, None, None),
    ("monetary_spend", 0.0, None, None),
    ("avg_order_value", 0.0, None, None),
    ("total_units", 0.0, None, None),
    ("cancellation_rate", 0.0, 1.0, 0.0),
    ("inter_purchase_mean", 0.0, None, 30.0),
    ("inter_purchase_std", 0.0, None, 10.0),
    ("product_variety", 1.0, None, 5.0),
]
TEXT_DEFAULTS = {
    "gender": "Unknown", "age_group": "36-50", "loyalty_tier": "Bronze", "preferred_device": "Desktop Web",
    "country": "United Kingdom",
}
REASON = "rejection_reason"


def _violation() -> Column:
    chain = F
    for name, least, most, default in NUMERIC_INPUTS:
        c = F.col(name)
        if default is None:
            chain = chain.when(c.isNull(), f"MISSING_{name.upper()}")
        bad = F.isnan(c) | (c < least)
        chain = chain.when(bad if most is None else bad | (c > most), f"OUT_OF_RANGE_{name.upper()}")
    return chain.otherwise(None)


def check_scoring_input(df: DataFrame) -> DataFrame:
    """Typed input with defaults filled in and the first violated rule, if any."""
    present = set(df.columns)

    def column(name, dtype):
        return (F.col(name) if name in present else F.lit(None)).cast(dtype)

    typed = df.select(
        column("customer_id", "string").alias("customer_id"),
        *[F.coalesce(column(n, "string").try_cast("double"), F.lit(d)).alias(n) for n, _, _, d in NUMERIC_INPUTS],
        *[F.coalesce(column(c, "string"), F.lit(TEXT_DEFAULTS[c])).alias(c) for c in CATEGORICAL_FEATURES],
    )
    return typed.withColumn(REASON, _violation())


def validate_scoring_input(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reason)."""
    checked = check_scoring_input(df)
    return checked.filter(F.col(REASON).isNull()).drop(REASON), checked.filter(F.col(REASON).isNotNull())


def tiers(df: DataFrame, probability: str = "churn_probability") -> DataFrame:
    """Risk level and advice from the unrounded probability."""
    return df.withColumns({"risk_level": risk_level(probability), "recommendation": risk_advice(probability)})


def score_customers(model: ChurnModel, accepted: DataFrame) -> DataFrame:
    scored = tiers(model.predict(accepted))
    return scored.select(
        "customer_id",
        "churn_prediction",
        F.round("churn_probability", 4).alias("churn_probability"),
        "risk_level",
        "recommendation",
        F.lit(MODEL_VERSION).alias("model_version"),
    )


def score_totals(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count("*").alias("total_processed"),
        F.count_if(F.col("risk_level") == "High Risk").alias("high_risk_count"),
    )
