"""Feature drift between a baseline and a current sample: PSI and Kolmogorov-Smirnov."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.business import drift_alert
from tallybook.operators.ordering import running_totals
from tallybook.staging import Stage, stage_of

BINS = 10
# Share given to an empty bin before division, widening of the outer edges.
EMPTY_BIN, MARGIN = 1e-4, 1e-5


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _long(df: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    values = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    long = values.unpivot([], list(features), "feature", "value")
    return long.filter("value is not null and not isnan(value)").withColumn("side", F.lit(side))


def _settled(df: DataFrame) -> DataFrame:
    """A result of one row per feature (column of the input), computed once instead of per use."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def _decile_rank(j: int) -> tuple[Column, Column, Column]:
    """0-based ranks around decile ``j`` of ``nb`` values and the weight between them."""
    position = F.lit(j) * (F.col("nb") - 1)
    low = F.call_function("div", position, F.lit(BINS))
    rest = position % BINS
    return low, low + (rest > 0).cast("int"), rest / BINS


def drift_statistics(
    baseline: DataFrame, current: DataFrame, features: Sequence[str] | None = None, stage: Stage | None = None
) -> DataFrame:
    """Per feature: sizes, KS statistic, PSI and means, all features in one pass.

    Values collapse to counts per distinct value; cumulative counts over the global order of
    (feature, value) then give both empirical distributions and the exact deciles.
    """
    stage = stage_of(baseline, stage)
    wanted = numeric_columns(baseline) if features is None else features
    shared = [f for f in wanted if f in baseline.columns and f in current.columns]
    both = _long(baseline, shared, "b").unionByName(_long(current, shared, "c"))
    counts = both.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == "b").alias("b"), F.count_if(F.col("side") == "c").alias("c"))
    curves = stage.table(
        running_totals(counts, ["feature", "value"], {"cum_b": "b", "cum_c": "c"}, stage=stage), "drift-curves")

    value = F.col("value")
    in_b, in_c = F.col("b") > 0, F.col("c") > 0
    sizes = curves.groupBy("feature").agg(
        F.sum("b").alias("nb"),
        F.sum("c").alias("nc"),
        F.min(F.col("cum_b") - F.col("b")).alias("before_b"),
        F.min(F.col("cum_c") - F.col("c")).alias("before_c"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
        F.sum(value * F.col("b")).alias("sum_b"),
        F.sum(value * F.col("c")).alias("sum_c"),
    )
    sizes = _settled(sizes)
    placed = curves.join(F.broadcast(sizes), "feature").withColumns(
        {"cum_b": F.col("cum_b") - F.col("before_b"), "cum_c": F.col("cum_c") - F.col("before_c")})

    picks, edges = [], []
    for j in range(BINS + 1):
        low, high, weight = _decile_rank(j)
        picks += [
            F.min(F.when(in_b & (F.col("cum_b") > low), value)).alias(f"low{j}"),
            F.min(F.when(in_b & (F.col("cum_b") > high), value)).alias(f"high{j}"),
            F.min(weight).alias(f"weight{j}"),
        ]
        a, b, t = F.col(f"low{j}"), F.col(f"high{j}"), F.col(f"weight{j}")
        edges.append(F.when(t >= 0.5, b - (b - a) * (1 - t)).otherwise(a + (b - a) * t))
    gap = F.abs(F.try_divide("cum_b", "nb") - F.try_divide("cum_c", "nc"))
    shape = placed.groupBy("feature").agg(F.max(gap).alias("ks"), *picks).select(
        "feature", "ks", F.array_sort(F.array_distinct(F.array(*edges))).alias("inner_edges"))
    shape = shape.join(sizes, "feature")
    last = F.size("inner_edges") - 1
    outer = [
        F.when(F.lit(j) == 0, F.col("lowest") - MARGIN)
        .when(F.lit(j) == last, F.col("highest") + MARGIN)
        .otherwise(F.get("inner_edges", F.lit(j)))
        for j in range(BINS + 1)
    ]
    shape = shape.select(
        "feature", "ks", "nb", "nc", "sum_b", "sum_c", last.alias("bins"),
        *[e.alias(f"edge{j}") for j, e in enumerate(outer)])
    shape = _settled(shape)

    binned = curves.join(F.broadcast(shape), "feature")
    # Half-open bins, the last one closed: the number of edges at or below the value, at most `bins`.
    below = sum(
        (F.coalesce(F.col(f"edge{j}") <= value, F.lit(False)) & (F.lit(j) < F.col("bins"))).cast("int")
        for j in range(BINS))
    binned = binned.withColumn("bin", below)
    filled = binned.groupBy("feature").agg(
        *[F.sum(F.when(F.col("bin") == j, F.col(s)).otherwise(0)).alias(f"{s}{j}")
          for s in ("b", "c") for j in range(1, BINS + 1)])
    psi = F.lit(0.0)
    for j in range(1, BINS + 1):
        share = {
            s: F.try_divide(
                F.when(F.col(f"{s}{j}") == 0, EMPTY_BIN).otherwise(F.col(f"{s}{j}").cast("double")), F.col(f"n{s}"))
            for s in ("b", "c")}
        term = (share["b"] - share["c"]) * F.log(share["b"] / share["c"])
        psi = psi + F.when(F.lit(j) <= F.col("bins"), term).otherwise(0.0)
    full = filled.join(shape, "feature")
    empty = (F.col("nb") == 0) | (F.col("nc") == 0)
    return full.select(
        "feature", "nb", "nc", "ks",
        F.round(F.when(empty, 0.0).otherwise(psi), 4).alias("psi_score"),
        F.round(F.col("ks"), 4).alias("ks_statistic"),
        F.round(F.try_divide("sum_b", "nb"), 2).alias("baseline_mean"),
        F.round(F.try_divide("sum_c", "nc"), 2).alias("current_mean"),
    )


def psi(baseline: DataFrame, current: DataFrame, feature: str, stage: Stage | None = None) -> DataFrame:
    """(feature, psi_score) of one column."""
    return drift_statistics(baseline, current, [feature], stage).select("feature", "psi_score")


def ks_p_value(d: float, n1: int, n2: int) -> float:
    """Two-sided p-value of the two-sample statistic by the asymptotic Kolmogorov series, at every size."""
    x = math.sqrt(n1 * n2 / (n1 + n2)) * d
    if x < 0.2:
        return 1.0
    series = sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * series))


def feature_drift(
    baseline: DataFrame, current: DataFrame, features: Sequence[str] | None = None, stage: Stage | None = None
) -> DataFrame:
    """Drift report, worst first; features with fewer than five values on a side are left out."""
    stats = drift_statistics(baseline, current, features, stage).filter("nb >= 5 and nc >= 5")
    rows = stats.collect()  # one row per feature
    p_values = [(r["feature"], float(ks_p_value(r["ks"], r["nb"], r["nc"]))) for r in rows]
    spark = baseline.sparkSession
    measured = spark.createDataFrame(rows, stats.schema).join(
        spark.createDataFrame(p_values, "feature string, p double"), "feature")
    return measured.select(
        "feature", "psi_score", "ks_statistic", F.round("p", 5).alias("p_value"), "baseline_mean", "current_mean",
        drift_alert("psi_score", "p").alias("alert_level"),
    ).orderBy(F.desc("psi_score"), "feature")
