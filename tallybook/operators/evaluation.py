"""Quality of a binary classifier from a table of labels and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import ratio
from tallybook.operators.ordering import running_totals
from tallybook.staging import Stage

# Fixed value: smallest distance of a probability from 0 and 1 in the log loss (double epsilon).
EPSILON = 2.220446049250313e-16


def _curve(df: DataFrame, label: str, score: str, stage: Stage | None) -> DataFrame:
    """Hits and false alarms at or above each distinct score, from the highest down."""
    by_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return running_totals(by_score, [F.desc("threshold")], {"tp": "pos", "fp": "neg"}, stage=stage)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", stage: Stage | None = None) -> DataFrame:
    """(threshold, fpr, tpr), starting at the origin with no threshold; a rate of a class without rows is null."""
    points = _curve(df, label, score, stage)
    totals = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    p, n = totals.select("p").scalar(), totals.select("n").scalar()
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    curve = points.select(
        F.col("threshold").cast("double").alias("threshold"), F.try_divide(F.col("fp"), n).alias("fpr"),
        F.try_divide(F.col("tp"), p).alias("tpr"))
    return origin.unionByName(curve)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All four cells, empty ones included."""
    cells = df.agg(
        *[F.count_if((F.col(label) == i) & (F.col(prediction) == j)).alias(f"c{i}{j}")
          for i in (0, 1) for j in (0, 1)])
    return cells.selectExpr(
        "stack(4, 0, 0, c00, 0, 1, c01, 1, 0, c10, 1, 1, c11) as (label, prediction, n)")


def evaluate(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    prediction: str | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """One row of metrics, four decimals, 0 where a ratio has no denominator.

    The area under the curve is the exact rank statistic, ties counting half.
    """
    y = F.col(label)
    guess = F.col(prediction) if prediction else (F.col(score) >= 0.5).cast("int")
    p = F.least(F.greatest(F.col(score), F.lit(EPSILON)), F.lit(1 - EPSILON))
    counts = df.agg(
        F.count_if((y == 1) & (guess == 1)).alias("tp"),
        F.count_if((y == 0) & (guess == 1)).alias("fp"),
        F.count_if((y == 1) & (guess == 0)).alias("fn"),
        F.count_if((y == 0) & (guess == 0)).alias("tn"),
        F.round(F.avg(-F.when(y == 1, F.log(p)).otherwise(F.log(1 - p))), 4).alias("log_loss"),
    )
    big = "decimal(38,0)"
    pairs = (
        _curve(df, label, score, stage)
        .agg(F.sum(F.col("neg").cast("decimal(19,0)") * (F.col("tp") * 2 - F.col("pos")).cast("decimal(19,0)"))
             .cast(big).alias("won"))
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumn("_won", pairs.scalar()).select(
        ratio(tp + tn, tp + fp + fn + tn, 4).alias("accuracy"),
        ratio(tp, tp + fp, 4).alias("precision"),
        ratio(tp, tp + fn, 4).alias("recall"),
        ratio(tp * 2, tp * 2 + fp + fn, 4).alias("f1_score"),
        ratio("_won", (tp + fn).cast("decimal(18,0)") * (fp + tn).cast("decimal(18,0)") * 2, 4).alias("roc_auc"),
        "log_loss",
    )
