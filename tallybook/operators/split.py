"""Reproducible splits that do not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.coerce import col
from tallybook.operators.ordering import lay_out
from tallybook.staging import Stage


def mark(key: Column | str, seed: int) -> Column:
    """Hex digest that orders rows at random but always the same way."""
    return F.md5(F.concat_ws(":", col(key).cast("string"), F.lit(str(seed))).cast("binary"))


def fraction_split(df: DataFrame, key: str, fraction: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(about ``fraction`` of the rows, the rest), by row identity."""
    limit = f"{round(fraction * 16**6):06x}"
    inside = F.substring(mark(key, seed), 1, 6) < limit
    return df.filter(inside), df.filter(~inside)


def quotas(counts: dict, take: int) -> dict:
    """Share ``take`` rows over classes in proportion; the largest remainders round up."""
    total = sum(counts.values())
    exact = {k: take * n / total for k, n in counts.items()}
    floors = {k: math.floor(x) for k, x in exact.items()}
    spare = take - sum(floors.values())
    by_remainder = sorted(exact, key=lambda k: (floors[k] - exact[k], k))
    return {k: floors[k] + (k in by_remainder[:spare]) for k in counts}


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_size: float = 0.2,
    val_size: float = 0.15,
    seed: int = 42,
    stage: Stage | None = None,
) -> DataFrame:
    """Add ``split`` (train, val, test) with the label shares kept in each.

    Sizes round up at each step. Rows are numbered within their label from one global order, so a
    label holding most rows needs no task of its own.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return df.withColumn("split", F.lit("train"))
    test = math.ceil(test_size * total)
    val = math.ceil(val_size / (1.0 - test_size) * (total - test))
    test_quota = quotas(counts, test)
    rest = {k: n - test_quota[k] for k, n in counts.items()}
    val_quota = quotas(rest, val)

    laid = lay_out(df.withColumn("_mark", mark(key, seed)), [label, "_mark", key], stage, "split")
    split, before = F, 0
    rank = F.col("_rank")
    for k in sorted(counts):
        mine = F.col(label) == k
        split = split.when(mine & (rank <= before + test_quota[k]), "test")
        split = split.when(mine & (rank <= before + test_quota[k] + val_quota[k]), "val")
        before += counts[k]
    return laid.ranked("_rank").withColumn("split", split.otherwise("train")).drop("_rank", "_mark")
