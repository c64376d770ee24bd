"""Fitted trees as tables of nodes, and scores from walking these tables by joins.

A node table needs no model code to be applied: any engine that joins can score with it. Nodes number a few thousand a tree at
most (``2 ** depth``), so they are broadcast, after being counted, to rows that never leave their place.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.joins import fits_broadcast

ROOT = 0


def node_table(spark: SparkSession, model: RandomForestClassificationModel | GBTClassificationModel, folder: str) -> DataFrame:
    """Nodes of a fitted ensemble (``tree``, ``node``, ``feature``, ``threshold``, ``categories``, ``left``, ``right``, ``value``).

    A leaf has no feature and children; ``value`` is what it adds to the ensemble's sum: the share of the positive class in a
    forest, the weighted prediction in boosting. Inner nodes send a row left if its value is at most the threshold or, for a
    category, in the list. The model is saved below ``folder`` on the way.
    """
    model.write().overwrite().save(folder)
    saved = spark.read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    split = F.col("split")
    inner, numeric = F.col("leftChild") >= 0, split["numCategories"] < 0
    if isinstance(model, GBTClassificationModel):
        weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])  # one a tree
        value = weights[F.col("tree")] * F.col("prediction")
    else:
        value = F.col("impurityStats")[1] / F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return saved.select(
        "tree", F.col("id").alias("node"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & numeric, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~numeric, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(~inner, value).alias("value"))


def walk(nodes: DataFrame, rows: DataFrame, key: str, values: str, trees: int, depth: int) -> DataFrame:
    """``key`` and ``total``, the sum of the leaves that each row's ``values`` (an array) reach in all trees."""
    steps = F.broadcast(nodes) if fits_broadcast(nodes) else nodes
    at = rows.select(F.col(key), F.col(values).alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    at = at.withColumn("node", F.lit(ROOT))
    for _ in range(depth):
        x = F.get("_x", "feature")
        left = F.when(F.col("threshold").isNotNull(), x <= F.col("threshold")).otherwise(F.array_contains("categories", x))
        step = F.when(F.col("feature").isNull(), F.col("node")).when(left, F.col("left")).otherwise(F.col("right"))
        at = at.join(steps, ["tree", "node"]).select(key, "_x", "tree", step.alias("node"))
    return at.join(steps, ["tree", "node"]).groupBy(key).agg(F.sum("value").alias("total"))


def replayed(nodes: DataFrame, model: RandomForestClassificationModel | GBTClassificationModel, rows: DataFrame, key: str, values: str) -> DataFrame:
    """``key`` and ``probability`` of the positive class, from the node table alone."""
    trees, depth = model.getNumTrees, max(t.depth for t in model.trees)
    total = walk(nodes, rows, key, values, trees, depth)
    if isinstance(model, GBTClassificationModel):
        return total.select(key, (1 / (1 + F.exp(-2 * F.col("total")))).alias("probability"))
    return total.select(key, (F.col("total") / trees).alias("probability"))
