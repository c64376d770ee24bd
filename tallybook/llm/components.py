"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and an equi-join, written to the shared folder, so nothing is collected and
a lost executor repeats one step. Minima are written before they are joined: the joins then see two plain
shuffles, which adaptive execution can split where a centre has many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.staging import Stage


def _down(pairs: DataFrame) -> DataFrame:
    """Distinct edges from the larger node ``u`` to the smaller ``v``."""
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node of ``edges`` (``u``, ``v`` long).

    Loops, repeated edges and either direction are fine; edges with a null end link nothing; no edges give no rows.
    """
    now = stage.table(_down(edges), "edges")
    while not now.isEmpty():
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage.table(both.groupBy("u").agg(F.least("u", F.min("v")).alias("low")), "large-star")
        large = stage.table(
            _down(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))), "large")
        low = stage.table(large.groupBy("u").agg(F.min("v").alias("low")), "small-star")
        moved = large.join(low, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        now = stage.table(_down(moved.unionAll(low.select("u", F.col("low").alias("v")))), "small")
        # Stars at last: each node has one parent, and no parent has a parent.
        if now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() and now.count() == low.count():
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
