"""Key lookups that hold up when the looked-up table is large or one key is hot."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only when counted to hold at most this many (narrow) rows.
BROADCAST_ROWS = 500_000
# Largest share of the rows that a key may hold without being hot.
HOT_SHARE = 0.005
_PROBE_ROWS = 1_000_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> dict:
    """Keys (null among them) holding a large share of ``df`` and that share.

    Large is, unless given, two average partitions, at most ``HOT_SHARE``.

    Only the placement of rows depends on this, never the result, so a probe of the key column is
    enough; at most ``2 / share`` keys come back.
    """
    if share is None:
        share = min(HOT_SHARE, 2 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    total = df.count()
    if not total:
        return {}
    probe = df.select(key)
    if total > _PROBE_ROWS:
        probe = probe.sample(_PROBE_ROWS / total, seed=11)
    counts = probe.groupBy(key).count()
    size = min(total, _PROBE_ROWS)
    rows = counts.filter(F.col("count") >= math.ceil(size * share / 2)).collect()
    return {r[key]: r["count"] / size for r in rows}


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str, hot: dict) -> DataFrame:
    """Equi-join with the rows of hot keys spread over several tasks.

    Left rows of a hot key get a salt computed from the whole row (the same on a retry); the few
    right rows of hot keys are repeated once per salt.
    """
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(2, math.ceil(partitions * max(hot.values())))
    is_hot = F.col(key).isin([k for k in hot if k is not None])
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), salt).otherwise(0))
    every = F.array(*[F.lit(i) for i in range(salts)]) if salts <= 64 else F.sequence(F.lit(0), F.lit(salts - 1))
    right = right.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Join ``left`` to a table unique on ``key``.

    Broadcast when the counted size allows it, else a shuffle join with hot keys salted. ``probe`` is
    a stored table whose ``key`` is spread like that of ``left``, to look for hot keys cheaply.
    """
    if fits_broadcast(right, max_rows):
        return left.join(F.broadcast(right), key, how)
    hot = hot_keys(left if probe is None else probe, key)
    if not hot:
        return left.join(right, key, how)
    return salted_join(left, right, key, how, hot)
