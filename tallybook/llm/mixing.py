"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations only.

Sources get targets: the total size shared by weight, but at most ``cap`` times a source's own size, the excess shared
again by weight. Targets become whole blocks of up to ``BLOCK_WORDS`` words (fewer where a source's target is below four such
blocks), given to sources by the highest quotients target / (2k - 1); each source's blocks go to its shards the same way. Where
the cap on a shard cuts its last block, the part of it below the cap is taken. A shard orders its documents by a seeded mark
and lays their words on a circle; its quota of blocks is taken in a row from a seeded block on, around the circle as
often as needed.

A shard holds about ``SHARD_WORDS`` words of one source, so a hot source spreads over many. Documents without words take no part in
any order. The only
windows over all rows of something are over sources, and over the shards of a source (one narrow row each).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import WORD
from tallybook.operators.joins import lookup_join
from tallybook.staging import Stage

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK_WORDS = 64
SHARD_WORDS = 1_000_000
SEED = "mix-1"


def _number(md5: Column) -> Column:
    return F.conv(F.substring(md5, 1, 8), 16, 10).cast("long")


def _sized(docs: DataFrame, key: str, source: str, text: str, seed: str, *more: Column) -> DataFrame:
    content = F.coalesce(F.col(text), F.lit(""))
    named = F.when(F.col(source).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source)))
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), content))
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), named.alias("name"),
        F.regexp_count(content, F.lit(WORD)).cast("long").alias("size"), mark.alias("mark"), *more)


def apportion(df: DataFrame, within: Sequence[str], order: str, weight: str, seats: str, out: str) -> DataFrame:
    """Whole seats by highest quotients weight / (2k - 1) among the rows of each ``within`` group; ties by ``order``.

    Bounds on the last quotient taken give all but a few seats a row directly, so a row competes with a few
    quotients only, however many seats there are.
    """
    group = W.partitionBy(*[F.col(c) for c in within])
    total, n = F.sum(weight).over(group), F.count("*").over(group)
    share = F.when(total > 0, F.col(weight) / total).otherwise(0.0)
    # Quotients of at least total / (2 seats - n) are surely taken; the last one is at least total / (2 seats + n).
    sure = F.greatest(F.lit(0), F.floor((share * (2 * F.col(seats) - n) + 1) / 2).cast("long") - 1)
    most = F.floor((share * (2 * F.col(seats) + n) + 1) / 2).cast("long") + 1
    bounded = df.withColumn("_sure", sure).withColumn("_most", F.greatest(most, F.col("_sure"))).withColumn(
        "_open", F.col(seats) - F.sum("_sure").over(group))
    ks = F.when((F.col(weight) > 0) & (F.col("_most") > F.col("_sure")), F.sequence(F.col("_sure") + 1, F.col("_most")))
    quotients = bounded.withColumn("_k", F.explode_outer(ks)).withColumn("_quotient", F.col(weight) / (2 * F.col("_k") - 1))
    ranked = quotients.withColumn(
        "_rank", F.row_number().over(group.orderBy(F.col("_quotient").desc_nulls_last(), order, "_k")))
    won = F.sum(F.when(F.col("_k").isNotNull() & (F.col("_rank") <= F.col("_open")), 1).otherwise(0))
    return ranked.groupBy(*df.columns, "_sure").agg(won.alias("_won")).withColumn(
        out, F.col("_sure") + F.col("_won")).drop("_sure", "_won")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``name``, ``source_size``, ``target`` and the number of ``blocks`` in all, from a row per source."""
    everything = W.partitionBy()
    # "s..." sorts by code point; "n", the null source, comes last.
    place = F.row_number().over(everything.orderBy(F.col("name") == "n", "name"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    df = sizes.withColumn("weight", weight).withColumn("total", F.sum("source_size").over(everything))
    by_ratio = everything.orderBy(cap * F.col("source_size") / F.col("weight"), "name")
    capped = F.coalesce(F.sum(cap * F.col("source_size")).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    df = df.withColumn("level", (F.col("total") - capped) / rest)
    held = F.when(F.col("level") <= cap * F.col("source_size") / F.col("weight"), F.col("level"))
    df = df.withColumn("level", F.max(held).over(everything))
    target = F.least((cap * F.col("source_size")).cast("double"), F.col("level") * F.col("weight"))
    return df.select("name", "source_size", "total", target.alias("target"))


def _placed(
    docs: DataFrame, key: str, source: str, text: str, seed: str, weights: Sequence[int], cap: int,
    block_words: int, shard_words: int, stage: Stage, *more: Column,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their place ``c0``..``c1`` on their shard's circle and the stretch taken from it, and rows without words."""
    sized = stage.table(_sized(docs, key, source, text, seed), "sizes")
    sources = targets(sized.groupBy("name").agg(F.sum("size").alias("source_size")), weights, cap)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(W.partitionBy())
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.coalesce(least, F.lit(0)) / 4))).cast("long")
    sources = sources.withColumn("block", block).withColumn("blocks", F.round(F.col("total") / F.col("block")).cast("long"))
    sources = apportion(sources, [], "name", "target", "blocks", "quota").withColumn(
        "shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
    sources = stage.table(sources.select("name", "source_size", "target", "block", "quota", "shards"), "sources")

    def with_source(rows):
        return lookup_join(rows, sources, "name", "inner", probe=sized).withColumn(
            "shard", F.pmod(_number(F.col("mark")), F.col("shards")))

    # A row for each shard, and beside it what its source has.
    shards = with_source(sized).groupBy("name", "shard", "quota", "block").agg(F.sum("size").alias("circle"))
    shards = apportion(shards, ["name"], "shard", "circle", "quota", "blocks")
    words, start = F.least(F.col("blocks") * F.col("block"), cap * F.col("circle")), F.ceil(F.col("circle") / F.col("block"))
    first = _number(F.md5(F.concat_ws(":", F.lit(seed), "name", F.col("shard").cast("string"))))
    shards = shards.select(
        "name", "shard", "circle", words.alias("words"),
        (F.pmod(first, F.greatest(F.lit(1), start).cast("long")) * F.col("block")).alias("start"))
    shards = stage.table(shards, "shards")

    rows = (with_source(_sized(docs, key, source, text, seed, *more)) if more else with_source(sized)).filter("size > 0")
    order = W.partitionBy("name", "shard").orderBy("mark", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("c1", F.sum("size").over(order)).withColumn("c0", F.col("c1") - F.col("size"))
    whole = F.when(F.col("circle") > 0, F.floor(F.col("words") / F.col("circle")).cast("long")).otherwise(0)
    rows = rows.join(shards, ["name", "shard"]).withColumn("laps", whole)
    stop = F.col("start") + F.col("words") - F.col("laps") * F.col("circle")
    cuts = {"a0": F.greatest("c0", "start"), "a1": F.least(F.col("c1"), stop),
            "b0": F.col("c0"), "b1": F.least(F.col("c1"), stop - F.col("circle"))}
    return rows.withColumns(cuts), with_source(sized.filter("size = 0"))


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: str = SEED,
    weights: Sequence[int] = WEIGHTS, cap: int = CAP, block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS, stage: Stage | None = None,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` for every row of ``docs``.

    Null and empty texts have size 0 and nothing is taken. A null source is a source, after all others. Repeated rows share
    the circle like other documents; equal rows are interchangeable. No row gives more than ``cap`` times its
    words. Sources of no words have target 0. No rows give no rows. Other columns are not carried, so names cannot clash.
    """
    stage = stage or Stage(docs.sparkSession)
    rows, empty = _placed(docs, key, source, text, seed, weights, cap, block_words, shard_words, stage)
    cut = F.greatest(F.lit(0), F.col("a1") - F.col("a0")) + F.greatest(F.lit(0), F.col("b1") - F.col("b0"))
    taken = F.col("laps") * F.col("size") + cut
    names = ["doc_id", "size", "source_size", "target"]
    return rows.select(*names, taken.cast("long").alias("taken")).unionAll(empty.select(*names, F.lit(0).cast("long")))


def mixed(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", length: str = "n_chars",
    stage: Stage | None = None,
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a text is taken.

    A text cut by the end of a stretch keeps the words taken, joined by single blanks, and its new ``length``. Null and empty texts
    give no row, nor does an empty table; nulls elsewhere stay. Repeated rows are taken like others, ties of marks go by id; texts
    of any length are cut by words. Columns may have any names.
    """
    stage = stage or Stage(docs.sparkSession)
    rows, _ = _placed(docs, key, source, text, SEED, WEIGHTS, CAP, BLOCK_WORDS, SHARD_WORDS, stage,
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    pieces = F.concat(
        F.array_repeat(F.struct(F.lit(0).cast("long").alias("lo"), F.col("size").alias("hi")), F.col("laps").cast("int")),
        F.array(*[F.struct((F.col(f"{c}0") - F.col("c0")).alias("lo"), (F.col(f"{c}1") - F.col("c0")).alias("hi"))
                  for c in "ab"]))
    rows = rows.withColumn("piece", F.explode(F.filter(pieces, lambda p: p["hi"] > p["lo"])))
    cut = (F.col("piece.hi") - F.col("piece.lo")) < F.col("size")
    words = F.regexp_extract_all(F.col("row").getField(text), F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, (F.col("piece.lo") + 1).cast("int"), (F.col("piece.hi") - F.col("piece.lo")).cast("int")), " ")
    rows = rows.withColumn("piece_text", F.when(cut, part).otherwise(F.col("row").getField(text)))
    kinds = dict(docs.dtypes)
    replaced = {text: F.col("piece_text"), length: F.when(cut, F.length("piece_text").cast(kinds.get(length, "long"))).otherwise(
        F.col("row").getField(length)) if length in kinds else None}
    return rows.select(*[(replaced[c] if c in replaced else F.col("row").getField(c)).alias(c) for c in docs.columns])
