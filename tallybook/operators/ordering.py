"""Global order without a single-task sort.

A window without ``partitionBy`` sends every row to one task, and a window per group sends a hot
group to one task. Here rows are range-partitioned on the whole sort key (a tie or a hot leading
value still splits), written once with their part number and their row number inside the part, and
only one small line per part travels through the driver. Ranks, running totals and per-group
sequences then follow from part offsets, whatever the skew.

Sort keys must be total orders; results then do not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.staging import Stage, stage_of

PART, ROW = "_part", "_row"
_ROW_MASK = (1 << 33) - 1
#: Rows of a group that one task orders; larger groups are cut into range parts.
LARGE_GROUP = 1_000_000
#: Rows that go through shuffles in one turn, unless that makes more than so many turns.
TURN_ROWS, TURNS = 16_000_000, 8
#: Distance of the part numbers of two turns.
_TURN_PARTS = 1 << 20
#: Stored source bytes for each range part.
PART_BYTES = 128 << 20
#: Spark's statistic for a source of unknown size is near 2 ** 63.
_UNKNOWN_BYTES = 1 << 60


def turns_of(counts: Iterable[tuple]) -> list[list]:
    """Keys with their rows, in order, cut into stretches that go one after the other; few rows make one stretch."""
    counts = list(counts)
    size = max(TURN_ROWS, -(-sum(n for _, n in counts) // TURNS))
    found, held = [[]], 0
    for key, n in counts:
        if found[-1] and held + n > size:
            found.append([])
            held = 0
        found[-1].append(key)
        held += n
    return found


def in_turns(df: DataFrame, key: str) -> list[DataFrame]:
    """``df`` cut by a stored column of few values into frames that follow one another in its order, nulls first."""
    counts = df.groupBy(key).agg(F.count("*").alias("n")).collect()  # a row for each value
    counts = sorted(((r[key], r["n"]) for r in counts), key=lambda c: (c[0] is not None, c[0]))
    turns = turns_of(counts)
    if len(turns) == 1:
        return [df]
    found = []
    for turn in turns:
        known = [k for k in turn if k is not None]
        within = F.col(key).between(known[0], known[-1]) if known else F.lit(False)
        found.append(df.filter(within if len(known) == len(turn) else within | F.col(key).isNull()))
    return found


@dataclass
class Ordered:
    """A written table in global order; ``parts`` holds one summary line per part."""

    df: DataFrame
    parts: list[Row] = field(repr=False)
    plain: list[str] = field(repr=False)

    @property
    def rows(self) -> int:
        return sum(p["rows"] for p in self.parts)

    def starts(self) -> dict[int, int]:
        """Rows before each part."""
        counts = [p["rows"] for p in self.parts]
        return dict(zip([p[PART] for p in self.parts], accumulate([0, *counts])))

    def turns(self) -> list[list[int]]:
        """Parts that go one after the other through a plan that shuffles their rows."""
        return turns_of((p[PART], p["rows"]) for p in self.parts)

    def ranked(self, name: str, parts: Sequence[int] | None = None) -> DataFrame:
        """Dense 1..N number in the order, of all rows or of a stretch of parts; a narrow map over the written table."""
        rows = self.df.filter(F.col(PART).between(parts[0], parts[-1])) if parts else self.df
        schema = T.StructType([T.StructField(PART, T.IntegerType()), T.StructField("_start", T.LongType())])
        # One line per range part, so the broadcast is bounded by the number of shuffle partitions.
        starts = self.df.sparkSession.createDataFrame(list(self.starts().items()), schema)
        numbered = rows.join(F.broadcast(starts), PART)
        return numbered.select(*self.plain, (F.col("_start") + F.col(ROW) + 1).alias(name))

    def at_ranks(self, ranks: Sequence[int]) -> dict[int, Row]:
        """Rows at the given (few) 1-based ranks."""
        wanted = None
        starts = self.starts()
        for rank in set(ranks):
            for p in self.parts:
                start = starts[p[PART]]
                if start < rank <= start + p["rows"]:
                    hit = (F.col(PART) == p[PART]) & (F.col(ROW) == rank - start - 1)
                    wanted = hit if wanted is None else wanted | hit
        if wanted is None:
            return {}
        return {starts[r[PART]] + r[ROW] + 1: r for r in self.df.filter(wanted).collect()}


def source_bytes(df: DataFrame) -> int:
    """Stored bytes that a plan reads, from the statistics of its leaves; those without any count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(n for n in sizes if n < _UNKNOWN_BYTES)


def ranged(df: DataFrame, order_by: Sequence[Column | str]) -> DataFrame:
    """``df`` range-partitioned, in more parts than the session's number where the sources are large."""
    parts = -(-source_bytes(df) // PART_BYTES)
    if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartitionByRange(parts, *order_by)
    return df.repartitionByRange(*order_by)  # adaptive execution may merge small ones


def lay_out(
    df: DataFrame | Sequence[DataFrame],
    order_by: Sequence[Column | str],
    stage: Stage | None = None,
    name: str = "ordered",
    **summary: Column,
) -> Ordered:
    """Write ``df`` range-partitioned and sorted; ``summary`` adds aggregates per part.

    Of several frames all rows of one must come before those of the next; they are laid out one after the other.
    """
    frames = [df] if isinstance(df, DataFrame) else df
    laid = (
        ranged(one, order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(PART, F.spark_partition_id() + F.lit(turn * _TURN_PARTS))
        .withColumn(ROW, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK)))
        for turn, one in enumerate(frames)
    )
    written = stage_of(frames[0], stage).table(laid, name)
    aggregates = [F.count("*").alias("rows"), *[c.alias(n) for n, c in summary.items()]]
    parts = written.groupBy(PART).agg(*aggregates).collect()  # one line per part
    return Ordered(written, sorted(parts, key=lambda r: r[PART]), frames[0].columns)


def dense_key(
    df: DataFrame, order_by: Sequence[Column | str], key: str, stage: Stage | None = None
) -> DataFrame:
    """``row_number() over (order by ...)`` for tables of any size."""
    return lay_out(df, order_by, stage, key).ranked(key)


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column | str],
    totals: dict[str, str],
    rank: str | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Inclusive running sums (``totals``: new column -> summed column) in global order."""
    sums = {f"_sum_{out}": F.coalesce(F.sum(c), F.lit(0)) for out, c in totals.items()}
    laid = lay_out(df, order_by, stage, "running", **sums)
    types = laid.df.select(*[c.alias(n) for n, c in sums.items()]).schema
    before = {n: list(accumulate([p[n] for p in laid.parts], initial=0)) for n in sums}
    starts = laid.starts()
    lines = [
        (p[PART], starts[p[PART]], *[before[n][i] for n in sums]) for i, p in enumerate(laid.parts)
    ]
    schema = T.StructType(
        [T.StructField(PART, T.IntegerType()), T.StructField("_start", T.LongType()), *types.fields])
    offsets = df.sparkSession.createDataFrame(_fit(lines, schema), schema)
    w = W.partitionBy(PART).orderBy(ROW).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = laid.df.join(F.broadcast(offsets), PART)  # one line per part
    out = [(F.sum(c).over(w) + F.col(f"_sum_{o}")).alias(o) for o, c in totals.items()]
    if rank:
        out.append((F.col("_start") + F.col(ROW) + 1).alias(rank))
    return joined.select(*laid.plain, *out)


def _fit(lines: list[tuple], schema: T.StructType) -> list[tuple]:
    def fit(value, dtype):
        if isinstance(dtype, T.DecimalType):
            return Decimal(value)
        return float(value) if isinstance(dtype, T.DoubleType) else value

    return [tuple(fit(v, f.dataType) for v, f in zip(line, schema.fields)) for line in lines]


def sequence_within(
    df: DataFrame,
    group: str,
    order_by: Sequence[str],
    sequence: str,
    previous: dict[str, str] | None = None,
    first: dict[str, str] | None = None,
    rank: str | None = None,
    stage: Stage | None = None,
    large: int = LARGE_GROUP,
) -> DataFrame:
    """Per-group row number, previous value and first value, for groups of any size; groups must not be null.

    Equals ``row_number``/``lag``/``first_value`` over ``(partition by group order by order_by)``. The rows are written once
    and counted. Groups of up to ``large`` rows go by hash, in one shuffle; larger ones are cut into range parts. ``rank`` is the
    number in the order of all groups, from 1: what the groups before hold, plus the sequence.
    """
    previous, first = previous or {}, first or {}
    stage = stage_of(df, stage)
    stored = stage.table(df, sequence)
    sizes = stored.groupBy(group).agg(F.count("*").alias("_size"))
    if rank:
        sizes = running_totals(stage.table(sizes, "sizes"), [group], {"_upto": "_size"}, stage=stage)
    huge = stage.table(sizes.filter(F.col("_size") > large).select(group), "large-groups")
    w = W.partitionBy(group).orderBy(*order_by)
    columns = [
        F.row_number().over(w).alias(sequence), *[F.lag(c).over(w).alias(o) for o, c in previous.items()],
        *[F.first(c).over(w).alias(o) for o, c in first.items()]]
    if huge.isEmpty():
        placed = stored.select("*", *columns)
    else:
        # Counting and joining by group leave the rows where the window needs them.
        placed = stored.join(huge, group, "left_anti").select(*stored.columns, *columns).unionByName(
            _sequence_of_large(stored.join(huge, group, "left_semi"), group, order_by, sequence, previous, first, stage))
    if not rank:
        return placed
    before = sizes.select(group, (F.col("_upto") - F.col("_size")).alias("_before"))
    return placed.join(before, group).withColumn(rank, F.col("_before") + F.col(sequence)).select(*placed.columns, rank)


def _sequence_of_large(
    df: DataFrame, group: str, order_by: Sequence[str], sequence: str, previous: dict[str, str], first: dict[str, str], stage: Stage,
) -> DataFrame:
    """The same by range parts.

    Windows run per (part, group), so no task sees more than one part of a group; what a group
    brings along from earlier parts is carried over as one line per part.
    """
    laid = lay_out(
        df, [group, *order_by], stage, sequence, _low=F.min(group), _high=F.max(group))
    spark = df.sparkSession

    spanning = sorted({a["_high"] for a, b in zip(laid.parts, laid.parts[1:]) if a["_high"] == b["_low"]})
    carried = {}
    if spanning:  # at most one group per part boundary
        ends = (
            laid.df.filter(F.col(group).isin(spanning))
            .groupBy(PART, group)
            .agg(
                F.count("*").alias("n"),
                *[F.max_by(c, ROW).alias(f"last_{o}") for o, c in previous.items()],
                *[F.min_by(c, ROW).alias(f"first_{o}") for o, c in first.items()],
            )
            .collect()
        )
        by_group: dict = {}
        for e in sorted(ends, key=lambda r: r[PART]):
            seen = by_group.get(e[group])
            if seen:
                carried[e[PART]] = (e[group], seen["n"], *seen["last"], *seen["first"])
            by_group[e[group]] = {
                "n": e["n"] + (seen["n"] if seen else 0),
                "last": [e[f"last_{o}"] for o in previous],
                "first": seen["first"] if seen else [e[f"first_{o}"] for o in first],
            }

    dtype = {f.name: f.dataType for f in laid.df.schema.fields}
    schema = T.StructType(
        [
            T.StructField(PART, T.IntegerType()),
            T.StructField("_group", dtype[group]),
            T.StructField("_n", T.LongType()),
            *[T.StructField(f"_last_{o}", dtype[c]) for o, c in previous.items()],
            *[T.StructField(f"_first_{o}", dtype[c]) for o, c in first.items()],
        ])
    blank = (None,) * (len(schema) - 1)
    lines = [(p[PART], *carried.get(p[PART], blank)) for p in laid.parts]
    carry = spark.createDataFrame(lines, schema)

    joined = laid.df.join(F.broadcast(carry), PART)  # one line per part
    w = W.partitionBy(PART, group).orderBy(ROW)
    continued = F.col(group) == F.col("_group")
    out = [(F.row_number().over(w) + F.when(continued, F.col("_n")).otherwise(0)).cast("int").alias(sequence)]
    for o, c in previous.items():
        out.append(F.coalesce(F.lag(c).over(w), F.when(continued, F.col(f"_last_{o}"))).alias(o))
    for o, c in first.items():
        out.append(F.when(continued, F.col(f"_first_{o}")).otherwise(F.first(c).over(w)).alias(o))
    return joined.select(*laid.plain, *out)
