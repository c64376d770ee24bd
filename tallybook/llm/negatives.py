"""Hard-negative mining with exact integer scores.

Scores are inner products of integer vectors. They come from a residue number system: the vectors modulo a few small primes
are multiplied as float32 matrices, where every partial sum is a whole number below 2 ** 24 and so exact, and Chinese
remaindering (mixed radix) puts the signed score together. As many primes are taken as the longest vector needs.

Rows are dealt to blocks of bounded size and anchors meet every block in chunks, so a task holds one block and one chunk.
A block sends the best few rows of each anchor; windows choose among those.

1. ``positives``: the best rows of the anchor's label, itself aside.
2. ``negatives``: for each positive, the best rows of other labels whose score lies in a window below the positive's.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.staging import Stage, stage_of

#: Components of a block of rows; a task holds its residues, one byte for each prime.
BLOCK_VALUES = 1 << 24
#: Anchors and rows that are multiplied at once.
ANCHORS, ROWS = 256, 2048
#: Products of residues that sum up below 2 ** 24: 1,024 * 125 * 125.
INNER = 1024
#: Squared length that an integer vector stays below, so that a hundred times any score fits a long.
LONGEST = 1 << 55
_NONE = np.iinfo(np.int64).min

_SCORED = "anchor long, anchor_id long, place int, positive_id long, positive_score long, other_id long, score long"


def primes_for(bound: int) -> list[int]:
    """Largest primes below 256 whose product exceeds twice ``bound``."""
    found, product = [], 1
    for n in range(251, 2, -2):
        if product > 2 * bound:
            break
        if all(n % d for d in range(3, math.isqrt(n) + 1, 2)):
            found.append(n)
            product *= n
    return found


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Residues nearest to zero, one byte each."""
    return [(np.mod(vectors + p // 2, p) - p // 2).astype(np.int8) for p in primes]


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of ``left`` and ``right``, given by their residues."""
    digits, value, weight = [], 0, 1
    for i, p in enumerate(primes):
        a, b = left[i].astype(np.float32), right[i].astype(np.float32)
        t = np.zeros((len(a), len(b)))
        for k in range(0, a.shape[1], INNER):
            t += a[:, k:k + INNER] @ b[:, k:k + INNER].T
        t -= p * np.rint(t / p)
        for q, digit in zip(primes, digits):
            t = (t - digit) * pow(q, -1, p)
            t -= p * np.rint(t / p)
        digits.append(t)
        value = value + weight * t.astype(np.int64)
        weight *= p
    return value


class _Pool:
    """Best ``k`` rows of each window of each anchor of a chunk so far."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low.copy(), high, k  # low rises to the k-th best
        self.held = tuple(np.zeros(0, np.int64) for _ in range(5))

    def add(self, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        few = allowed & (scores >= self.low.min(axis=1)[:, None]) & (scores <= self.high.max(axis=1)[:, None])
        a, r = np.nonzero(few)
        if not len(a):
            return
        s = scores[a, r]
        fits = (s[:, None] >= self.low[a]) & (s[:, None] <= self.high[a])
        n, w = np.nonzero(fits)
        new = (a[n], w, s[n], ids[r[n]], known[r[n]].astype(np.int64))
        a, w, s, i, known = (np.concatenate(x) for x in zip(self.held, new))
        order = np.lexsort((i, -known, -s, w, a))
        a, w, s, i, known = (x[order] for x in (a, w, s, i, known))
        group = a * self.low.shape[1] + w
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
        last = place == self.k - 1
        self.low[a[last], w[last]] = s[last]
        best = place < self.k
        self.held = tuple(x[best] for x in (a, w, s, i, known))


def _runs(batch: pa.RecordBatch, *names: str):
    """Stretches of equal values of the given columns."""
    columns = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names])
    cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
    for start, stop in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
        yield tuple(int(c[start]) for c in columns), batch.slice(start, stop - start)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False)


def _vectors(part: pa.RecordBatch, size: int) -> np.ndarray:
    return part.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, size)


def _windows(part: pa.RecordBatch, name: str, width: int, fill: int) -> np.ndarray:
    lists = part.column(name)
    n = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((part.num_rows, width), fill, np.int64)
    out[np.arange(width) < n[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _compare(primes: list[int], same: bool, windows: int, k: int):
    """Task function: rows of a block come first (``side`` 0), then the anchors that meet it, both by size and label."""
    def chunk(part, block):
        ids, known, labels, marks, sides = block
        mine, mark, own = (part.column(c).to_numpy(zero_copy_only=False) for c in ("label", "mark", "id_known"))
        low, high = _windows(part, "low", windows, np.iinfo(np.int64).max), _windows(part, "high", windows, _NONE)
        pool = _Pool(low, high, k)
        left = residues(_vectors(part, sides[0].shape[1]).astype(np.int64), primes)
        first, last = (np.searchsorted(labels, mine[0]), np.searchsorted(labels, mine[-1], "right")) if same else (0, len(ids))
        for s in range(first, last, ROWS):
            e = min(s + ROWS, last)
            scores = products(left, [x[s:e] for x in sides], primes)
            alike = mine[:, None] == labels[None, s:e]
            allowed = alike & (mark[:, None] != marks[None, s:e]) if same else ~alike
            if same and e - s > k:
                best = np.partition(np.where(allowed, scores, _NONE), e - s - k, axis=1)[:, e - s - k]
                pool.low[:, 0] = np.maximum(pool.low[:, 0], best)
            pool.add(scores, allowed, ids[s:e], known[s:e])
        a, w, score, other, there = pool.held
        anchor_ids = _numbers(part.column("id"))
        pos_ids = pos_scores = [None] * len(a)
        if not same:
            lists = [part.column(c).to_pylist() for c in ("pos_ids", "pos_scores")]
            pos_ids, pos_scores = ([x[i][j] for i, j in zip(a, w)] for x in lists)
        return pa.RecordBatch.from_arrays([
            pa.array(mark[a]), pa.array(anchor_ids[a], pa.int64(), mask=~own[a]), pa.array(w.astype(np.int32)),
            pa.array(pos_ids, pa.int64()), pa.array(pos_scores, pa.int64()),
            pa.array(other, pa.int64(), mask=there == 0), pa.array(score)],
            ["anchor", "anchor_id", "place", "positive_id", "positive_score", "other_id", "score"])

    def run(batches):
        task, kept, ready = None, {}, {}
        for batch in batches:
            for (now, side, size), part in _runs(batch, "task", "side", "size"):
                if now != task:
                    task, kept, ready = now, {}, {}
                if side == 0:
                    small = residues(_vectors(part, size).astype(np.int64), primes)
                    kept.setdefault(size, []).append((
                        _numbers(part.column("id")), part.column("id_known").to_numpy(zero_copy_only=False),
                        part.column("label").to_numpy(), part.column("mark").to_numpy(), small))
                    continue
                if size in kept:
                    ids, known, labels, marks, sides = zip(*kept.pop(size))
                    ready[size] = (*(np.concatenate(x) for x in (ids, known, labels, marks)),
                                   [np.concatenate(x) for x in zip(*sides)])
                if size in ready:
                    names = ("label",) if same else ("size",)
                    for _, run_ in _runs(part, *names):
                        for s in range(0, run_.num_rows, ANCHORS):
                            yield chunk(run_.slice(s, ANCHORS), ready[size])
    return run


def _met(rows: DataFrame, anchors: DataFrame, blocks: int, slices: int, function) -> DataFrame:
    """Every slice of the anchors against every block of the rows."""
    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(n, salt):
        return F.pmod(F.xxhash64("mark", F.lit(salt)), F.lit(n)).cast("int")

    no = F.lit(None).cast("array<long>")
    a = rows.withColumns({"block": dealt(blocks, "block"), "side": F.lit(0), **{c: no for c in _LISTS}})
    a = a.withColumn("slice", every(slices))
    b = anchors.withColumns({"slice": dealt(slices, "slice"), "side": F.lit(1)}).withColumn("block", every(blocks))
    columns = ["mark", "id", "id_known", "label", "size", "ints", "side", *_LISTS]
    task = (F.col("block") * slices + F.col("slice")).cast("int").alias("task")
    both = a.select(task, *columns).unionAll(b.select(task, *columns))
    # Nothing but the number decides the place: a task for each block and slice.
    placed = both.repartitionById(blocks * slices, "task").sortWithinPartitions("task", "side", "size", "label", "id")
    return placed.mapInArrow(function, _SCORED)


_LISTS = ("low", "high", "pos_ids", "pos_scores")


def _best(df: DataFrame, k: int, *group: str) -> DataFrame:
    w = W.partitionBy(*group).orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256, stage: Stage | None = None,
) -> DataFrame:
    """For each anchor (rows that fulfil ``anchors``) and each of its positives, the highest-scored allowed negatives.

    A component x counts as floor(scale * x). A row of another label is allowed if its score lies between ``least`` and
    ``most`` percent of the positive's, both included. Ties of scores go to the smaller key, null keys last.

    Rows with a null label or vector, or a null or non-finite component, take no part; nor do rows whose components count so
    much that a score might not fit (squared length of 2 ** 55). Vectors of different lengths have no score. A repeated row is a
    row of its own: it is a positive of its copy, and an anchor itself. An anchor without positives, or a positive without
    negatives, gives no row; an empty table gives none. Other columns do not matter, whatever their names.
    """
    stage = stage_of(rows, stage)
    x = F.transform(F.col(vector), lambda v: v.cast("double") * scale)
    size = F.aggregate(x, F.lit(0.0), lambda s, v: s + (F.abs(v) + 1) * (F.abs(v) + 1))
    taken = rows.select(
        F.monotonically_increasing_id().alias("mark"), F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"), x.alias("x"), size.alias("squares"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    taken = taken.filter(F.col("label").isNotNull() & (F.col("squares") < float(LONGEST)))
    ints = F.transform("x", lambda v: F.floor(v).cast("int"))
    stored = stage.table(taken.select(
        "mark", "id", F.col("id").isNotNull().alias("id_known"), "label", F.size("x").alias("size"), ints.alias("ints"),
        "is_anchor"), "rows")
    length = F.aggregate("ints", F.lit(0).cast("long"), lambda s, v: s + v.cast("long") * v.cast("long"))
    n, n_anchors, values, longest = stored.agg(
        F.count("*"), F.count_if("is_anchor"), F.sum(F.greatest("size", F.lit(1))), F.max(length)).first()
    primes = primes_for(longest or 1)

    # Blocks hold the rows once and slices the anchors once; both are sent as often as there are of the other.
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, math.ceil((values or 1) / BLOCK_VALUES))
    even = math.ceil(math.sqrt(tasks * max(1, n) / max(1, n_anchors)))
    blocks = max(math.ceil((values or 1) / BLOCK_VALUES), min(tasks, even))
    slices = max(1, round(tasks / blocks))
    table = stored.drop("is_anchor")
    few = stored.filter("is_anchor").drop("is_anchor")

    no = F.lit(None).cast("array<long>")
    wide = few.withColumns({"low": F.array(F.lit(_NONE + 1)), "high": F.array(F.lit(2**62)), "pos_ids": no, "pos_scores": no})
    close = _met(table, wide, blocks, slices, _compare(primes, True, 1, positives))
    best = _best(close, positives, "anchor").groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))).alias("best"))  # at most ``positives`` each
    low, high = f"-((-s * {least} - pmod(-s * {least}, 100L)) div 100)", f"(s * {most} - pmod(s * {most}, 100L)) div 100"
    windows = best.select(
        F.col("anchor").alias("mark"), F.col("best.other_id").alias("pos_ids"), F.col("best.score").alias("pos_scores"),
        F.expr(f"transform(best.score, s -> {low})").alias("low"), F.expr(f"transform(best.score, s -> {high})").alias("high"))
    windows = stage.table(few.join(windows, "mark"), "positives")
    far = _met(table, windows, blocks, slices, _compare(primes, False, positives, negatives))
    return _best(far, negatives, "anchor", "place").select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
