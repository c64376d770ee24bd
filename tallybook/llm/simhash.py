"""SimHash fingerprints and near-duplicate groups found through pivot distance tables.

Rows with one fingerprint are one node. Each node carries its Hamming distances to fixed reference
fingerprints (pivots). By the triangle inequality, two fingerprints at most ``BITS`` bits apart differ by at
most ``BITS`` in every such distance, so a pair with a larger difference is discarded without comparing the
fingerprints; the bits of the survivors are counted. Only nodes that agree in two of four 16-bit quarters are
paired (two changed bits touch at most two quarters, so no link is lost). In a bucket of more than
``BUCKET`` nodes, links come from neighbourhoods instead: two fingerprints at most two bits apart share a
fingerprint at most one bit from both. That takes 65 rows a node, whatever the size of the bucket.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallybook.llm.common import filled, slices, strings, words_of
from tallybook.llm.components import components
from tallybook.staging import Stage

SHINGLE_WORDS = 3
SEED = 42
BITS = 2
PIVOTS = 16
BUCKET = 64


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, as signed longs."""
    return [xxhash.xxh64_intdigest(f"pivot {i}", 0) - (1 << 63) for i in range(n)]


def _fingerprints(texts: pa.Array) -> np.ndarray:
    bounds, words = words_of(pc.ascii_lower(filled(texts)))
    counts = np.diff(bounds)
    prints = np.zeros(len(counts), dtype=np.uint64)
    if not len(words):
        return prints
    # Shingle i starts at word i; those that would run into the next text are left out.
    left = bounds[1:] - 1
    doc = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(len(words)) + SHINGLE_WORDS - 1 <= left[doc]
    shingles = []
    if len(words) >= SHINGLE_WORDS:
        parts = [words.slice(k, len(words) - SHINGLE_WORDS + 1) for k in range(SHINGLE_WORDS)]
        starts = whole[: len(words) - SHINGLE_WORDS + 1]
        shingles = strings(pc.binary_join_element_wise(*parts, " ").filter(pa.array(starts)))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles))
    per_doc = np.maximum(counts - SHINGLE_WORDS + 1, 0)
    ends = np.cumsum(per_doc)
    for d in np.flatnonzero(per_doc):
        own = hashes[ends[d] - per_doc[d] : ends[d]]
        ones = np.unpackbits(own.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        prints[d] = np.packbits(2 * ones > len(own)).view(">u8")[0]
    for d in np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS)):
        prints[d] = xxhash.xxh64_intdigest(" ".join(words.slice(bounds[d], counts[d]).to_pylist()), SEED)
    return prints


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: Column) -> DataFrame:
    """``doc_id``, ``fp``, the fingerprint as a signed long, and the columns ``more``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *more)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches):
        for batch in slices(batches, "text"):
            prints = _fingerprints(batch.column("text")).view(np.int64)
            names = [f.name for f in kept]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(prints)], [*names, "fp"])

    return rows.mapInArrow(run, StructType([*kept, StructField("fp", LongType())]))


def _xor(a, b):
    return F.col(a).bitwiseXOR(F.col(b) if isinstance(b, str) else b)


def links(nodes: DataFrame, stage: Stage) -> DataFrame:
    """Links between distinct fingerprints (``fp``) at most ``BITS`` bits apart that connect as all of them do."""
    coordinates = [F.bit_count(_xor("fp", F.lit(p))).cast("byte").alias(f"p{i}") for i, p in enumerate(pivots())]
    table = stage.table(nodes.select("fp", *coordinates), "pivot-distances")
    quarter = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    keys = [F.lit(n << 32).cast("long").bitwiseOR(F.shiftleft(quarter[a], 16)).bitwiseOR(quarter[b])
            for n, (a, b) in enumerate(combinations(range(4), 2))]
    keyed = table.withColumn("key", F.explode(F.array(*keys)))
    sizes = stage.table(keyed.groupBy("key").count().filter("count > 1"), "buckets")
    small = stage.table(
        keyed.join(sizes.filter(F.col("count") <= BUCKET).select("key"), "key"), "bucketed")
    near = [F.abs(F.col(f"a.p{i}") - F.col(f"b.p{i}")) <= BITS for i in range(PIVOTS)]
    pairs = small.alias("a").join(
        small.alias("b"),
        reduce(lambda x, y: x & y, near, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")))
        & (F.bit_count(_xor("a.fp", "b.fp")) <= BITS))
    pairs = pairs.select(F.col("b.fp").alias("u"), F.col("a.fp").alias("v")).distinct()

    crowded = keyed.select("key", "fp").join(
        sizes.filter(F.col("count") > BUCKET).select("key"), "key").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - ((i == 63) << 64)).cast("long") for i in range(64)])
    around = crowded.withColumn("flip", F.explode(flips)).select("fp", _xor("fp", "flip").alias("middle"))
    # At most 65 fingerprints lie within one bit of a middle, so the set is bounded.
    met = around.groupBy("middle").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = met.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).filter("u <> v")
    return pairs.unionAll(stars)


def _named(rows: DataFrame, stage: Stage) -> DataFrame:
    """``fp``, ``component`` and ``component_id`` of every fingerprint."""
    nodes = stage.table(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    parts = stage.table(components(links(nodes, stage), stage), "components")
    grouped = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    smallest = stage.table(grouped.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest")
    return stage.table(grouped.join(smallest, "component").select("fp", "component", "component_id"), "named")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", stage: Stage | None = None,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id of the row's group.

    A null, empty or blank text has fingerprint zero and is linked like any other. Every input row gives a row:
    repeated rows and repeated ids fall into one group. A null id is never a ``component_id``, unless a whole group has
    only null ids. No rows give no rows; other columns are not carried, so names cannot clash.
    """
    stage = stage or Stage(docs.sparkSession)
    rows = stage.table(fingerprints(docs, key, text), "fingerprints")
    return rows.join(_named(rows, stage).select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", stage: Stage | None = None) -> DataFrame:
    """One row of each group of ``near_duplicates``, all columns as they are: the row with the group's smallest id.

    ``docs`` must be a stored Parquet table: a row is known by its file and place. Of rows that share the smallest id, and in a
    group of null ids, the first by file and place stays. Names of other columns cannot clash.
    """
    stage = stage or Stage(docs.sparkSession)
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place")]
    rows = stage.table(fingerprints(docs, key, text, *at), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_file", "_place")).alias("first")
    groups = rows.join(_named(rows, stage).select("fp", "component"), "fp").groupBy("component").agg(first)
    kept = groups.select("first._file", "first._place")
    whole = docs.select(F.struct(*docs.columns).alias("row"), *at)
    # Always by shuffle: the rows kept grow with the documents, so a broadcast would only ever suit small inputs.
    return whole.join(stage.table(kept, "kept").hint("merge"), ["_file", "_place"], "left_semi").select("row.*")
