"""Substring dedup by content-defined chunks.

A gear rolling hash runs over the bytes of a text's words (blanks do not matter, so neither does line wrapping). A chunk ends
after a word where the hash meets a condition; the hash sees the last ``WINDOW`` bytes only, so an insertion moves the
chunk ends near it and no others. Among chunks found more than once, windows of adjacent ones with at least ``MIN_WORDS``
words count if the whole window is found more than once; such windows join to passages. The first occurrence of a window
in stored order is kept.

The counts per digest combine before the shuffle; the digests found twice are written before the join, so that a
passage which many documents share can be split over tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.common import slices, words_of
from tallybook.staging import Stage

#: Words per chunk on average, bytes that decide a chunk's end, words from which a repeated passage counts.
CHUNK_WORDS = 4
WINDOW = 24
MIN_WORDS = 20
_CHUNKS = "doc_id long, row long, n_words int, digests array<long>, places array<long>"


def _gear(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Hash of the up to ``WINDOW`` bytes before and at each byte; ``lead`` is the first byte's place of each byte's text."""
    table = np.random.default_rng(2024).integers(0, 1 << 63, 256, dtype=np.uint64)
    out = np.zeros(len(data), dtype=np.uint64)
    values = table[data]
    age = np.arange(len(data)) - lead
    for back in range(min(WINDOW, len(data))):  # the byte ``back`` places earlier, shifted as often as bytes came since
        moved = values[: len(data) - back] << np.uint64(back)
        out[back:] += np.where(age[back:] >= back, moved, np.uint64(0))
    return out


def _cut(texts: pa.Array):
    """Per text the number of words; for all chunks the text they belong to, first word, words and digest."""
    bounds, words = words_of(texts)
    counts = np.diff(bounds)
    if not len(words):
        none = np.zeros(0, np.int64)
        return counts, none, none, none, none
    flat = words.cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    raw = flat.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    doc = np.repeat(np.arange(len(counts)), counts)
    lead = np.repeat(offsets[bounds[:-1][counts > 0]], np.diff(np.append(offsets[bounds[:-1][counts > 0]], offsets[-1])))
    ends = (_gear(np.frombuffer(raw, np.uint8), lead)[offsets[1:] - 1] >> np.uint64(WINDOW)) % np.uint64(CHUNK_WORDS) == 0
    ends[bounds[1:][counts > 0] - 1] = True
    last = np.flatnonzero(ends)
    first = np.concatenate([[0], last[:-1] + 1])
    # The lengths of the words go into the digest, so that moved word bounds make another chunk.
    lengths = np.diff(offsets).astype("<u4").tobytes()
    digests = np.fromiter(
        (xxhash.xxh3_64_intdigest(raw[a:b], xxhash.xxh3_64_intdigest(lengths[4 * i : 4 * j]))
         for a, b, i, j in zip(offsets[first].tolist(), offsets[last + 1].tolist(), first.tolist(), (last + 1).tolist())),
        np.uint64, len(last))
    return counts, doc[last], first - bounds[doc[last]], last - first + 1, digests.view(np.int64)


def chunk_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document with its chunks: digests, and places (first word shifted by 32, number of words).

    ``row`` grows in stored order, and ``row`` plus a word's number is unique among all words.
    """
    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            counts, doc, first, size, digests = _cut(batch.column("text"))
            starts = row + np.concatenate([[0], np.cumsum(counts + 1)])
            row = int(starts[-1])
            ends = np.searchsorted(doc, np.arange(len(counts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(starts[:-1], pa.int64()), pa.array(counts, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(digests, pa.int64())),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array((first << 32) + size, pa.int64()))],
                ["doc_id", "row", "n_words", "digests", "places"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, _CHUNKS)


def _windows(batches, min_words: int):
    """Stretches of adjacent repeated chunks: from each chunk on, and up to each chunk, the shortest of ``min_words`` words."""
    for batch in batches:
        out = [[], [], [], []]
        chunks = batch.column("chunks")
        offsets, flat = chunks.offsets.to_numpy(), chunks.values
        fields = [flat.field(c).to_numpy() for c in ("lo", "hi", "digest")]
        for row, a, b in zip(batch.column("row").to_pylist(), offsets[:-1], offsets[1:]):
            lo, hi, digest = (f[a:b] for f in fields)
            run = np.concatenate([[0], np.cumsum(lo[1:] != hi[:-1])])
            places = np.arange(len(lo))
            last = np.searchsorted(hi, lo + min_words)
            first = np.searchsorted(lo, hi - min_words, side="right") - 1
            pairs = np.concatenate([np.stack([places, last], 1)[last < len(lo)], np.stack([first, places], 1)[first >= 0]])
            pairs = np.unique(pairs[run[pairs[:, 0]] == run[pairs[:, 1]]], axis=0)
            for i, j in pairs.tolist():
                mark = xxhash.xxh3_64_intdigest(digest[i : j + 1].tobytes())
                for values, value in zip(out, (row, lo[i], hi[j], mark - (1 << 64 if mark >> 63 else 0))):
                    values.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], ["row", "lo", "hi", "digest"])


def _joined(stretches: DataFrame) -> DataFrame:
    """``row``, ``lo`` and ``hi``: stretches of a row that overlap or touch, as one."""
    order = W.partitionBy("row").orderBy("lo", "hi")
    apart = F.coalesce(F.col("lo") > F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(True))
    joined = stretches.withColumn("apart", apart.cast("int")).withColumn(
        "passage", F.sum("apart").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return joined.groupBy("row", "passage").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, stage: Stage | None = None,
) -> DataFrame:
    """A row for each document that holds a repeated passage; documents without one are not listed.

    ``doc_id``, ``n_words``, ``repeated_words``, ``removed_words``, ``passages`` (first word:word after the last, comma-
    joined) and ``cuts``, the word ranges to remove: later copies of at least ``min_words`` words, in stored order. A copy may lie in the same text.
    Null, empty and blank texts hold no passage. Repeated rows are copies of each other; repeated and null ids are told
    apart by row. No rows give no rows. Other columns are not carried, so their names cannot clash.
    """
    stage = stage or Stage(docs.sparkSession)
    table = stage.table(chunk_table(docs, key, text), "chunks")
    found = table.select("row", F.explode(F.arrays_zip("digests", "places")).alias("c")).select(
        F.col("c.digests").alias("digest"), "row", F.col("c.places").alias("place"))
    first_word = F.shiftright("place", 32)
    counts = found.groupBy("digest").agg(F.count("*").alias("n"))
    twice = stage.table(counts.filter("n > 1").select("digest"), "repeated")
    copies = found.join(twice, "digest").select(
        "row", first_word.alias("lo"), (first_word + F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))).alias("hi"), "digest")

    # Chunks next to each other may each occur elsewhere by chance: only windows found twice as a whole count.
    by_row = copies.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("chunks"))
    windows = stage.table(by_row.mapInArrow(
        lambda batches: _windows(batches, min_words), "row long, lo long, hi long, digest long"), "windows")
    counts = windows.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.col("row") + F.col("lo")).alias("first"))
    twice = stage.table(counts.filter("n > 1").select("digest", "first"), "repeated-windows")
    repeats = stage.table(windows.join(twice, "digest").select(
        "row", "lo", "hi", (F.col("row") + F.col("lo") > F.col("first")).alias("again")), "repeats")
    passages, cuts = _joined(repeats), _joined(repeats.filter("again"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("lo", "hi"))), lambda p: F.concat_ws(":", p["lo"], p["hi"]))
    by_row = passages.groupBy("row").agg(
        F.sum(F.col("hi") - F.col("lo")).alias("repeated_words"), F.array_join(listed, ",").alias("passages"))
    cuts = cuts.groupBy("row").agg(
        F.sum(F.col("hi") - F.col("lo")).alias("removed"),
        F.sort_array(F.collect_list(F.struct(F.col("lo").alias("start"), F.col("hi").alias("end")))).alias("gone"))
    cut = F.coalesce("gone", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("cuts")
    return by_row.join(cuts, "row", "left").join(table.select("row", "doc_id", "n_words"), "row").select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "repeated_words",
        F.coalesce("removed", F.lit(0).cast("long")).alias("removed_words"), "passages", cut)
