"""Document fingerprints: quartile digests of hashed byte triplets.

Every five bytes in a row give six triplets; each is hashed to one of ``BUCKETS`` counters. A fingerprint holds, as lowercase
hex, the length of the text on a logarithmic scale (a byte) and for each counter the quartile it lies in among all counters
(two bits). Two fingerprints differ by a bounded score, the summed distances of the quartiles and the lengths; likeness is 1 for
equal ones and falls to 0 at the score that unrelated quartiles reach on average.

``edited`` pairs each document with the next one in descending order of ids. Documents are range-partitioned once, so that the
next document is the next row; only the first and last row of each part are written and joined.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import filled, slices, strings
from tallybook.operators.ordering import ranged
from tallybook.staging import Stage, stage_of

BUCKETS = 256
#: Places of the triplets within five bytes, and the odd factors of their hash.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
SPAN = 5
#: Bytes hashed at once.
CHUNK = 1 << 20
#: Steps of the length for each doubling; lengths differ by one for each step, ``LENGTH_MOST`` at most.
LENGTH_STEPS, LENGTH_MOST = 4, 24
#: A quartile apart counts 1, two 2, three 6.
APART = np.array([0, 1, 2, 6])
#: Average score of independent quartiles: a quarter is equal, three eighths are 1 apart, a quarter 2, an eighth 3.
UNRELATED = BUCKETS * (3 * 1 + 2 * 2 + 1 * 6) / 8

_FOUND = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counters of each text; ``bounds`` are the byte places where texts begin, and the end."""
    n = len(bounds) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    for start in range(int(bounds[0]), int(bounds[-1]), CHUNK):
        stop = min(start + CHUNK, int(bounds[-1]))
        window = data[start:min(stop + SPAN - 1, int(bounds[-1]))].astype(np.uint32)
        place = np.arange(start, stop)
        text = np.searchsorted(bounds, place, "right") - 1
        left = bounds[text + 1] - place
        for i, triplet in enumerate(TRIPLETS):
            length = max(0, len(window) - triplet[-1])
            length = min(length, stop - start)
            mixed = np.full(length, i * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
            for at, factor in zip(triplet, FACTORS):
                mixed = (mixed ^ window[at:at + length]) * np.uint32(factor)
                mixed ^= mixed >> np.uint32(15)
            inside = left[:length] > triplet[-1]
            cell = text[:length][inside] * BUCKETS + (mixed[inside] >> np.uint32(24)).astype(np.int64)
            counts += np.bincount(cell, minlength=n * BUCKETS)
    return counts.reshape(n, BUCKETS)


def digests(texts: pa.Array) -> np.ndarray:
    """One row of bytes a text: its length step, then the quartile of each counter."""
    texts = filled(texts).cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    counts = _counts(data, bounds)
    edges = np.sort(counts, axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, :, None] > edges[:, None, :]).sum(axis=2)
    steps = np.floor(LENGTH_STEPS * np.log2(np.diff(bounds) + 1))
    return np.column_stack([np.minimum(steps, 255), codes]).astype(np.uint8)


def fingerprints(rows: np.ndarray) -> list[str]:
    four = rows[:, 1:].reshape(len(rows), BUCKETS // 4, 4)
    packed = four[:, :, 0] | four[:, :, 1] << 2 | four[:, :, 2] << 4 | four[:, :, 3] << 6
    return [b.tobytes().hex() for b in np.column_stack([rows[:, :1], packed]).astype(np.uint8)]


def parsed(marks: list[str]) -> np.ndarray:
    """The digests that fingerprints stand for."""
    raw = np.frombuffer(bytes.fromhex("".join(marks)), np.uint8).reshape(len(marks), -1)
    codes = np.stack([raw[:, 1:] >> s & 3 for s in (0, 2, 4, 6)], axis=2).reshape(len(marks), -1)
    return np.column_stack([raw[:, :1], codes])


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 for unrelated ones, row by row."""
    apart = np.abs(left.astype(np.int64) - right)
    score = APART[apart[:, 1:]].sum(axis=1) + np.minimum(apart[:, 0], LENGTH_MOST)
    return 1 - np.minimum(score, UNRELATED) / UNRELATED


def _compared(ids: pa.Array, texts: list[str], own: np.ndarray, after: list[str], following: np.ndarray) -> list:
    """Columns of ``_FOUND`` for texts and the documents after them."""
    edits = [t[:len(t) - len(t) // 3] + a[:len(t) // 3] for t, a in zip(texts, after)]
    coded = pa.array([e.encode() for e in edits], pa.large_binary())
    changed = digests(coded)
    return [ids, pa.array(map(len, texts), pa.int64()),
            pa.array([hashlib.sha256(e.as_buffer()).hexdigest() for e in coded], pa.string()),
            pa.array(fingerprints(own), pa.string()), pa.array(fingerprints(changed), pa.string()),
            pa.array(likeness(own, changed)), pa.array(likeness(own, following))]


def _in_order(batches):
    """Rows of a part against the row after each; the first and last row as they are (``edge`` 0 and 1)."""
    part = TaskContext.get().partitionId()
    names = [*(c.split()[0] for c in _FOUND.split(", ")), "edge", "part", "text"]

    def edge(which, ids, text):
        empty = [pa.nulls(1, t) for t in (pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)]
        return pa.RecordBatch.from_arrays(
            [ids, *empty, pa.array([which], pa.int32()), pa.array([part], pa.int32()), pa.array([text], pa.string())], names)

    waiting = None
    for batch in slices(batches, "text"):
        ids, texts, rows = batch.column("doc_id"), strings(filled(batch.column("text"))), digests(batch.column("text"))
        if waiting is None:
            yield edge(0, ids[:1], texts[0])
        else:
            ids, texts = pa.concat_arrays([waiting[0], ids]), [waiting[1], *texts]
            rows = np.concatenate([waiting[2], rows])
        found = _compared(ids[:-1], texts[:-1], rows[:-1], texts[1:], rows[1:])
        n = len(texts) - 1
        yield pa.RecordBatch.from_arrays(
            [*found, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], names)
        waiting = ids[-1:], texts[-1], rows[-1:]
    if waiting is not None:
        yield edge(1, *waiting[:2])


def _pairs(batches):
    names = [c.split()[0] for c in _FOUND.split(", ")]
    for batch in slices(batches, "text"):
        sides = [batch.column("text"), batch.column("after")]
        (texts, after), (own, following) = (strings(s) for s in sides), (digests(s) for s in sides)
        yield pa.RecordBatch.from_arrays(_compared(batch.column("doc_id"), texts, own, after, following), names)


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document; a map without a shuffle. Null texts count as empty."""
    def run(batches):
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fingerprints(digests(batch.column("text"))), pa.string())],
                ["doc_id", "fingerprint"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text", stage: Stage | None = None) -> DataFrame:
    """Fingerprint of each text and of its edit: the last third replaced by as much of the next document's beginning.

    Next means the next smaller id, null ids last, and after the last document the first. Documents that share an id follow one
    another by a digest of their texts; equal ones in any order, which changes nothing. Null texts count as empty: no characters,
    a fingerprint of zeros, an edit that stays empty. A single document is its own next one. Texts of any length are read whole, a
    megabyte at a time. No documents give no rows; other columns do not matter, whatever their names.
    """
    stage = stage_of(docs, stage)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("mark"), F.col("place")]
    placed = ranged(rows, order).sortWithinPartitions(*order).select("doc_id", "text")
    found = stage.table(placed.mapInArrow(_in_order, f"{_FOUND}, edge int, part int, text string"), "in-order")
    edges = found.filter("edge is not null").select("doc_id", "edge", "part", "text")
    parts = sorted(r[0] for r in edges.select("part").distinct().collect())  # one number a part
    after = docs.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]])), "part int, next int")
    last = edges.filter("edge = 1").join(F.broadcast(after), "part")
    first = edges.filter("edge = 0").select(F.col("part").alias("next"), F.col("text").alias("after"))
    ends = last.join(first, "next").select("doc_id", "text", "after").mapInArrow(_pairs, _FOUND)
    return found.filter("edge is null").select(*ends.columns).unionAll(ends)
