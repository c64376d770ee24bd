"""Arrow helpers shared by the operators: words, blocks of rows and packed integers."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession

#: A word as every operator counts it: anything between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a task works on at once; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def strings(array: pa.Array) -> list:
    """Values as Python objects; much faster than ``to_pylist``."""
    return array.to_numpy(zero_copy_only=False).tolist()


def filled(texts: pa.Array) -> pa.Array:
    """Null texts count as empty."""
    return pc.fill_null(texts, "")


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words of all texts in a row, and the number of words before each text (one more entry than texts)."""
    lists = pc.ascii_split_whitespace(filled(texts))
    flat = lists.flatten()
    real = np.asarray(pc.not_equal(flat, ""))
    before = np.concatenate([[0], np.cumsum(real)])
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    return before[bounds.astype(np.int64)], flat if real.all() else flat.filter(pa.array(real))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds; empty stretches give 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks and would hold it beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def slices(batches, column: str, limit: int = BLOCK_BYTES):
    """Record batches cut so that ``column`` holds at most ``limit`` bytes (a longer value stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])
        release()


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(3).compress(planes.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of several stretches, one after the other."""
    lengths = lengths.astype(np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts.astype(np.int64) - before, lengths)
