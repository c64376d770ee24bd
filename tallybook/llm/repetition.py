"""Quality rules by repetition coverage.

A task works on blocks of whole texts. Words become numbers, and a polynomial rolling hash gives the hash of the
n-gram at every word from the hash of the (n-1)-gram there. An n-gram found twice in a text is duplicated; the
measure is the characters of words inside duplicated n-grams, each counted once, and inside lines that equal
an earlier line. Only words whose (n-1)-grams are duplicated can start a duplicated n-gram, so longer lengths look
at few words. The three-word windows of the base columns are compared exactly, not by hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import filled, slices, sums, words_of

MIN_WORDS = 50
#: Most percent of the characters of words that duplicated n-grams may hold, by n.
GRAM_PERCENT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Most percent of lines, and of characters of words, that repeat an earlier line.
LINE_PERCENT, LINE_CHAR_PERCENT = 30, 20
_WINDOW = 3
_BASE = np.uint64(0x9E3779B97F4A7C15)

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words",
           *[f"gram{n}_chars" for n in GRAM_PERCENT]]
SCHEMA = f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}"


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside an n-gram that begins at one of ``starts``."""
    change = np.zeros(words + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """One-to-one scrambling of 64-bit numbers."""
    x = numbers.astype(np.uint64) + _BASE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lines(texts: pa.Array) -> dict[str, np.ndarray]:
    lists = pc.split_pattern(texts, "\n")
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(int)
    lines = lists.flatten()
    word_bounds, words = words_of(lines)
    chars = sums(pc.utf8_length(words).to_numpy(zero_copy_only=False), word_bounds)
    real = np.diff(word_bounds) > 0
    number = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((number, doc))
    again = np.zeros(len(lines), dtype=bool)
    again[order[1:]] = (number[order][1:] == number[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    again &= real
    return {"n_lines": sums(real, bounds), "n_dup_lines": sums(again, bounds), "dup_line_chars": sums(chars * again, bounds)}


def _measure(column: pa.Array) -> dict[str, np.ndarray]:
    texts = filled(column)
    bounds, words = words_of(texts)
    counts = np.diff(bounds)
    n = len(words)
    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if n else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    room = bounds[1:][doc] - np.arange(n)  # words from here to the end of the text

    # Exact: a pair of words is numbered, then the pair and the third word, within the text.
    at = np.flatnonzero(room >= _WINDOW)
    size = n + 1
    _, pair = np.unique(code[at] * size + code[at + 1], return_inverse=True)
    _, triple = np.unique(pair * size + code[at + 2], return_inverse=True)
    at = at[_repeated(triple * np.int64(len(counts)) + doc[at])]
    out = {"n_words": counts, "word_chars": sums(chars, bounds),
           "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False), **_lines(texts),
           "n_repeat_words": sums(_covered(at, _WINDOW, n), bounds)}

    letters = _mixed(code)
    rolling = np.zeros(n, dtype=np.uint64)
    for k in range(_WINDOW):
        rolling[at] = rolling[at] * _BASE + letters[at + k]
    for length in range(_WINDOW + 1, max(GRAM_PERCENT) + 1):
        starts = np.zeros(n + 1, dtype=bool)
        starts[at] = True
        at = at[(room[at] >= length) & starts[at + 1]]
        rolling[at] = rolling[at] * _BASE + letters[at + length - 1]
        at = at[_repeated(_mixed(rolling[at] ^ _mixed(doc[at])))]
        if length in GRAM_PERCENT:
            out[f"gram{length}_chars"] = sums(chars * _covered(at, length, n), bounds)
    return out


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of every text, a row for each input row. Null texts are empty and count 0 everywhere."""
    def run(batches):
        for batch in slices(batches, "text"):
            out = _measure(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(out[c], pa.int64()) for c in _COUNTS]], ["doc_id", *_COUNTS])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def repetitive():
    """The method's verdict: too many characters in duplicated n-grams or lines."""
    bad = (100 * F.col("n_dup_lines") > LINE_PERCENT * F.col("n_lines")) | (
        100 * F.col("dup_line_chars") > LINE_CHAR_PERCENT * F.col("word_chars"))
    for n, percent in GRAM_PERCENT.items():
        bad = bad | (100 * F.col(f"gram{n}_chars") > percent * F.col("word_chars"))
    return bad


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept``.

    A null, empty or blank text has no words and fails the base rule. Repeated rows and null or repeated ids are judged
    row by row; long texts are measured whole. No rows give no rows. Other columns are not carried, so their names cannot clash.
    """
    judged = measures(docs, key, text).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & ~repetitive())


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are.

    The text is judged in the task that holds it, so nothing is shuffled or joined.
    """
    def run(batches):
        for batch in slices(batches, text):
            out = _measure(batch.column(text))
            yield batch.filter(pa.array(_passes(out)))

    return docs.mapInArrow(run, docs.schema)


def _passes(out: dict[str, np.ndarray]) -> np.ndarray:
    """The rules of ``judge`` on counts."""
    good = (out["n_words"] >= MIN_WORDS) & (100 * out["n_repeat_words"] <= 50 * out["n_words"])
    good &= (100 * out["n_dup_lines"] <= LINE_PERCENT * out["n_lines"])
    good &= (100 * out["dup_line_chars"] <= LINE_CHAR_PERCENT * out["word_chars"])
    for n, percent in GRAM_PERCENT.items():
        good &= 100 * out[f"gram{n}_chars"] <= percent * out["word_chars"]
    return good
