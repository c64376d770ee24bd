"""Token counts through a digest cache.

The cache is a Parquet table of (digest of the normalised content, tokenizer version, count). Documents meet it by
digest; only distinct contents without a count are encoded, and their counts are appended. Digests and counts are all
that is shuffled for known contents.

Normalising must not change the count, so it is only what the tokenizer itself treats alike: a null text is empty.
"""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tallybook.llm.common import slices, strings, sums
from tallybook.operators.joins import fits_broadcast
from tallybook.staging import Stage

#: Bound of a model file, which is broadcast.
MODEL_BYTES = 64 << 20
LIMIT = 4096
#: Missing digests up to this number are looked up by broadcast, so a nearly warm cache shuffles no texts.
FEW = 100_000
CACHE = "digest string, version string, n_tokens long"


def model_bytes(path: str) -> tuple[bytes, str]:
    """The model file and its version, the digest of its content."""
    raw = Path(path).read_bytes()
    if len(raw) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return raw, hashlib.sha256(raw).hexdigest()


class Counter:
    """Counts pieces of texts, encoding each distinct word of a block once.

    Holds if no piece of the vocabulary has a blank after another character, and none is user-defined: pieces then never
    reach over the start of a word, so a text's pieces are its words' pieces. Texts with runs of blanks, blanks
    at an end, or the blank sign itself, and models without that property, are encoded whole.
    """

    def __init__(self, raw: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        pieces = range(self.model.get_piece_size())
        self.by_word = self.model.encode("a b", out_type=str) == ["▁a", "▁b"] and self.model.normalize("x") == "▁x"
        self.by_word &= not any(re.search("[^▁]▁", self.model.id_to_piece(i)) for i in pieces)

    def whole(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(len, self.model.encode(texts, num_threads=1)), np.int64, len(texts))

    def counts(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts), dtype=np.int64)
        odd = pc.match_substring_regex(texts, "^ | $|  |▁")
        plain = np.asarray(pc.and_(pc.invert(odd), pc.not_equal(texts, ""))) if self.by_word else np.zeros(len(texts), bool)
        if plain.any():
            lists = pc.split_pattern(texts.filter(pa.array(plain)), " ")
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
            words = lists.flatten().dictionary_encode()
            known = self.whole(strings(words.dictionary))
            out[plain] = sums(known[words.indices.to_numpy(zero_copy_only=False)], bounds.astype(np.int64))
        if not plain.all():
            out[~plain] = self.whole(strings(texts.filter(pa.array(~plain))))
        return out


def _read_cache(spark, cache: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def count_tokens(
    docs: DataFrame, model: str, cache: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT,
    stage: Stage | None = None,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row of ``docs``.

    ``cache`` is a folder every executor reaches; it is created, read and appended to. Two runs that append at once
    may both store a content; lookups take one count per digest. Null and empty texts have no bytes and no tokens.
    Texts are encoded whole. Repeated rows, repeated and null ids each give a row; no rows give no rows. Other columns
    are not carried, so their names cannot clash.
    """
    spark = docs.sparkSession
    raw, version = model_bytes(model)
    shipped = spark.sparkContext.broadcast(raw)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), content.alias("text")).select(
        "doc_id", "text", F.sha2("text", 256).alias("digest"))

    stored = _read_cache(spark, cache).filter(F.col("version") == version).select("digest", "n_tokens")
    missing = rows.select("digest").distinct().join(stored.select("digest"), "digest", "left_anti")

    def encode(batches):
        counter = Counter(shipped.value)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([version] * batch.num_rows, pa.string()),
                 pa.array(counter.counts(batch.column("text")), pa.int64())], ["digest", "version", "n_tokens"])

    if not stored.isEmpty():  # nothing is known yet: every content is a miss
        texts = rows.select("digest", "text")
        few = fits_broadcast(missing, FEW)
        texts = texts.join(F.broadcast(missing) if few else missing, "digest", "left_semi")
    else:
        texts = rows.select("digest", "text")
    # Copies fall away in the tasks that read them, before texts are shuffled.
    new = texts.dropDuplicates(["digest"]).select("digest", "text").mapInArrow(encode, CACHE)
    new.write.mode("append").parquet(cache)

    # Written, so that the join sees two plain shuffles and can split a content that many rows share.
    counted = (stage or Stage(spark)).table(
        _read_cache(spark, cache).filter(F.col("version") == version).groupBy("digest").agg(
            F.max("n_tokens").alias("n_tokens")), "counts")
    sized = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return sized.join(counted, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
