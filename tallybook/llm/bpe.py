"""BPE encoding and decoding over a table of distinct words.

Tasks split texts at ASCII blanks and number the distinct words of a block of documents, so a block
sends each of its words once, however often it occurs. The words meet by hash; there each distinct word
of the corpus is encoded once, and its ids go back to the blocks under the word's place. A block then
replaces every position by the ids of its word. Decoding joins ids to the pieces of the vocabulary.

A hot word costs one line per block of documents, a hot document only its own block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import packed, ranges, release, slices, strings, sums, unpacked, words_of

#: Bound of a tokenizer file, which is broadcast.
TOKENIZER_BYTES = 64 << 20
#: Text bytes that share one list of distinct words.
DICTIONARY_BYTES = 4 << 20
#: Distinct words that go to the tokenizer together; its results take about a hundred bytes an id until they are packed.
WORDS_AT_ONCE = 20_000
_BLOCK = ["block", "check"]


def tokenizer_text(path: str) -> str:
    """The tokenizer file, if its tokens never span white space, so that words can be encoded alone."""
    text = Path(path).read_text(encoding="utf-8")
    if len(text) > TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than {TOKENIZER_BYTES} bytes")
    spec = json.loads(text)
    steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
    before = spec["normalizer"].get("normalizers", [spec["normalizer"]])
    splits = steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
    known = all(
        n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"}
        for n in before)
    if not (splits and known and "byte" not in str(spec.get("decoder") or "")):
        raise ValueError(f"{path} may join characters across white space; words cannot be encoded alone")
    return text


def _tokenizer(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(text)
    made.no_padding()
    made.no_truncation()
    return made


def _part_of(words: pa.Array, parts: int) -> np.ndarray:
    """Part of each word, from its bytes alone (order does not matter for spreading)."""
    data = words.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset : data.offset + len(data) + 1]
    raw = np.frombuffer(data.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    weights = np.random.default_rng(7).integers(1, 1 << 40, 256, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(weights[raw])])
    at = offsets - offsets[0]
    mixed = (total[at[1:]] - total[at[:-1]]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)


def _blocks(batches, text: str, parts: int):
    """Per block: its key, documents, words per document, code of every word, words and their parts by code."""
    first = TaskContext.get().partitionId() << 32
    for n, batch in enumerate(slices(batches, text, DICTIONARY_BYTES)):
        bounds, words = words_of(batch.column(text))
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        part = _part_of(distinct, parts) if len(distinct) else np.zeros(0, np.int32)
        order = pc.sort_indices(
            pa.table({"p": part, "w": distinct}), [("p", "ascending"), ("w", "ascending")]).to_numpy()
        code = np.empty(len(order), dtype=np.uint32)
        code[order] = np.arange(len(order), dtype=np.uint32)
        codes = code[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint32)
        # Rows that came in another order on a second reading give another key, so they never meet.
        key = first + n, xxhash.xxh64_intdigest(codes.tobytes(), seed=len(order)) >> 1
        yield key, batch, np.diff(bounds), codes, distinct.take(pa.array(order)), part[order]


def _ends_word(model) -> np.ndarray:
    vocabulary = model.get_vocab(with_added_tokens=True)
    ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
    return ends


#: Words of these letters, digits and signs are split and lower-cased here as the library does it; the range
#: leaves out apostrophes (contractions), "<|" (special tokens) and whatever Unicode composition may change.
_PLAIN = re.compile(r"(?!.*<\|)[!-&(-~\xC0-\u012F\u0131-\u0148\u014A-\u017E]+").fullmatch
_PIECES = re.compile(r"[^\W\d_]+|[0-9]|(?:[^\w]|_)+").findall


def _encode(model, ends_word: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each word, and all ids. What two words share ("the" in "The," and "the.") is encoded once."""
    plain = [i for i, w in enumerate(words) if _PLAIN(w)]
    split = [_PIECES(words[i].lower()) for i in plain]
    distinct = list(dict.fromkeys(p for pieces in split for p in pieces))
    texts = [" ".join(distinct[i : i + 500]) for i in range(0, len(distinct), 500)]
    found = [np.array(e.ids, dtype=np.uint32) for e in model.encode_batch(texts, add_special_tokens=False)]
    flat = np.concatenate(found or [np.zeros(0, np.uint32)])
    ends = np.flatnonzero(ends_word[flat]) + 1
    if len(ends) != len(distinct):
        raise RuntimeError("pieces of words and ends of words differ in number")
    sizes = np.diff(ends, prepend=0)
    place = dict(zip(distinct, range(len(distinct))))
    at = np.fromiter((place[p] for pieces in split for p in pieces), np.int64)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))])
    lengths = np.zeros(len(words), np.int64)
    lengths[plain] = sums(sizes[at], bounds)

    others = sorted(set(range(len(words))).difference(plain))
    coded = [e.ids for e in model.encode_batch([words[i] for i in others], add_special_tokens=False)]
    lengths[others] = list(map(len, coded))
    ids = np.empty(int(lengths.sum()), dtype=np.uint32)
    starts = np.cumsum(lengths) - lengths
    ids[ranges(starts[plain], lengths[plain])] = flat[ranges(ends[at] - sizes[at], sizes[at])]
    if others:
        ids[ranges(starts[others], lengths[others])] = np.concatenate([np.array(c, dtype=np.uint32) for c in coded])
    return lengths, ids


def encode(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", derive=None,
) -> DataFrame:
    """Token ids and decoded text of every row: ``doc_id``, ``ids`` array<int>, ``decoded`` string.

    ``derive``, a schema and a function of one document's ids and decoded text, replaces these two columns by
    values computed where the ids are, so that long lists need not travel.

    ``docs`` must be a stored table: it is read twice and must give its rows in the same order (each block
    checks this). Null texts are empty and give no ids. Rows keep their number: repeated ids, repeated
    rows and null keys each give a row. Other columns are not carried, so their names cannot clash. Special
    tokens inside a text are recognised as the tokenizers library does by default. Texts of any length
    are encoded whole. An empty table gives an empty result. ``decoded`` is
    what the library's decode(ids, skip_special_tokens=False) gives without a decoder: pieces joined by blanks.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(tokenizer_text(tokenizer))
    # More parts than tasks, so that parts spread evenly over tasks.
    parts = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def word_rows(batches):
        pack = zstandard.ZstdCompressor(3)
        for (block, check), _, _, _, words, part in _blocks(batches, "text", parts):
            ends = np.searchsorted(part, np.arange(parts), side="right")
            starts = np.concatenate([[0], ends[:-1]])
            used = np.flatnonzero(ends > starts)
            listed = strings(words)
            blobs = [pack.compress("\n".join(listed[starts[p] : ends[p]]).encode()) for p in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(used), pa.int64()), pa.array([check] * len(used), pa.int64()),
                 pa.array(used, pa.int32()), pa.array(blobs, pa.binary())],
                [*_BLOCK, "part", "words"])

    def document_rows(batches):
        for (block, check), batch, sizes, codes, _, _ in _blocks(batches, "text", parts):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([check], pa.int64()),
                 pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int32())), pa.array([packed(codes)], pa.binary())],
                [*_BLOCK, "ids", "sizes", "codes"])

    def encode_words(batches):
        model = _tokenizer(spec.value)
        ends_word = _ends_word(model)
        unpack = zstandard.ZstdDecompressor()

        def listed(blob):
            return unpack.decompress(blob).decode().split("\n")

        # Rows come sorted by part; what is held is one part's distinct words and their ids.
        current, place, lengths, ids = None, {}, np.zeros(0, np.int64), np.zeros(0, np.uint32)
        for batch in batches:
            part = batch.column("part").to_numpy()
            sizes, codes = [], []
            for run in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
                if part[run[0]] != current:
                    current, place, lengths, ids = part[run[0]], {}, lengths[:0], ids[:0]
                blobs = batch.column("words").slice(run[0], len(run))
                known = len(place)
                for blob in blobs:
                    for word in listed(blob.as_py()):
                        place.setdefault(word, len(place))
                new = list(islice(place, known, None))
                made = [_encode(model, ends_word, new[i : i + WORDS_AT_ONCE]) for i in range(0, len(new), WORDS_AT_ONCE)]
                lengths = np.concatenate([lengths, *(m[0] for m in made)])
                ids = np.concatenate([ids, *(m[1] for m in made)])
                starts = np.cumsum(lengths) - lengths
                for blob in blobs:
                    words = listed(blob.as_py())
                    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                    sizes.append(packed(lengths[at]))
                    codes.append(packed(ids[ranges(starts[at], lengths[at])]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("check"), batch.column("part"),
                 pa.array(sizes, pa.binary()), pa.array(codes, pa.binary())],
                [*_BLOCK, "part", "word_sizes", "word_ids"])
            release()

    words = rows.mapInArrow(word_rows, "block long, check long, part int, words binary")
    encoded = words.repartition("part").sortWithinPartitions("part").mapInArrow(
        encode_words, "block long, check long, part int, word_sizes binary, word_ids binary")
    # One line per part and block, so a list is bounded by the distinct words of one block.
    answers = encoded.groupBy(*_BLOCK).agg(
        F.sort_array(F.collect_list(F.struct("part", "word_sizes", "word_ids"))).alias("answers"))
    blocks = rows.mapInArrow(
        document_rows, "block long, check long, ids array<long>, sizes array<int>, codes binary")
    joined = blocks.join(answers, _BLOCK, "left").select("ids", "sizes", "codes", "answers")
    pieces = id_to_piece(docs, spec.value)

    def assemble(batches):
        table = pieces.value
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at] for n in batch.schema.names}
                answers = row["answers"].as_py() or []
                lengths = np.concatenate([unpacked(a["word_sizes"]) for a in answers] or [np.zeros(0, np.uint32)])
                ids = np.concatenate([unpacked(a["word_ids"]) for a in answers] or [np.zeros(0, np.uint32)])
                codes = unpacked(row["codes"].as_py())
                if len(codes) and codes.max() >= len(lengths):
                    raise RuntimeError("the rows of docs came in another order when read again; store docs first")
                lengths = lengths.astype(np.int64)
                starts = np.cumsum(lengths) - lengths
                per_word = lengths[codes]
                all_ids = ids[ranges(starts[codes], per_word)].astype(np.int32)
                bounds = np.concatenate([[0], np.cumsum(row["sizes"].values.to_numpy())]).astype(np.int64)
                token_bounds = np.concatenate([[0], np.cumsum(per_word)])[bounds]
                yield from _documents(row["ids"].values, all_ids, token_bounds, table, derive and derive[1])
            release()

    return joined.mapInArrow(assemble, f"doc_id long, {derive[0] if derive else 'ids array<int>, decoded string'}")


def id_to_piece(docs: DataFrame, spec: str):
    """The id-to-piece side of the decode join: one entry per vocabulary item, so bounded by the file."""
    vocabulary = _tokenizer(spec).get_vocab(with_added_tokens=True)
    pieces = np.full(max(vocabulary.values()) + 1, "", dtype=object)
    for piece, i in vocabulary.items():
        pieces[i] = piece
    return docs.sparkSession.sparkContext.broadcast(pieces)


def _documents(keys: pa.Array, ids: np.ndarray, bounds: np.ndarray, pieces: np.ndarray, derive, step: int = 500):
    for lo in range(0, len(keys), step):
        hi = min(lo + step, len(keys))
        own = bounds[lo : hi + 1]
        texts = [" ".join(pieces[ids[a:b]].tolist()) for a, b in zip(own[:-1], own[1:])]
        if derive:
            made = [derive(ids[a:b], t) for a, b, t in zip(own[:-1], own[1:], texts)]
            columns = {n: pa.array([m[n] for m in made]) for n in made[0]}
        else:
            lists = pa.ListArray.from_arrays(
                pa.array(own - own[0], pa.int32()), pa.array(ids[own[0] : own[-1]], pa.int32()))
            columns = {"ids": lists, "decoded": pa.array(texts, pa.string())}
        yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), *columns.values()], ["doc_id", *columns])


def decode(tokens: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Decoded text of rows of ids, joined to the pieces by id: ``doc_id``, ``decoded``.

    A null list decodes to an empty text; an id outside the vocabulary or a null id gives no piece, as in the library.
    """
    pieces = id_to_piece(tokens, tokenizer_text(tokenizer))

    def run(batches):
        table = pieces.value
        for batch in batches:
            texts = [" ".join(table[i] for i in row or [] if i is not None and 0 <= i < len(table) and table[i])
                     for row in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    rows = tokens.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded string")


def digests():
    """``derive`` for the digest columns of the op5 query."""
    decimal = np.array([str(i) for i in range(1 << 16)], dtype=object)

    def one(ids: np.ndarray, decoded: str) -> dict:
        texts = decimal[ids].tolist() if len(ids) and ids.max() < len(decimal) else map(str, ids.tolist())
        return {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(" ".join(texts).encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest()}

    return "n_tokens long, ids_sha256 string, decoded_sha256 string", one
