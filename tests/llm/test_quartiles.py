"""Fingerprints against plain versions."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm.conftest import ordered
from pyspark.sql import functions as F
from tallybook.llm import quartiles, registry


def plain_digest(text):
    data = text.encode()
    counts = Counter()
    for at in range(len(data)):
        for i, triplet in enumerate(quartiles.TRIPLETS):
            if at + triplet[-1] < len(data):
                mixed = i * 0x27D4EB2F & 0xFFFFFFFF
                for step, factor in zip(triplet, quartiles.FACTORS):
                    mixed = (mixed ^ data[at + step]) * factor & 0xFFFFFFFF
                    mixed ^= mixed >> 15
                counts[mixed >> 24] += 1
    values = [counts[b] for b in range(256)]
    q1, q2, q3 = (sorted(values)[i] for i in (63, 127, 191))
    codes = [(v > q1) + (v > q2) + (v > q3) for v in values]
    step = min(255, int(np.floor(4 * np.log2(len(data) + 1))))
    packed = [sum(codes[4 * i + j] << 2 * j for j in range(4)) for i in range(64)]
    return bytes([step, *packed]).hex(), step, codes


def plain_likeness(a, b):
    score = sum((0, 1, 2, 6)[abs(x - y)] for x, y in zip(a[2], b[2])) + min(24, abs(a[1] - b[1]))
    return 1 - min(score, 416) / 416


def plain(rows):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 3
        edit = text[:len(text) - n] + after[:n]
        a, b, c = map(plain_digest, (text, edit, after))
        out.append((key, len(text), hashlib.sha256(edit.encode()).hexdigest(), a[0], b[0], plain_likeness(a, b), plain_likeness(a, c)))
    return sorted(out, key=repr)


def test_brute_force(many_parts):
    texts = ["", None, "a", "abcd", "é" * 7, "\U0001f600 x" * 50, "same text " * 20, "same text " * 20, "z" * 3000]
    rows = [(i * 3 % 11, t) for i, t in enumerate(texts)] + [(None, "no id here")]
    for n in (len(rows), 1, 2):
        df = many_parts.createDataFrame([(*r, 1, "x") for r in rows[:n]], "doc_id long, text string, n_chars int, part string")
        assert ordered(quartiles.edited(df)) == plain(rows[:n])
        assert quartiles.edited(df.limit(0)).count() == 0


def test_ties(many_parts):
    """A third of all rows with one id: the order of the texts is settled, equal rows may change places."""
    rows = [(5, f"text {i % 4}") for i in range(40)] + [(i + 10, f"other {i}" * 9) for i in range(80)] + [(None, None)] * 5
    df = many_parts.createDataFrame(rows, "doc_id long, text string")
    first = ordered(quartiles.edited(df))
    assert len(first) == len(rows) and first == ordered(quartiles.edited(df.repartition(5)))


def test_whole_texts(spark, odd, documents):
    """Chunks change nothing, and every document of the table gets its own and its successor's text."""
    long = "".join(f"word{i} " for i in range(20_000))
    whole = quartiles.digests(pa.array([long, "short", None]))
    size, quartiles.CHUNK = quartiles.CHUNK, 1000
    try:
        assert (quartiles.digests(pa.array([long, "short", None])) == whole).all()
    finally:
        quartiles.CHUNK = size
    assert (quartiles.parsed(quartiles.fingerprints(whole)) == whole).all()
    assert quartiles.fingerprints(whole)[1] == plain_digest("short")[0]
    assert quartiles.edited(odd).count() == odd.count()
    found = quartiles.edited(documents)
    rows = sorted(documents.select("doc_id", "text").collect(), key=lambda r: -r[0])
    edits = {r[0]: hashlib.sha256(((r[1] or "")[:len(r[1] or "") - len(r[1] or "") // 3] + (a[1] or "")[:len(r[1] or "") // 3])
             .encode()).hexdigest() for r, a in zip(rows, rows[1:] + rows[:1])}
    assert {r.doc_id: r.edited_sha256 for r in found.collect()} == edits
    own = {r.doc_id: r.fingerprint for r in quartiles.fingerprinted(documents).collect()}
    assert {r.doc_id: r.fingerprint for r in found.collect()} == own


def test_edits_are_nearer_than_others(spark, data):
    found = registry.op12_fingerprints(spark, data).filter(F.col("n_chars") > 200)
    right = found.selectExpr("avg(int(near_edited > near_next)) a", "avg(near_edited) e", "avg(near_next) n").first()
    assert right.a > 0.97 and right.e - right.n > 0.3
