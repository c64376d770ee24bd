"""Passages occur elsewhere as a sequence, not only their chunks."""

import random

from llm.test_texts import WORDS
from tallybook.llm import chunks


def test_chance_repeats_are_no_passage(spark):
    rnd = random.Random(9)
    few = ["alpha", "be", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "la", "mu"]

    def text(n):
        return " ".join(rnd.choice(few) for _ in range(n))

    passage = text(60)
    rows = [(i, text(300)) for i in range(150)] + [(1000 + i, f"{text(50)} {passage} {text(50)}") for i in range(3)]
    got = chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    words, seen = {i: WORDS.findall(t) for i, t in rows}, {}
    for i, w in words.items():
        for k in range(len(w) - 19):
            seen.setdefault(tuple(w[k : k + 20]), []).append((i, k))
    covered = {(i, k + n) for places in seen.values() if len(places) > 1 for i, k in places for n in range(20)}
    assert {i for i, _ in covered} == {1000, 1001, 1002} == {r.doc_id for r in got}
    for r in got:
        found = [tuple(map(int, p.split(":"))) for p in r.passages.split(",")]
        assert all((r.doc_id, k) in covered for a, b in found for k in range(a, b))
        assert r.removed_words == sum(c.end - c.start for c in r.cuts) and (r.removed_words > 0) == (r.doc_id > 1000)
