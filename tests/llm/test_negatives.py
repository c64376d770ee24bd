"""Hard negatives against a plain version."""

import duckdb
import numpy as np
import parity
import pytest
from pyspark.sql import functions as F
from tallybook.llm import checks, negatives, registry

SCHEMA = "vec_id long, embedding array<double>, label int, rank string"


def odd_rows():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).round(1).tolist(), int(i % 3), "x") for i in range(160)]
    rows += [(i, rows[10][1], 1, "x") for i in range(200, 260)]  # a group of copies, ties among them
    rows += [(100, rows[10][1], 1, "x"), (100, rows[10][1], 1, "x"), (None, rows[10][1], 0, "x"), (None, rows[11][1], 1, "x")]
    rows += [(300, None, 1, "x"), (350, [1.0, None], 1, "x"), (400, [float("nan")] * 8, 1, "x"), (450, rows[3][1], None, "x"),
             (500, [float("inf")] * 8, 1, "x"), (550, [], 1, "x"), (551, [], 1, "x"), (552, [], 2, "x"), (600, [1.0, 2.0], 1, "x"),
             (601, [1.0, 1.9], 1, "x"), (603, [0.9, 1.5], 2, "x"), (650, [-1.0] * 8, 7, "x"), (651, [1.0] * 8, 7, "x")]
    return rows


def brute(rows):
    good = [(k, [int(np.floor(256 * x)) for x in v], (lab + 1) % 10 if k is not None and k % 7 == 0 else lab)
            for k, v, lab, _ in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, (k, v, lab) in enumerate(good):
        if k is None or k % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), o, m == lab) for j, (o, w, m) in enumerate(good) if j != i and len(w) == len(v)]
        for ps, pk, _ in sorted((s for s in scored if s[2]), key=order)[:5]:
            fits = sorted((s for s in scored if not s[2] and 50 * ps <= 100 * s[0] <= 95 * ps), key=order)[:3]
            out += [(k, pk, n + 1, nk, ps, ns) for n, (ns, nk, _) in enumerate(fits)]
    return out


@pytest.mark.parametrize("block,chunk", [(1 << 24, 256), (64, 3)])
def test_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(negatives, "BLOCK_VALUES", block)
    monkeypatch.setattr(negatives, "ANCHORS", chunk)
    monkeypatch.setattr(negatives, "ROWS", chunk * 8)
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    moved = df.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    got = sorted(map(tuple, negatives.mine(moved, F.col("vec_id") % 50 == 0).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr) and len(got) > 20
    assert negatives.mine(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_exact_products():
    rng = np.random.default_rng(3)
    for size, most in ((1, 2**20), (64, 300), (3000, 90_000), (5, 80_000_000)):
        a, b = (rng.integers(-most, most, (n, size)) for n in (7, 11))
        primes = negatives.primes_for(size * most * most)
        got = negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes)
        assert got.tolist() == (a.astype(object) @ b.astype(object).T).tolist()
    assert negatives.primes_for(70_000) == [251, 241, 239] and negatives.primes_for(10) == [251]


def test_sql(spark, tiny, data):
    for folder in (tiny, data):
        df = registry.op11_hard_negatives(spark, folder)
        assert not parity.differences(df, parity.connect(folder), checks.hard_negatives())
    assert duckdb  # the engine behind parity
