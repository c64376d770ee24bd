"""URL filter, chat, vectors, components and the pipeline."""

import random

import corpus_pipeline
import duckdb
import numpy as np
import parity
import pytest
from llm.conftest import ordered
from pyspark.sql import functions as F
from tallybook.llm import chat, checks, components, mixing, pq, registry, repetition, urls
from tallybook.staging import Stage

URLS = [None, "", "no scheme", "http://EXAMPLE.org/en/1x?q#f", "https://a.b.example.org/es/", "http://example.org/es", "x://org",
        "http://com/de/a", "http://a.com/fr/../", "http://a.com?/fr/", "http://xcom/de/", "http://a.org:80/es/", "://b.org/es/#", "a://b://c"]


def longest(host, path):
    fits = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]), len(r[1])), default=None)
    return (best[0] + best[1], best[2]) if best else (None, "allow")


def test_urls(spark, data):
    odd = spark.createDataFrame([(i % 5 or None, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    for pages in (odd, odd.limit(0), spark.read.parquet(f"{data}/pages.parquet")):
        want = [(r.page_id, *urls.split_url(r.url), *longest(*urls.split_url(r.url))) for r in pages.collect()]
        assert ordered(urls.judge_urls(pages)) == sorted(want, key=repr)
        rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
        assert ordered(urls.judge_urls(pages, rules)) == sorted(want, key=repr)
        assert ordered(urls.judge_by_join(pages.select("page_id", "url"), rules)) == sorted(want, key=repr)


def test_chat(spark, data):
    turns = spark.read.parquet(f"{data}/conversations.parquet")
    model = chat.train(turns.filter("conv_id % 5 <> 0"))
    held = turns.filter("conv_id % 5 = 0")
    found = chat.format_chat(held.drop("role"), model)
    right = found.join(held.select("conv_id", "turn", F.col("role").alias("given")), ["conv_id", "turn"])
    assert right.selectExpr("avg(int(role = given))").first()[0] > 0.9 and found.count() == held.count()
    odd = spark.createDataFrame(
        [(1, 0, "System: be nice"), (1, 1, "User: hello?"), (1, 2, "Assistant: hi"), (1, 2, "Assistant: hi"), (None, None, None),
         (2, 0, "### Human: x"), (2, 1, "AI: y"), (3, None, ""), (4, 0, "a b " * 50_000)], "conv_id long, turn long, text string")
    rows = chat.format_chat(odd, model).collect()
    roles = {(r.conv_id, r.turn): r.role for r in rows}
    assert len(rows) == 9 and roles[1, 0] == "system" and roles[1, 1] == "user" and roles[1, 2] == "assistant"
    assert (roles[2, 0], roles[2, 1]) == ("user", "assistant")
    assert {r.rendered for r in rows if r.conv_id == 1 and r.turn == 2} == {"<|assistant|>\nhi\n<|end|>"}
    assert chat.format_chat(odd.limit(0), model).count() == 0


def test_viterbi_segments(spark, data):
    """Cutting a long conversation loses nothing: the paths score alike, and as well as the best of all paths."""
    turns = spark.read.parquet(f"{data}/conversations.parquet")
    model = chat.train(turns)
    one = turns.withColumn("turn", F.col("turn") + 10 * F.col("conv_id")).withColumn("conv_id", F.lit(1).cast("long"))

    def score(segment):
        steps = sorted(chat.roles(one, model, segment=segment).collect(), key=lambda r: (r["at"], r["symbol"]))
        at = [chat.ROLES.index(r["role"]) for r in steps]
        total = model.start[at[0]] + sum(model.step[a][b] for a, b in zip(at, at[1:]))
        return total + sum(chat._seen(model, r["symbol"])[i] for r, i in zip(steps, at))

    scores = [score(s) for s in (1 << 20, 64, 7)]
    assert max(scores) - min(scores) < 1e-6


def test_vectors(spark, data):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(120, 16))
    near = [base[i % 120] + rnd.normal(size=16) * 0.05 * (i % 7) for i in range(600)]
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *near])]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0, None] + [0.0] * 14), (904, [1.0]), (None, rows[3][1]),
             (905, rows[3][1]), (905, rows[3][1]), (906, [1e200 * x for x in rows[3][1]])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n_links int")
    good = [k for k, (_, v) in enumerate(rows) if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([rows[k][1] for k in good])
    x /= np.abs(x).max(1)[:, None]
    x /= np.sqrt((x**2).sum(1))[:, None]
    links = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    label = np.arange(len(x))
    while True:
        new = np.array([min(label[i], label[links[i]].min(initial=label[i])) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    least = {}
    for k, g in zip(good, label):
        if rows[k][0] is not None:
            least[g] = min(least.get(g, rows[k][0]), rows[k][0])
    want = {k: (int(links[i].sum()), least[label[i]]) for i, k in enumerate(good)}
    got = pq.near_vectors(df).collect()
    expected = [(i, *(want.get(k) or (0, i))) for k, (i, _) in enumerate(rows)]
    assert sum(r.n_links for r in got) >= 0.99 * sum(n for _, n, _ in expected)
    assert sorted([(r.vec_id, r.component_id) for r in got], key=repr) == sorted([(i, c) for i, _, c in expected], key=repr)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert pq.near_vectors(df.limit(0)).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(200)]
    edges += [(5000, 5000 + i) for i in range(300)] + [(None, 1)]
    label = {n: n for e in edges for n in e if n is not None}
    for _ in label:
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    got = components.components(spark.createDataFrame(edges, "u long, v long"), Stage(spark))
    linked = {n for a, b in edges if a is not None and a != b for n in (a, b)}
    assert {r.node: r.component for r in got.collect()} == {n: c for n, c in label.items() if n in linked}


@pytest.mark.parametrize("folder", ["tiny", "odd"])
def test_pipeline(spark, request, folder):
    source = request.getfixturevalue(folder)
    docs = spark.read.parquet(f"{source}/documents.parquet") if isinstance(source, str) else source
    stage = Stage(spark)
    for name, step in corpus_pipeline.STAGES:
        made = stage.table(step(spark, docs, ""), name)
        if name != "bpe":
            assert made.schema.names == docs.schema.names
        if name in ("quality_rules", "near_duplicates"):
            assert made.exceptAll(docs).isEmpty()
        docs = made
    assert set(docs.columns) >= {"doc_id", "ids", "n_tokens"}


@pytest.mark.parametrize("name,operator", [("op1_quality_rules", repetition.judge), ("op9_mixing", mixing.mix)])
def test_sql_on_odd_rows(docs, name, operator):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet({docs.inputFiles()})")
    assert parity.differences(operator(docs), con, checks.sql_by_query()[name]) == []


def test_queries_are_named(spark):
    assert [n.split("_")[0] for n in registry.QUERIES] == [*[f"op{i}" for i in range(1, 11)], "pipeline"]
