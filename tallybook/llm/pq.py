"""Embedding near-duplicates by product quantisation over inverted lists.

Equal vectors are one node with a count, so copies cost nothing. Coarse centroids split the nodes into lists; a
node's residual to its centroid is stored as one code per subspace, with the length of what the codes miss. A query
probes its own list and every list whose border with it is at most half a link's greatest length away: of the two ends of a
link, one is then found from the other. In a list, asymmetric distances
come from a table per query; a pair is dropped only if its table distance exceeds the wanted one by more than the
stored miss, which loses nothing, and the rest are reranked by exact cosine in double precision.

Vectors of each length have an index of their own. Centroids and codebooks are fitted on at most ``SAMPLE`` nodes (those with the least digests); every node is indexed.
Lists and their queries are cut into blocks, so a crowded list spreads over tasks. A task returns link counts
and one edge a node, never the pairs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.components import components
from tallybook.staging import Stage

COSINE = 0.95
SAMPLE = 32_768
LIST_SIZE, MAX_LISTS = 256, 2_048
SUBSPACES, CODES = 8, 256
ENTRIES, QUERIES = 1_024, 4_096
_NODE = "node long, copies long, unit binary, list int, probes array<int>"


class Model(NamedTuple):
    centroids: np.ndarray
    #: One table of centres per subspace, and the columns of each.
    books: list[np.ndarray]
    columns: list[np.ndarray]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ y.T + (y**2).sum(1), 0)


def _means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's centres of a bounded sample."""
    centres = x[np.random.default_rng(1).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, centres).argmin(1)
        totals = np.zeros_like(centres)
        np.add.at(totals, near, x)
        sizes = np.bincount(near, minlength=len(centres))
        centres[sizes > 0] = totals[sizes > 0] / sizes[sizes > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int) -> Model:
    centroids = _means(sample, lists)
    rest = sample - centroids[_distances(sample, centroids).argmin(1)]
    columns = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
    return Model(centroids, [_means(rest[:, c], CODES) for c in columns], columns)


def margin(least: float) -> float:
    """How far beyond a list's border a query still probes, so that one end of each link at ``least`` finds the other."""
    return float(np.sqrt(max(0.0, 2 - 2 * least))) / 2 + 1e-6


def _units(vectors: list) -> list[bytes | None]:
    """Unit vectors as bytes; None for what links with nothing."""
    out = []
    for v in vectors:
        unit = None
        if v and None not in v:
            x = np.array(v, dtype=np.float64)
            peak = np.abs(x).max()
            if np.isfinite(x).all() and peak > 0:
                x = x / peak
                unit = (x / np.sqrt(x @ x) + 0.0).tobytes()
        out.append(unit)
    return out


def _index(model: Model, units: np.ndarray, beyond: float):
    """List, probes, codes and the length of what the codes miss, of each vector."""
    far = _distances(units, model.centroids)
    own = far.argmin(1)
    gaps = np.sqrt(_distances(model.centroids, model.centroids))[own]
    border = (far - far[np.arange(len(own)), own][:, None]) / (2 * np.maximum(gaps, 1e-12))
    border[np.arange(len(own)), own] = 0
    probes = [np.flatnonzero(b <= beyond) for b in border]
    rest = units - model.centroids[own]
    codes = np.stack([_distances(rest[:, c], b).argmin(1) for c, b in zip(model.columns, model.books)], 1).astype(np.uint8)
    told = np.concatenate([b[codes[:, i]] for i, b in enumerate(model.books)], 1)
    return own, probes, codes, np.sqrt(((rest - told) ** 2).sum(1))


def _search(model: Model, entries: pa.Table, queries: pa.Table, least: float):
    """Links between the queries and the entries of one block of a list, as indices."""
    size = model.centroids.shape[1]
    stored = np.frombuffer(b"".join(entries["unit"].to_pylist())).reshape(-1, size)
    asked = np.frombuffer(b"".join(queries["unit"].to_pylist())).reshape(-1, size)
    codes = np.frombuffer(b"".join(entries["codes"].to_pylist()), np.uint8).reshape(len(stored), -1)
    reach = (np.sqrt(2 - 2 * least) + entries["missed"].to_numpy() + 1e-9) ** 2
    centre = model.centroids[entries["list"][0].as_py()]
    entry_node, query_node = entries["node"].to_numpy(), queries["node"].to_numpy()
    found = []
    for lo in range(0, len(asked), 256):
        rest = asked[lo : lo + 256] - centre
        total = np.zeros((len(rest), len(stored)))
        for i, (c, book) in enumerate(zip(model.columns, model.books)):
            total += _distances(rest[:, c], book)[:, codes[:, i]]
        q, e = np.nonzero(total <= reach)
        for at in range(0, len(q), 1 << 16):
            a, b = q[at : at + (1 << 16)] + lo, e[at : at + (1 << 16)]
            good = (np.einsum("ij,ij->i", asked[a], stored[b]) >= least) & (query_node[a] != entry_node[b])
            found.append((a[good], b[good]))
    return [np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(2)]


def _labels(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """Smallest index reachable along the links."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(model: Model, entries: pa.Table, queries: pa.Table, least: float) -> pa.Table:
    """Per node: vectors linked to it here that no other block counts, and a node it is connected to."""
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])
    if not len(entries) or not len(queries):
        return schema.empty_table()
    q, e = _search(model, entries, queries, least)
    asked, stored = queries["node"].to_numpy(), entries["node"].to_numpy()
    nodes, place = np.unique(np.concatenate([asked[q], stored[e]]), return_inverse=True)
    label = _labels(place[: len(q)], place[len(q) :], len(nodes))
    links = np.zeros(len(nodes), dtype=np.int64)
    np.add.at(links, place[: len(q)], entries["copies"].to_numpy()[e])
    # An entry that probes the query's own list finds the query there; otherwise the link is counted for it here.
    probes = entries["probes"].to_pylist()
    table = np.full((len(probes), max(map(len, probes))), -1)
    for i, p in enumerate(probes):
        table[i, : len(p)] = p
    own = queries["own"].to_numpy()
    missed = np.ones(len(q), dtype=bool)
    for at in range(0, len(q), 1 << 18):
        part = slice(at, at + (1 << 18))
        missed[part] = ~(table[e[part]] == own[q[part], None]).any(1)
    np.add.at(links, place[len(q) :][missed], queries["copies"].to_numpy()[q[missed]])
    return pa.Table.from_arrays([pa.array(nodes), pa.array(links), pa.array(nodes[label])], schema=schema)


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", least: float = COSINE,
    stage: Stage | None = None,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of different
    lengths with one another. Equal vectors link, also under one repeated id. A null id is no ``component_id`` unless a whole
    component has only null ids. No rows give no rows. Other columns are not carried, so their names cannot clash.
    """
    spark = vectors.sparkSession
    stage = stage or Stage(spark)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    def normalise(batches):
        for batch in batches:
            units = pa.array(_units(batch.column("v").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), units], ["vec_id", "unit"])

    units = stage.table(
        rows.mapInArrow(normalise, "vec_id long, unit binary").withColumn("key", F.md5("unit")), "units")
    grouped = units.filter("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first_id"), F.first("unit").alias("unit"))
    nodes = stage.table(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    edges, counts = (spark.createDataFrame([], f"{a} long, {b} long") for a, b in (("u", "v"), ("node", "links")))
    length = (F.octet_length("unit") / 8).cast("int")
    sizes = nodes.groupBy(length.alias("size")).agg(F.count("*").alias("n")).filter("n > 1").orderBy("size").collect()
    for size, total in sizes:  # a row for each length of vectors
        found = _all_links(nodes.filter(length == size), total, size, least, stage)
        edges, counts = edges.unionAll(found[0]), counts.unionAll(found[1])
    parts = stage.table(components(edges, stage), "components")
    named = nodes.select("key", "node", "copies", "first_id").join(counts, "node", "left").join(parts, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    smallest = stage.table(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest")
    named = stage.table(named.join(smallest, "component").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "named")
    result = units.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))


def _all_links(nodes: DataFrame, total: int, size: int, least: float, stage: Stage) -> tuple[DataFrame, DataFrame]:
    spark = nodes.sparkSession
    lists = max(1, min(MAX_LISTS, round(total / LIST_SIZE)))
    taken = nodes.orderBy("key").limit(SAMPLE).select("unit").collect()  # bounded by SAMPLE
    fitted = fit(np.frombuffer(b"".join(bytes(r[0]) for r in taken)).reshape(-1, size), lists)
    model = spark.sparkContext.broadcast(tuple(fitted))  # bounded by MAX_LISTS and CODES

    def index(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                own, probes, codes, missed = _index(
                    Model(*model.value), np.frombuffer(b"".join(part.column("unit").to_pylist())).reshape(-1, size), margin(least))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("node", "copies", "unit")], pa.array(own, pa.int32()),
                     pa.array([p.tolist() for p in probes], pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed)],
                    ["node", "copies", "unit", "list", "probes", "codes", "missed"])

    indexed = stage.table(nodes.select("node", "copies", "unit").mapInArrow(
        index, f"{_NODE}, codes binary, missed double"), "index")
    # One row per list: blocks of entries, and blocks of the queries that probe it.
    entries = indexed.groupBy("list").count().select("list", F.ceil(F.col("count") / ENTRIES).cast("int").alias("cuts"))
    asked = indexed.select(F.explode("probes").alias("list")).groupBy("list").count().select(
        "list", F.ceil(F.col("count") / QUERIES).cast("int").alias("packs"))
    sizes = F.broadcast(entries.join(asked, "list"))  # at most MAX_LISTS rows
    salt = F.xxhash64("node")

    stored = indexed.join(sizes, "list").withColumn("cut", F.pmod(salt, F.col("cuts")).cast("int")).withColumn(
        "pack", F.explode(F.sequence(F.lit(0), F.col("packs") - 1)))
    asking = indexed.toDF(*indexed.columns).select("node", "copies", "unit", F.col("list").alias("own"), F.explode("probes").alias("list"))
    asking = asking.join(sizes, "list").withColumn("pack", F.pmod(salt, F.col("packs")).cast("int")).withColumn(
        "cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    block = ["list", "cut", "pack"]
    found = stored.select(*block, "node", "copies", "unit", "probes", "codes", "missed").groupBy(*block).cogroup(
        asking.select(*block, "node", "copies", "unit", "own").groupBy(*block)).applyInArrow(
        lambda left, right: _links(Model(*model.value), left, right, least), "node long, links long, other long")
    found = stage.table(found, "links")
    edges = found.select(F.col("node").alias("u"), F.col("other").alias("v"))
    return edges, stage.table(found.groupBy("node").agg(F.sum("links").alias("links")), "counts")
