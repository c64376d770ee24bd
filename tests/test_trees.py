"""Node tables of fitted trees walked by another engine, and by joins."""

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from tallybook import catalog
from tallybook.operators import trees
from tallybook.plans import models


@pytest.fixture(scope="module")
def trained(spark, tiny):
    return catalog.workspace(spark, tiny).trained


WALK = """
WITH RECURSIVE walk(id, x, tree, node, value, step) AS (
  SELECT r.id, r.x, n.tree, n.node, n.value, 0 FROM rows r, nodes n WHERE n.node = 0
  UNION ALL
  SELECT w.id, w.x, w.tree, n.node, n.value, step + 1 FROM walk w
  JOIN nodes p ON p.tree = w.tree AND p.node = w.node
  JOIN nodes n ON n.tree = w.tree AND n.node = CASE
    WHEN CASE WHEN p.threshold IS NOT NULL THEN w.x[p.feature + 1] <= p.threshold ELSE list_contains(p.categories, w.x[p.feature + 1]) END
    THEN p."left" ELSE p."right" END
  WHERE p.feature IS NOT NULL)
SELECT id, SUM(value) AS total, COUNT(*) AS trees FROM walk WHERE value IS NOT NULL GROUP BY id"""


@pytest.mark.parametrize("name", ["Random_Forest", "Gradient_Boosting"])
def test_nodes_give_the_scores(spark, trained, tmp_path, name):
    model = trained.models[name].classifier.stages[-1]
    nodes = trees.node_table(spark, model, f"{tmp_path}/model")
    nodes.write.parquet(f"{tmp_path}/nodes")
    trained.matrix.select(F.col("customer_id").alias("id"), vector_to_array("features").alias("x")).write.parquet(f"{tmp_path}/rows")
    con = duckdb.connect()
    for t in ("nodes", "rows"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}/*.parquet')")
    walked = {i: (total, n) for i, total, n in con.execute(WALK).fetchall()}
    scored = models.replayed_scores(trained, name, f"{tmp_path}/again").collect()
    assert len(scored) == len(walked) == trained.matrix.count()
    import math
    for r in scored:
        total, n = walked[r["customer_id"]]
        assert n == model.getNumTrees
        mine = 1 / (1 + math.exp(-2 * total)) if name == "Gradient_Boosting" else total / n
        assert mine == pytest.approx(r["probability"], abs=1e-12) and r["replayed"] == pytest.approx(r["probability"], abs=1e-12)


def test_gradient_is_zero_only_at_the_optimum(trained):
    found = {r["slot"]: r["gradient"] for r in models.logistic_gradient(trained).collect()}
    names = next(iter(trained.models.values())).feature_names
    assert set(found) == {*names, "intercept"} and max(map(abs, found.values())) < catalog.GRADIENT_BOUND
    # A quarter more rows: the same coefficients are no optimum of that.
    moved = trained._replace(matrix=trained.matrix.unionAll(trained.matrix.filter("is_churned = 1")))
    assert max(abs(r["gradient"]) for r in models.logistic_gradient(moved).collect()) > catalog.GRADIENT_BOUND
