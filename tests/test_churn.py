"""Drift, splits, evaluation, preprocessing, scoring."""

import itertools
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tallybook import catalog
from tallybook.operators import drift, evaluation, split
from tallybook.plans import models, scoring
from tallybook.plans.features import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES


def numpy_psi(b, c):
    edges = np.unique(np.percentile(b, np.linspace(0, 100, 11)))
    if len(edges) < 2:
        return 0.0
    edges[0], edges[-1] = min(b.min(), c.min()) - 1e-5, max(b.max(), c.max()) + 1e-5
    p, q = (np.histogram(x, edges)[0].astype(float) for x in (b, c))
    p, q = np.where(p == 0, 1e-4, p) / len(b), np.where(q == 0, 1e-4, q) / len(c)
    return float(np.sum((p - q) * np.log(p / q)))


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(5)
    base = pd.DataFrame({
        "recency_days": rng.normal(50, 10, 1000), "monetary_spend": rng.normal(50, 10, 1000),
        "visits": rng.integers(0, 4, 1000).astype(float), "flat": np.full(1000, 3.0)})
    now = pd.DataFrame({
        "recency_days": rng.normal(75, 10, 900), "monetary_spend": rng.normal(50, 10, 900),
        "visits": rng.integers(0, 4, 900).astype(float), "flat": np.full(900, 3.0)})
    return base, now


def test_drift_report(spark, many_parts, samples):
    base, now = samples
    report = drift.feature_drift(spark.createDataFrame(base), spark.createDataFrame(now))
    rows = {r["feature"]: r for r in report.collect()}
    for name in base:
        assert rows[name]["psi_score"] == pytest.approx(numpy_psi(base[name].values, now[name].values), abs=6e-5)
        assert rows[name]["baseline_mean"] == pytest.approx(base[name].mean(), abs=0.0051)
        grid = np.unique(np.concatenate([base[name], now[name]]))
        gap = np.abs(np.searchsorted(np.sort(base[name]), grid, "right") / 1000
                     - np.searchsorted(np.sort(now[name]), grid, "right") / 900).max()
        assert rows[name]["ks_statistic"] == pytest.approx(gap, abs=6e-5)
    assert rows["recency_days"]["psi_score"] >= 0.25
    assert rows["recency_days"]["alert_level"] == "HIGH DRIFT (ALERT)"
    assert rows["monetary_spend"]["psi_score"] < 0.10
    assert report.first()["feature"] == "recency_days"


def test_small_samples_are_left_out(spark):
    few = spark.createDataFrame([(float(i),) for i in range(4)], "x double")
    assert drift.feature_drift(few, few).count() == 0


@pytest.mark.parametrize("n", [40, 500, 20_000])
def test_ks_p_value_is_one_formula(n):
    x = 0.1 * np.sqrt(n / 2)
    series = 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * x * x) for k in range(1, 101))
    assert drift.ks_p_value(0.1, n, n) == pytest.approx(min(1.0, max(0.0, series)))


def test_drift_of_an_empty_column(spark):
    left = spark.createDataFrame([(float(i), float(i)) for i in range(20)], "x double, y double")
    right = spark.createDataFrame([(float(i), None) for i in range(20)], "x double, y double")
    assert [r["feature"] for r in drift.feature_drift(left, right).collect()] == ["x"]


def test_split_sizes(many_parts):
    people = many_parts.range(2786).select("id", (F.col("id") % 5 < 2).cast("int").alias("y"))
    rows = split.stratified_split(people, "y", "id").groupBy("split", "y").count().collect()
    sizes = {(r["split"], r["y"]): r["count"] for r in rows}
    total = {s: sizes[s, 0] + sizes[s, 1] for s in ("train", "val", "test")}
    assert total == {"train": 1810, "val": 418, "test": 558}
    for s, n in total.items():
        assert sizes[s, 1] / n == pytest.approx(0.4, abs=0.002)


def test_fraction_split_is_a_partition(spark):
    a, b = split.fraction_split(spark.range(5000), "id", 0.6)
    assert a.count() + b.count() == 5000 and a.join(b, "id").count() == 0
    assert a.count() / 5000 == pytest.approx(0.6, abs=0.03)


def test_evaluation(spark):
    rows = [(1, 0.9), (1, 0.6), (0, 0.6), (0, 0.2), (1, 0.2), (0, 0.7), (0, 0.0), (1, 1.0)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = evaluation.evaluate(df).first()
    pairs = [(p > n) + (p == n) / 2 for (yp, p) in rows if yp for (yn, n) in rows if not yn]
    assert float(got["roc_auc"]) == pytest.approx(np.mean(pairs), abs=6e-5)
    assert (float(got["accuracy"]), float(got["precision"]), float(got["recall"])) == (0.625, 0.6, 0.75)
    cells = {(r[0], r[1]): r[2] for r in evaluation.confusion_matrix(
        df.withColumn("prediction", F.lit(1))).collect()}
    assert cells == {(0, 0): 0, (0, 1): 4, (1, 0): 0, (1, 1): 4}
    curve = evaluation.roc_curve(df).orderBy("tpr", "fpr").collect()
    assert (curve[0]["threshold"], curve[0]["fpr"], curve[-1]["fpr"], curve[-1]["tpr"]) == (None, 0.0, 1.0, 1.0)


def test_evaluation_without_positives_predicted(spark):
    got = evaluation.evaluate(spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, score double")).first()
    assert (float(got["precision"]), float(got["f1_score"])) == (0.0, 0.0)


@pytest.fixture(scope="module")
def people(spark, tiny):
    return catalog.workspace(spark, tiny).features


def test_preprocessor(spark, people):
    model, names = models.fit_preprocessor(people)
    assert names[:9] == NUMERIC_FEATURES
    matrix = np.array([r[0].toArray() for r in model.transform(people).select("features").collect()])
    assert matrix.shape[1] == len(names)
    assert np.allclose(matrix[:, :9].mean(axis=0), 0, atol=1e-9)
    spread = matrix[:, :9].std(axis=0)
    assert np.all(np.isclose(spread, 1) | np.isclose(spread, 0))
    assert np.all(matrix[:, 9:].sum(axis=1) == len(CATEGORICAL_FEATURES))
    stranger = people.limit(1).withColumn("gender", F.lit("never seen"))
    encoded = model.transform(stranger).first()["features"].toArray()
    assert encoded[9:].sum() == len(CATEGORICAL_FEATURES) - 1


def test_train_score_store(spark, tiny, people, tmp_path):
    w = catalog.workspace(spark, tiny)
    model, table = w.training
    rows = table.collect()
    assert [r["model"] for r in rows] == ["Logistic_Regression", "Random_Forest", "Gradient_Boosting"]
    best = max(rows, key=lambda r: r["combined_score"])
    assert [r["model"] for r in rows if r["is_winner"]] == [best["model"]] == [model.name]
    accepted, rejected = scoring.validate_scoring_input(people)
    assert rejected.count() == 0
    scores = scoring.score_customers(model, accepted)
    models.save_model(spark, model, f"{tmp_path}/model")
    again = scoring.score_customers(models.load_model(spark, f"{tmp_path}/model"), accepted)
    assert sorted(map(tuple, scores.collect())) == sorted(map(tuple, again.collect()))
    totals = scoring.score_totals(scores).first()
    assert totals["total_processed"] == people.count()
    assert people.filter(f"{LABEL} not in (0, 1)").count() == 0


def test_scoring_contract(spark):
    columns = "customer_id string, recency_days double, frequency_orders double, monetary_spend double, " \
              "avg_order_value double, total_units double, cancellation_rate double"
    rows = [("a", 1.0, 1.0, 0.0, 0.0, 0.0, None), ("b", None, 1.0, 0.0, 0.0, 0.0, 0.1), ("c", 1.0, 0.5, 0.0, 0.0, 0.0, 0.1),
            ("d", 1.0, 1.0, 0.0, 0.0, 0.0, 1.1), ("e", -1.0, 0.0, 0.0, 0.0, 0.0, 0.1)]
    accepted, rejected = scoring.validate_scoring_input(spark.createDataFrame(rows, columns))
    ok = accepted.collect()
    assert [r["customer_id"] for r in ok] == ["a"]
    assert (ok[0]["cancellation_rate"], ok[0]["inter_purchase_mean"], ok[0]["age_group"]) == (0.0, 30.0, "36-50")
    assert {r["customer_id"]: r["rejection_reason"] for r in rejected.collect()} == {
        "b": "MISSING_RECENCY_DAYS", "c": "OUT_OF_RANGE_FREQUENCY_ORDERS", "d": "OUT_OF_RANGE_CANCELLATION_RATE",
        "e": "OUT_OF_RANGE_RECENCY_DAYS"}


def test_parameters_of_the_models(spark, tiny):
    found = {r["model"]: json.loads(r["params"]) for r in catalog.workspace(spark, tiny).training[1].collect()}
    assert found == {
        "Logistic_Regression": {"C": 1.0, "penalty": "l2", "solver": "lbfgs", "max_iter": 1000},
        "Random_Forest": {"n_estimators": 100, "max_depth": 10, "criterion": "gini", "random_state": 42},
        "Gradient_Boosting": {"max_iter": 100, "max_depth": 5, "learning_rate": 0.05, "random_state": 42}}


def test_registration_of_the_winner(spark):
    metrics = {m: 0.5 for m in models.METRICS}
    row = models.model_info(spark, models.ChurnModel("Random_Forest", None, None, ["a", "b"], metrics)).first().asDict()
    assert (row.pop("registered_name"), row.pop("version"), row.pop("winning_model")) == (
        "EcommerceChurnPredictor", "1.0", "Random_Forest")
    assert row == {**metrics, "feature_count": 2, "feature_names": ["a", "b"]}
