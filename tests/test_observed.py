"""Models fitted in a session in which rows were observed, as loads do."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from tallybook import catalog, session
from tallybook.plans import models, scoring
from tallybook.sources import adapter
from tallybook.staging import Stage


def test_models_score_after_an_observation(spark, tiny):
    seen = Observation()
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 10}
    features = catalog.workspace(spark, tiny).features
    made = models.train_all(features)
    assert made.comparison.count() == len(made.models) == 3
    for model in made.models.values():
        assert model.predict(features).filter("churn_probability between 0 and 1").count() == features.count()


@pytest.fixture(scope="module")
def mounted(spark, tmp_path_factory):
    """A store that only a setting made in the running session leads to."""
    settings = {
        "fs.viewfs.mounttable.observed.link./in": f"file://{tmp_path_factory.mktemp('store')}",
        "fs.viewfs.impl.disable.cache": "true",
        "spark.sql.files.maxPartitionBytes": "64m",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield "viewfs://observed/in"
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def observed(spark, tiny, mounted):
    """A workspace whose models are fitted after an observation, with its tables in that store."""
    seen = Observation()
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 10}
    w = catalog.Workspace(spark, tiny)
    w.stage = Stage(spark, f"{mounted}/tables")
    return w


def test_settings_go_along(spark, mounted):
    own = session.apart(spark)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    own.conf.set("spark.sql.files.maxPartitionBytes", "32m")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"


def test_logistic_optimality(observed):
    found = catalog.QUERIES["logistic_optimality"](observed).collect()
    names = next(iter(observed.trained.models.values())).feature_names
    assert sorted(r["slot"] for r in found) == sorted([*names, "intercept"]) and all(r["optimal"] for r in found)


def test_tree_replay(observed):
    found = catalog.QUERIES["tree_replay"](observed).collect()
    assert len(found) == 2 * observed.features.count() and all(r["same"] for r in found)


def test_reloaded_model_agrees(observed):
    found = catalog.QUERIES["reloaded_model_agrees"](observed).collect()
    assert len(found) == observed.features.count() and all(r["same"] for r in found)


def test_model_comparison(observed):
    found = catalog.QUERIES["model_comparison"](observed).collect()
    assert [r["model"] for r in found] == list(models.PARAMS)
    best = max(found, key=lambda r: models.AUC_WEIGHT * r["roc_auc"] + models.F1_WEIGHT * r["f1_score"])
    assert [r["model"] for r in found if r["is_winner"]] == [best["model"]]


def test_model_info(observed):
    (found,) = catalog.QUERIES["model_info"](observed).collect()
    best = observed.trained.comparison.filter("is_winner").first()
    assert found["winning_model"] == best["model"] and [found[m] for m in models.METRICS] == [best[m] for m in models.METRICS]
    assert found["feature_count"] == len(found["feature_names"]) == best["feature_count"]


def test_churn_scores(observed):
    found = {r["customer_id"]: r for r in catalog.QUERIES["churn_scores"](observed).collect()}
    accepted, _ = scoring.validate_scoring_input(adapter.scoring_requests(observed.features))
    assert len(found) == accepted.count() > 0
    for r in observed.trained.winner.predict(accepted).collect():
        mine = found[r["customer_id"]]
        assert mine["churn_prediction"] == r["churn_prediction"]
        assert mine["churn_probability"] == pytest.approx(r["churn_probability"], abs=5.1e-5)


def test_churn_score_totals(observed):
    (found,) = catalog.QUERIES["churn_score_totals"](observed).collect()
    levels = [r["risk_level"] for r in catalog.QUERIES["churn_scores"](observed).collect()]
    assert found["total_processed"] == len(levels) and found["high_risk_count"] == levels.count("High Risk")


@pytest.fixture(scope="module")
def reopened(spark, tiny):
    """A workspace of a session that holds a setting of the context, as a later ``getOrCreate`` leaves it there."""
    own, rejects = spark.newSession(), "spark.sql.legacy.setCommandRejectsSparkCoreConfs"
    own.conf.set(rejects, "false")
    own.conf.set("spark.task.maxFailures", "2")
    own.conf.unset(rejects)
    return catalog.Workspace(own, tiny)


def test_settings_of_the_context_stay_behind(reopened):
    assert reopened.spark.conf.get("spark.task.maxFailures") == "2"
    reopened.spark.conf.set("spark.sql.files.maxPartitionBytes", "96m")
    own = session.apart(reopened.spark)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "96m" and own.conf.get("spark.task.maxFailures", None) != "2"


def test_tree_replay_asked_twice(reopened):
    """Both answers hold, also the one that is read after the query was asked again."""
    for found in [catalog.QUERIES["tree_replay"](reopened) for _ in range(2)]:
        found = found.collect()
        assert len(found) == 2 * reopened.features.count() and all(r["same"] for r in found)


#: Rows that queries on the models give for so many customers and accepted requests.
ROWS = {
    "reloaded_model_agrees": lambda customers, accepted: customers,
    "model_comparison": lambda customers, accepted: len(models.PARAMS),
    "model_info": lambda customers, accepted: 1,
    "churn_scores": lambda customers, accepted: accepted,
    "churn_score_totals": lambda customers, accepted: 1,
}


@pytest.mark.parametrize("name", ROWS)
def test_after_a_setting_of_the_context(reopened, name):
    accepted, _ = scoring.validate_scoring_input(adapter.scoring_requests(reopened.features))
    found = catalog.QUERIES[name](reopened).collect()
    assert len(found) == ROWS[name](reopened.features.count(), accepted.count())
    assert all(r["same"] for r in found if "same" in r)
    assert all(r["total_processed"] == accepted.count() for r in found if "total_processed" in r)
