"""Churn models on Spark ML: preprocessing, three classifiers, evaluation, selection, storage."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.business import REGISTERED_NAME, REGISTERED_VERSION
from tallybook.operators import trees
from tallybook.operators.evaluation import evaluate
from tallybook.operators.split import stratified_split
from tallybook.plans.features import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from tallybook.session import apart
from tallybook.staging import Stage, stage_of

# Hyperparameters and weights of the selection score.
PARAMS = {
    "Logistic_Regression": {"C": 1.0, "penalty": "l2", "solver": "lbfgs", "max_iter": 1000},
    "Random_Forest": {"n_estimators": 100, "max_depth": 10, "criterion": "gini", "random_state": 42},
    "Gradient_Boosting": {"max_iter": 100, "max_depth": 5, "learning_rate": 0.05, "random_state": 42},
}
AUC_WEIGHT, F1_WEIGHT = 0.6, 0.4
METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "log_loss"]


@dataclass
class ChurnModel:
    name: str
    preprocessor: PipelineModel
    classifier: PipelineModel
    feature_names: list[str]
    metrics: dict[str, float]

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``churn_prediction`` and ``churn_probability``."""
        out = self.classifier.transform(self.preprocessor.transform(df))
        return out.select(
            *df.columns,
            F.col("prediction").cast("int").alias("churn_prediction"),
            vector_to_array("probability")[1].alias("churn_probability"),
        )


def fit_preprocessor(train: DataFrame) -> tuple[PipelineModel, list[str]]:
    """Standardise numbers and one-hot encode categories, learnt from ``train`` only.

    Scaling uses the population deviation (a constant column is only centred). A category not seen
    in training encodes to zeros; a missing one is a category of its own.
    """
    stats = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in NUMERIC_FEATURES],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in NUMERIC_FEATURES],
    ).first()
    scaled = ", ".join(
        f"(CAST({c} AS DOUBLE) - {stats[f'm_{c}']!r}D) / {(stats[f's_{c}'] or 1.0)!r}D AS z_{c}"
        for c in NUMERIC_FEATURES)
    named = ", ".join(f"COALESCE({c}, 'nan') AS k_{c}" for c in CATEGORICAL_FEATURES)
    indexer = StringIndexer(
        inputCols=[f"k_{c}" for c in CATEGORICAL_FEATURES], outputCols=[f"i_{c}" for c in CATEGORICAL_FEATURES],
        stringOrderType="alphabetAsc", handleInvalid="keep")
    encoder = OneHotEncoder(
        inputCols=[f"i_{c}" for c in CATEGORICAL_FEATURES], outputCols=[f"o_{c}" for c in CATEGORICAL_FEATURES],
        dropLast=True)  # the slot kept for unseen values is the dropped one
    assembler = VectorAssembler(
        inputCols=[f"z_{c}" for c in NUMERIC_FEATURES] + [f"o_{c}" for c in CATEGORICAL_FEATURES],
        outputCol="features")
    prepare = SQLTransformer(statement=f"SELECT *, {scaled}, {named} FROM __THIS__")
    model = Pipeline(stages=[prepare, indexer, encoder, assembler]).fit(train)
    labels = model.stages[1].labelsArray
    names = NUMERIC_FEATURES + [f"{c}_{v}" for c, vs in zip(CATEGORICAL_FEATURES, labels) for v in vs]
    return model, names


def scaled_numbers(preprocessor: PipelineModel, df: DataFrame) -> DataFrame:
    """The standardised numeric features of ``df`` under their own names."""
    ready = preprocessor.stages[0].transform(df)
    return ready.select("customer_id", *[F.col(f"z_{c}").alias(c) for c in NUMERIC_FEATURES])


def classifiers(train_rows: int) -> dict:
    common = {"featuresCol": "features", "labelCol": LABEL}
    lr, rf, gb = (PARAMS[n] for n in ("Logistic_Regression", "Random_Forest", "Gradient_Boosting"))
    return {
        # Spark averages the loss over rows, so an inverse strength C becomes 1 / (C n).
        "Logistic_Regression": LogisticRegression(
            regParam=1.0 / (lr["C"] * max(train_rows, 1)), elasticNetParam=0.0, maxIter=lr["max_iter"],
            standardization=False, **common),
        "Random_Forest": RandomForestClassifier(
            numTrees=rf["n_estimators"], maxDepth=rf["max_depth"], impurity="gini",
            featureSubsetStrategy="sqrt", seed=rf["random_state"], **common),
        "Gradient_Boosting": GBTClassifier(
            maxIter=gb["max_iter"], maxDepth=gb["max_depth"], stepSize=gb["learning_rate"],
            seed=gb["random_state"], **common),
    }


class Training(NamedTuple):
    """All classifiers in training order, their comparison, and what they learnt from (features as a vector, by split)."""

    models: dict[str, ChurnModel]
    comparison: DataFrame
    matrix: DataFrame
    train_rows: int

    @property
    def winner(self) -> ChurnModel:
        return max(self.models.values(), key=combined_score)  # the first of equals


def combined_score(model: ChurnModel) -> float:
    return AUC_WEIGHT * model.metrics["roc_auc"] + F1_WEIGHT * model.metrics["f1_score"]


def train_all(features: DataFrame, stage: Stage | None = None) -> Training:
    """Fit every classifier and measure it on the test rows."""
    stage = stage_of(features, stage)
    rows = stage.table(stratified_split(features, LABEL, "customer_id", stage=stage), "split-features")
    sizes = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}
    preprocessor, names = fit_preprocessor(rows.filter("split = 'train'"))
    ready = stage.table(
        preprocessor.transform(rows).select("customer_id", "split", LABEL, "features"), "model-matrix")
    test = ready.filter("split = 'test'")
    # A fitted model's summary keeps the session of its training rows and goes to the tasks that score. A session in which
    # anything was observed (loads are) cannot go there, so the training rows are read in one of their own.
    train = stage.table(ready.filter("split = 'train'"), "train-rows", apart(features.sparkSession))

    results, fits = [], {}
    for position, (name, estimator) in enumerate(classifiers(sizes.get("train", 0)).items()):
        fitted = Pipeline(stages=[estimator]).fit(train)
        scored = fitted.transform(test).select(
            F.col(LABEL).alias("label"), F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("probability")[1].alias("score"))
        scored = stage.table(scored, f"scored-{position}")
        found = evaluate(scored, prediction="prediction", stage=stage).first()
        metrics = {m: float(found[m]) for m in METRICS}
        fits[name] = ChurnModel(name, preprocessor, fitted, names, metrics)
        results.append((position, name, json.dumps(PARAMS[name]), *metrics.values(), combined_score(fits[name])))

    schema = "position int, model string, params string, " + ", ".join(f"{m} double" for m in METRICS)
    table = features.sparkSession.createDataFrame(results, schema + ", combined_score double")
    made = Training(fits, table, ready, sizes.get("train", 0))
    table = table.withColumns(
        {
            "is_winner": F.col("model") == made.winner.name,
            "train_samples": F.lit(sizes.get("train", 0)),
            "val_samples": F.lit(sizes.get("val", 0)),
            "test_samples": F.lit(sizes.get("test", 0)),
            "feature_count": F.lit(len(names)),
        }).orderBy("position")
    return made._replace(comparison=table)


def train_and_select(features: DataFrame, stage: Stage | None = None) -> tuple[ChurnModel, DataFrame]:
    """The best classifier and the comparison table (one row per model, in training order)."""
    made = train_all(features, stage)
    return made.winner, made.comparison


def encoded_categories(training: Training) -> DataFrame:
    """Category slots that are set, a row each: ``customer_id`` and ``slot``."""
    names = next(iter(training.models.values())).feature_names
    slots = F.array(*[F.lit(n) for n in names])
    set_ = training.matrix.select("customer_id", F.posexplode(vector_to_array("features")).alias("at", "value"))
    first = len(NUMERIC_FEATURES)
    return set_.filter((F.col("at") >= first) & (F.col("value") == 1)).select(
        "customer_id", F.element_at(slots, F.col("at") + 1).alias("slot"))


def logistic_gradient(training: Training) -> DataFrame:
    """The penalised gradient at the fitted coefficients, a row each; zero at the optimum.

    The objective is the mean log loss over the training rows plus half the penalty times the squared coefficients, the
    intercept left out.
    """
    model = training.models["Logistic_Regression"]
    fitted = model.classifier.stages[-1]
    weights = [float(w) for w in fitted.coefficients]
    rows = training.matrix.filter("split = 'train'").select(
        F.col(LABEL).alias("label"), F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"))
    beta = F.array(*[F.lit(w) for w in [*weights, float(fitted.intercept)]])
    margin = F.aggregate(F.zip_with("x", beta, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
    loss = rows.select((1 / (1 + F.exp(-margin)) - F.col("label")).alias("error"), F.posexplode("x").alias("at", "value"))
    mean = loss.groupBy("at").agg((F.sum(F.col("error") * F.col("value")) / F.lit(float(training.train_rows))).alias("mean"))
    penalty = F.element_at(F.array(*[F.lit(w * fitted.getRegParam()) for w in weights], F.lit(0.0)), F.col("at") + 1)
    names = F.array(*[F.lit(n) for n in [*model.feature_names, "intercept"]])
    return mean.select(F.element_at(names, F.col("at") + 1).alias("slot"), (F.col("mean") + penalty).alias("gradient"))


def replayed_scores(training: Training, name: str, folder: str) -> DataFrame:
    """``customer_id``, ``probability`` by the model, and ``replayed`` by its node table, for all customers."""
    spark = training.matrix.sparkSession
    fitted = training.models[name].classifier
    nodes = trees.node_table(spark, fitted.stages[-1], folder)
    rows = training.matrix.select("customer_id", vector_to_array("features").alias("x"))
    again = trees.replayed(nodes, fitted.stages[-1], rows, "customer_id", "x").withColumnRenamed("probability", "replayed")
    scores = fitted.transform(training.matrix).select("customer_id", vector_to_array("probability")[1].alias("probability"))
    return scores.join(again, "customer_id")


def model_info(spark: SparkSession, model: ChurnModel) -> DataFrame:
    """One row: registered name and version, winner, metrics and feature names."""
    row = (
        REGISTERED_NAME, REGISTERED_VERSION, model.name, *[model.metrics[m] for m in METRICS],
        len(model.feature_names), model.feature_names)
    schema = (
        "registered_name string, version string, winning_model string, "
        + ", ".join(f"{m} double" for m in METRICS) + ", feature_count int, feature_names array<string>")
    return spark.createDataFrame([row], schema)


def save_model(spark: SparkSession, model: ChurnModel, folder: str) -> None:
    """Store preprocessor, classifier and the describing row below ``folder``."""
    model.preprocessor.write().overwrite().save(f"{folder}/preprocessor")
    model.classifier.write().overwrite().save(f"{folder}/classifier")
    info = model_info(spark, model).withColumn("saved_at", F.current_timestamp())
    info.coalesce(1).write.mode("overwrite").json(f"{folder}/info")


def load_model(spark: SparkSession, folder: str) -> ChurnModel:
    info = spark.read.json(f"{folder}/info").first()
    return ChurnModel(
        info["winning_model"],
        PipelineModel.load(f"{folder}/preprocessor"),
        PipelineModel.load(f"{folder}/classifier"),
        list(info["feature_names"]),
        {m: info[m] for m in METRICS},
    )
