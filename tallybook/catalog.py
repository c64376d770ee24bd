"""Every query by name, as a function of a session and a folder of source tables."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import business
from tallybook.functions.coerce import strip, title_case
from tallybook.operators import cleaning, constraints, drift, evaluation, quality, split
from tallybook.plans import dashboard, dims, etl, features, models, reports, scoring, upkeep
from tallybook.plans.warehouse import Warehouse, run_sql
from tallybook.schemas import BROKEN_RECORD, FULL_BATCH, LINE_KEYS, RAW_COLUMNS, SOURCE_COLUMNS, WAREHOUSE_TABLES, column_types
from tallybook.sources import adapter, batches, readers, writers
from tallybook.streaming import landing


class Workspace(Warehouse):
    """A warehouse over one folder plus the views and models several queries share."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, adapter.retail_raw(spark, folder), adapter.retail_master(spark, folder))
        self.folder = folder

    @cached_property
    def sales_view(self) -> DataFrame:
        return reports.sales_mart_view(self.mart_sales_performance, self.dim_date, self.dim_geography)

    @cached_property
    def profiles(self) -> DataFrame:
        return reports.rfm_profile(self.mart_customer_rfm, self.dim_customer)

    @cached_property
    def products(self) -> DataFrame:
        """Product revenue feeds six views, so it is stored."""
        return self.stage.table(reports.product_revenue(self.fact_sales, self.dim_product), "products")

    @cached_property
    def features(self) -> DataFrame:
        found = features.extract_customer_features(self.fact_sales, self.dim_customer, stage=self.stage)
        return self.stage.table(found, "features")

    @cached_property
    def feature_sides(self) -> tuple[DataFrame, DataFrame]:
        return split.fraction_split(self.features, "customer_id", 0.6)

    @cached_property
    def trained(self) -> models.Training:
        return models.train_all(self.features, self.stage)

    @cached_property
    def training(self) -> tuple[models.ChurnModel, DataFrame]:
        return self.trained.winner, self.trained.comparison

    @cached_property
    def churn_scores(self) -> DataFrame:
        accepted, _ = scoring.validate_scoring_input(adapter.scoring_requests(self.features))
        return scoring.score_customers(self.training[0], accepted)

    @cached_property
    def months(self) -> str:
        """Folder with the raw lines exported month by month."""
        folder = f"{self.stage.root}/months"
        batches.export_monthly(self.raw, folder)
        return folder

    @cached_property
    def loaded(self) -> str:
        """Folder of a complete load of the stored raw lines."""
        root = f"{self.stage.root}/full-load"
        etl.run_full(self.spark, self.raw, self.master, root)
        return root

    @cached_property
    def loaded_by_month(self) -> str:
        root = f"{self.stage.root}/monthly-load"
        etl.run_incremental(self.spark, batches.read_monthly(self.spark, self.months), self.master, root)
        return root

    @cached_property
    def loaded_latest(self) -> str:
        """Folder of a load of the newest month alone."""
        root = f"{self.stage.root}/latest-load"
        etl.run_latest(self.spark, self.months, self.master, root)
        return root

    @cached_property
    def upkept(self) -> str:
        """Folder of a warehouse that grew: the older months, then late lines of one of them, then the newest month."""
        root = f"{self.stage.root}/upkept"
        ids = sorted(r[0] for r in self.spark.read.json(f"{self.months}/manifest").select("batch_id").collect())
        whole = batches.read_monthly(self.spark, self.months)
        late = (F.col("batch_id") == ids[len(ids) // 2]) & F.col("InvoiceNo").endswith("7")
        older = whole.filter(F.col("batch_id").isin(ids[:-1]))
        etl.run_incremental(self.spark, older.filter(~F.coalesce(late, F.lit(False))), self.master, root, ids[:-1])
        etl.run_incremental(self.spark, whole.filter(late).withColumn("batch_id", F.lit(LATE_BATCH)), self.master, root)
        etl.run_latest(self.spark, self.months, self.master, root)
        return root

    def upkept_table(self, name: str) -> DataFrame:
        """A table of that warehouse with natural keys."""
        tables = {n: readers.read_table(self.spark, self.upkept, n) for n in WAREHOUSE_TABLES}
        return upkeep.natural(tables, name)

    @cached_property
    def loaded_by_stream(self) -> str:
        root = f"{self.stage.root}/stream-load"
        landing.load_arriving_batches(
            self.spark, self.months, root, f"{self.stage.root}/stream-checkpoint").awaitTermination()
        return root

    @cached_property
    def reloaded_model(self) -> models.ChurnModel:
        folder = f"{self.stage.root}/model"
        models.save_model(self.spark, self.training[0], folder)
        return models.load_model(self.spark, folder)

    @cached_property
    def label_scores(self) -> DataFrame:
        return adapter.label_scores(self.spark, self.folder)

    def event_sides(self, factor: float = 1.0) -> tuple[DataFrame, DataFrame]:
        sides = adapter.event_sides(self.spark, self.folder)
        return (
            sides.filter("side = 'baseline'").select("value"),
            sides.filter("side = 'current'").select((F.col("value") * factor).alias("value")))


#: Rows of a trial run.
TRIAL_ROWS = 500
#: Largest component of the gradient that counts as zero; the fit stops by the change of its loss.
GRADIENT_BOUND = 1e-4
#: A batch of lines that came late; its id sorts behind those of the months.
LATE_BATCH = "batch_late"

_workspaces: dict[tuple[str, str], Workspace] = {}
_lock = threading.Lock()


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """Shared per session and folder: tables are built by the first query that needs them."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    with _lock:
        if key not in _workspaces:
            _workspaces[key] = Workspace(spark, folder.rstrip("/"))
        return _workspaces[key]


def _rejected(w: Workspace) -> DataFrame:
    return w.rejected().drop("logged_at")


def _rejected_by_month(w: Workspace) -> DataFrame:
    return w.rejected(F.coalesce(batches.batch_of(), F.lit(FULL_BATCH)))


def _tables(w: Workspace) -> dict[str, DataFrame]:
    return {n: w.table(n) for n in WAREHOUSE_TABLES}


def _audit(w: Workspace) -> DataFrame:
    sales, profiles = (t.agg(F.count("*")).scalar() for t in (w.fact_sales, w.mart_customer_rfm))
    totals = quality.summary_of(w.gated, FULL_BATCH).withColumns({"sales": sales, "profiles": profiles})
    return totals.select(
        "batch_id",
        F.col("total_records").alias("raw_row_count"),
        F.col("sales").alias("cleaned_row_count"),
        F.col("rejected_records").alias("rejected_row_count"),
        F.lit("COMPLETED").alias("status"),
        F.concat(F.lit("Successfully loaded "), "sales", F.lit(" sales and "), "profiles",
                 F.lit(" customer RFM profiles.")).alias("notes"),
    )


def _run_counts(w: Workspace) -> DataFrame:
    totals = quality.summary_of(w.gated, FULL_BATCH).select(
        F.col("total_records").alias("raw_records"), F.col("valid_records").alias("clean_records"),
        "rejected_records")
    measures = totals.unpivot([], totals.columns, "measure", "n")
    return measures.unionAll(reports.table_row_counts(_tables(w)))


def _categories(w: Workspace) -> DataFrame:
    text = F.upper(strip(F.coalesce("Description", F.lit("UNKNOWN_PRODUCT"))))
    return w.raw.select(text.alias("description")).distinct().withColumn(
        "category", business.product_category("description"))


def _regions(w: Workspace) -> DataFrame:
    names = w.raw.select(title_case(strip(F.coalesce("Country", F.lit("")))).alias("country")).distinct()
    return names.select(
        "country", business.geography_region("country").alias("region"),
        business.market_tier("country").alias("market_tier"))


def _segments(w: Workspace) -> DataFrame:
    scores = w.mart_customer_rfm.groupBy("r_score", "f_score", "m_score").agg(F.count("*").alias("customers"))
    return scores.withColumn("customer_segment", business.rfm_segment("r_score", "f_score", "m_score"))


def _copies(w: Workspace) -> DataFrame:
    return cleaning.standardise(w.clean).groupBy(*LINE_KEYS).agg(F.count("*").alias("copies"))


def _risk(w: Workspace) -> DataFrame:
    return scoring.tiers(w.label_scores.select("doc_id", "score"), "score")


def _split(w: Workspace) -> DataFrame:
    people = w.features.select("customer_id", features.LABEL)
    return split.stratified_split(people, features.LABEL, "customer_id", stage=w.stage)


def _drift(baseline: DataFrame, current: DataFrame, w: Workspace, columns=None) -> DataFrame:
    return drift.drift_statistics(baseline, current, columns, w.stage).filter("nb >= 5 and nc >= 5").drop("ks")


def _staged(w: Workspace) -> DataFrame:
    root = f"{w.stage.root}/extracts"
    writers.stage_extract(w.raw, root, FULL_BATCH)
    return w.spark.read.parquet(f"{root}/staging")


def _full_source(w: Workspace) -> DataFrame:
    """The whole source as it is found: landed as Parquet and as CSV, read back by preference with its batch id."""
    root = f"{w.stage.root}/full-source"
    writers.land(w.raw, root)
    lines, batch_id = readers.read_full(w.spark, root)
    return lines.withColumn("batch_id", F.lit(batch_id))


def _ingestion_log(w: Workspace) -> DataFrame:
    """Two events, appended one after the other."""
    root = f"{w.stage.root}/ingestion"
    rows = w.raw.count()
    for source in ("retail_raw", "retail_raw_again"):
        writers.log_ingestion(w.spark, root, source, rows, RAW_COLUMNS, datetime.now())
    log = w.spark.read.json(f"{root}/ingestion_log")
    return log.withColumns({"columns": F.concat_ws(",", "columns"), "timestamp": F.col("timestamp").isNotNull()})


def _landed_csv(w: Workspace) -> DataFrame:
    root = f"{w.stage.root}/landed"
    writers.land(w.raw, root)
    return quality.clean_lines(readers.read_batch(w.spark, f"{root}/retail_raw.csv"))


def _with_line_breaks(w: Workspace, multi_line: bool) -> DataFrame:
    """The raw lines, some with a line break in the description, written as CSV and read back."""
    root = f"{w.stage.root}/broken"
    text = F.regexp_replace("Description", "^([^ ]*) ", "$1\n")
    broken = w.raw.withColumn("Description", F.when(F.col("Quantity").endswith("3"), text).otherwise(F.col("Description")))
    writers.land(broken.drop(*SOURCE_COLUMNS), root, "broken")
    return readers.read_batch(w.spark, f"{root}/broken.csv", multi_line=multi_line)


def _quarantined(w: Workspace) -> DataFrame:
    root = f"{w.stage.root}/quarantined"
    for _ in range(2):  # the second write replaces the first
        writers.quarantine(_rejected_by_month(w), root)
    return w.spark.read.parquet(f"{root}/quarantine").drop("logged_at")


def _sample(w: Workspace) -> DataFrame:
    schema = ", ".join(f"{n} {t}" for n, t in column_types("fact_sales").items())
    return w.spark.read.schema(schema).option("header", True).csv(f"{w.loaded}/exports/fact_sales_sample")


def _sql(w: Workspace) -> DataFrame:
    w.register_views()
    return run_sql(
        w.spark,
        "SELECT g.country_name, d.year, COUNT(DISTINCT f.invoice_no) AS orders, SUM(f.total_amount) AS revenue "
        "FROM fact_sales f JOIN dim_geography g ON f.geography_key = g.geography_key "
        "JOIN dim_date d ON f.date_key = d.date_key WHERE f.is_cancelled = FALSE AND g.region = :region "
        "GROUP BY g.country_name, d.year", {"region": "Western Europe"})


def _scaled(w: Workspace) -> DataFrame:
    rows = w.features.join(_split(w).select("customer_id", "split"), "customer_id")
    preprocessor, _ = models.fit_preprocessor(rows.filter("split = 'train'"))
    scaled = models.scaled_numbers(preprocessor, w.features)
    return scaled.select("customer_id", *[F.round(c, 6).alias(c) for c in features.NUMERIC_FEATURES])


def _gradient(w: Workspace) -> DataFrame:
    """Whether each component of the gradient is zero, but for the bound at which the fit may stop."""
    return models.logistic_gradient(w.trained).select("slot", (F.abs("gradient") < GRADIENT_BOUND).alias("optimal"))


def _replayed(w: Workspace) -> DataFrame:
    """Whether each customer's score comes out alike from the model and from its nodes."""
    found = [
        models.replayed_scores(w.trained, name, w.stage.path(f"nodes-{name}")).select(
            F.lit(name).alias("model"), "customer_id", (F.abs(F.col("probability") - F.col("replayed")) < 1e-12).alias("same"))
        for name in ("Random_Forest", "Gradient_Boosting")]
    return found[0].unionAll(found[1])


def _reloaded_agrees(w: Workspace) -> DataFrame:
    """Whether the stored and reloaded model scores each customer as the fitted one."""
    now, again = (m.predict(w.features).select("customer_id", F.struct("churn_prediction", "churn_probability").alias(n))
                  for m, n in ((w.training[0], "now"), (w.reloaded_model, "again")))
    return now.join(again, "customer_id").select("customer_id", (F.col("now") == F.col("again")).alias("same"))


def _reloaded_scores(w: Workspace) -> DataFrame:
    accepted, _ = scoring.validate_scoring_input(w.features)
    return scoring.score_customers(w.reloaded_model, accepted)


QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {
    # sources and batches
    "extract_metadata": lambda w: readers.extract_metadata(w.raw, FULL_BATCH, "retail_raw").withColumn(
        "extraction_timestamp", F.col("extraction_timestamp").isNotNull()),
    "full_source_lines": _full_source,
    "ingestion_log": _ingestion_log,
    "trial_rows": lambda w: readers.limit_rows(w.raw, TRIAL_ROWS).agg(F.count("*").alias("lines")),
    "landing_text": lambda w: writers.landing_text(w.raw),
    "batch_partition_counts": lambda w: batches.batch_counts(w.raw),
    "batch_manifest": lambda w: batches.batch_manifest(w.raw),
    "latest_batch": lambda w: batches.latest_batch(batches.batch_manifest(w.raw)),
    # quality gate
    "dq_clean": lambda w: w.clean,
    "dq_rejected": _rejected,
    "dq_summary": lambda w: quality.summary_of(w.gated, FULL_BATCH),
    "dq_audit": lambda w: quality.rejection_audit(_rejected(w)),
    "quality_scorecard": lambda w: dashboard.quality_scorecard(w.gated, w.transactions),
    "rejection_log": lambda w: writers.rejection_log(w.rejected()).drop("logged_at"),
    "q6_rejection_summary": lambda w: quality.rejections_per_batch(_rejected_by_month(w)),
    "d6_rejections": lambda w: quality.rejections_per_reason(_rejected(w)),
    "etl_audit_row": _audit,
    "etl_run_counts": _run_counts,
    # cleaning
    "transform_clean": lambda w: w.transactions,
    "dedup_lines": _copies,
    # classifications over the data
    "product_category": _categories,
    "geography_region": _regions,
    "rfm_segment_ladder": _segments,
    "risk_tier": _risk,
    # customers
    "customer_modal_country": lambda w: dims.modal_country(w.raw),
    "customer_master": lambda w: dims.build_customer_master(w.raw, w.master),
    # sinks and loads, read back from what was written
    "staged_extract": _staged,
    "landed_csv_clean": _landed_csv,
    "monthly_export": lambda w: batches.read_monthly(w.spark, w.months).drop(BROKEN_RECORD),
    "quarantine_by_month": _quarantined,
    "loaded_row_counts": lambda w: reports.table_row_counts(
        {n: readers.read_table(w.spark, w.loaded, n) for n in WAREHOUSE_TABLES}),
    "d5_audit_trail": lambda w: reports.audit_trail(readers.read_table(w.spark, w.loaded, "etl_audit_log")).drop(
        "audit_id", "extraction_timestamp", "execution_duration_sec"),
    "fact_sales_sample": _sample,
    "incremental_fact_sales": lambda w: readers.read_table(w.spark, w.loaded_by_month, "fact_sales"),
    "incremental_rfm": lambda w: readers.read_table(w.spark, w.loaded_by_month, "mart_customer_rfm"),
    "streamed_lines": lambda w: w.spark.read.parquet(f"{w.loaded_by_stream}/lines"),
    "latest_batch_lines": lambda w: w.spark.read.parquet(f"{w.loaded_latest}/lines"),
    "batch_raw_counts": lambda w: w.spark.read.schema("raw_rows long, batch_id string").parquet(
        f"{w.loaded_by_month}/raw_counts"),
    # a warehouse kept up to date batch by batch
    **{f"upkept_{name}": (lambda w, name=name: w.upkept_table(name)) for name in WAREHOUSE_TABLES},
    "customers_by_month": lambda w: upkeep.customers_between(w.spark, w.upkept, 0, 99991231, "year_month"),
    "customers_in_range": lambda w: upkeep.customers_between(w.spark, w.upkept, 19930315, 19960210),
    "csv_line_breaks": lambda w: quality.clean_lines(_with_line_breaks(w, True)),
    "csv_broken_records": lambda w: quality.summary_of(quality.gate(_with_line_breaks(w, False)), FULL_BATCH),
    "sql_western_europe": _sql,
    # star schema and marts
    **{name: (lambda w, name=name: w.table(name)) for name in WAREHOUSE_TABLES},
    "table_row_counts": lambda w: reports.table_row_counts(_tables(w)),
    "constraint_audit": lambda w: constraints.constraint_audit(
        _tables(w) | {n: readers.read_table(w.spark, w.loaded, n) for n in ("etl_audit_log", "etl_rejection_log")}),
    # business queries
    "q1_monthly_revenue": lambda w: reports.monthly_revenue(w.fact_sales, w.dim_date),
    "q2_top_products": lambda w: reports.top_products(w.fact_sales, w.dim_product),
    "q3_rfm_segments": lambda w: reports.rfm_segments(w.mart_customer_rfm),
    "q4_geo_performance": lambda w: reports.geography_performance(w.fact_sales, w.dim_geography),
    "q5_cohort_retention": lambda w: reports.cohort_retention(w.fact_customer_retention),
    "d1_sales_mart": lambda w: w.sales_view,
    "d2_rfm_profile": lambda w: w.profiles,
    "d3_product_revenue": lambda w: w.products,
    "d4_retention": lambda w: reports.retention_view(w.fact_customer_retention, w.dim_date),
    # dashboard views
    "filter_options": lambda w: dashboard.filter_options(w.sales_view, w.products, w.profiles),
    "dash_filtered_sales": lambda w: dashboard.filter_sales(
        w.sales_view, "Germany", date(1996, 1, 1), date(1997, 12, 31)),
    "kpi_scorecard": lambda w: dashboard.kpi_scorecard(w.sales_view, w.profiles),
    "monthly_trend": lambda w: dashboard.monthly_trend(w.sales_view),
    "day_of_week_revenue": lambda w: dashboard.day_of_week_revenue(w.sales_view),
    "top15_products": lambda w: dashboard.top15_products(w.products),
    "top15_bags": lambda w: dashboard.top15_products(w.products, "Bags & Travel"),
    "category_share": lambda w: dashboard.category_share(w.products),
    "pareto_products": lambda w: dashboard.pareto_products(w.products, w.stage),
    "segment_summary": lambda w: dashboard.segment_summary(w.profiles),
    "rfm_sample": lambda w: dashboard.sample_customers(w.profiles),
    "tier_gender_spend": lambda w: dashboard.tier_gender_spend(w.profiles),
    "device_customers": lambda w: dashboard.device_customers(w.profiles),
    "geo_summary": lambda w: dashboard.geo_summary(w.sales_view),
    "top_export_markets": lambda w: dashboard.top_export_markets(w.sales_view),
    "order_sequence_profile": lambda w: dashboard.order_sequence_profile(w.fact_customer_retention),
    "repeat_latency_hist": lambda w: dashboard.repeat_latency_histogram(w.fact_customer_retention),
    "cohort_value": lambda w: dashboard.cohort_value(w.fact_customer_retention),
    # churn: features, split, evaluation, drift, scoring
    "churn_features": lambda w: w.features,
    "churn_split": _split,
    "split_sizes": lambda w: _split(w).groupBy("split", features.LABEL).agg(F.count("*").alias("n")),
    "eval_metrics": lambda w: evaluation.evaluate(w.label_scores, stage=w.stage),
    "confusion_matrix": lambda w: evaluation.confusion_matrix(
        w.label_scores.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))),
    "roc_curve": lambda w: evaluation.roc_curve(w.label_scores, stage=w.stage),
    "psi": lambda w: drift.psi(*w.event_sides(), "value", w.stage),
    "psi_shifted": lambda w: drift.psi(*w.event_sides(1.5), "value", w.stage),
    "event_drift": lambda w: _drift(*w.event_sides(1.5), w),
    "drift_report": lambda w: _drift(*w.feature_sides, w, features.NUMERIC_FEATURES),
    "drift_alerts": lambda w: drift.feature_drift(*w.feature_sides, features.NUMERIC_FEATURES, w.stage),
    "drift_status": lambda w: dashboard.drift_status(
        drift.feature_drift(*w.feature_sides, features.NUMERIC_FEATURES, w.stage)),
    "scoring_input_validate": lambda w: scoring.check_scoring_input(adapter.scoring_requests(w.features)),
    "scaled_features": _scaled,
    "encoded_categories": lambda w: models.encoded_categories(w.trained),
    "logistic_optimality": _gradient,
    "tree_replay": _replayed,
    "reloaded_model_agrees": _reloaded_agrees,
    "model_comparison": lambda w: w.training[1],
    "model_info": lambda w: models.model_info(w.spark, w.training[0]),
    "churn_scores": lambda w: w.churn_scores,
    "churn_score_totals": lambda w: scoring.score_totals(w.churn_scores),
    "reloaded_model_scores": _reloaded_scores,
}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with other engines."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain(QUERIES[name](workspace(spark, folder)))
