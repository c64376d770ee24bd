"""End-to-end loads: everything at once, or month by month."""

from __future__ import annotations

import secrets
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators import quality
from tallybook.operators.cleaning import clean_and_transform
from tallybook.operators.ordering import turns_of
from tallybook.plans import upkeep
from tallybook.plans.warehouse import Warehouse
from tallybook.schemas import FULL_BATCH, PARTITION_KEYS, WAREHOUSE_TABLES, conform
from tallybook.sources import versions, writers
from tallybook.sources.batches import latest_batch, read_monthly
from tallybook.sources.readers import limit_rows, read_table
from tallybook.staging import Stage, stage_of


def _load(wh: Warehouse, root: str) -> dict[str, int]:
    """Write the eight tables of a built warehouse beside the old ones, then switch to all of them at once."""
    base, load = versions.current(wh.spark, root), versions.new_load()
    with ThreadPoolExecutor(len(WAREHOUSE_TABLES)) as pool:
        written = dict(zip(WAREHOUSE_TABLES, pool.map(
            lambda n: versions.write(wh.table(n), root, n, load, PARTITION_KEYS.get(n)), WAREHOUSE_TABLES)))
    # What earlier batch loads kept does not belong to these tables.
    changed = {n: [] for n in upkeep.STATE} | {n: folders for n, (folders, _) in written.items()}
    versions.publish(wh.spark, root, base, changed)
    return {n: rows for n, (_, rows) in written.items()}


def _log(
    spark: SparkSession, root: str, batch_id: str, source: str, started: float, raw: int, rejected: int, counts: dict[str, int]
) -> None:
    """The audit row and the samples of a finished load."""
    at = datetime.now(timezone.utc).replace(tzinfo=None)
    audit = writers.audit_row(
        spark, batch_id, source, at, raw, counts["fact_sales"], rejected, time.time() - started, counts["fact_sales"],
        counts["mart_customer_rfm"])
    writers.append_log(audit, root, "etl_audit_log")
    writers.export_samples({n: read_table(spark, root, n) for n in WAREHOUSE_TABLES}, root)


def run_full(
    spark: SparkSession,
    raw: DataFrame,
    master: DataFrame | None,
    root: str,
    source: str = "retail_raw",
    limit: int | None = None,
    stage: Stage | None = None,
) -> dict:
    """Gate, clean, model and load one complete extract; returns counts and pass rate.

    The source is read once: its lines are gated, counted and stored, clean and rejected ones apart. A row limit makes a trial run.
    """
    started = time.time()
    # What is written on the way is read by this load only; the gated lines only until the clean ones are in order.
    with (stage or Stage(spark)).passing() as passing:
        with passing.passing() as first:
            gated = quality.gate_once(limit_rows(raw, limit), f"{first.root}/gated")
            wh = Warehouse(spark, raw, master, FULL_BATCH, passing, raw_is_stored=True, gated=gated)
            with ThreadPoolExecutor(1) as pool:
                rejected = wh.rejected()
                held = pool.submit(writers.replace_partitions, rejected, f"{root}/quarantine", "batch_id", [FULL_BATCH])
                wh.transactions
                held.result()
        wh.build()
        quarantined = spark.read.schema(rejected.schema).parquet(f"{root}/quarantine").filter(F.col("batch_id") == FULL_BATCH)
        _log_rejects(quarantined, root, [FULL_BATCH])
        counts = _load(wh, root)
    totals = gated.totals
    _log(spark, root, FULL_BATCH, source, started, totals["total_records"], totals["rejected_records"], counts)
    return {
        "status": "SUCCESS",
        "duration_sec": round(time.time() - started, 2),
        "raw_records": totals["total_records"],
        "clean_records": totals["valid_records"],
        "rejected_records": totals["rejected_records"],
        "pass_rate_pct": float(gated.pass_rate_pct),
        "table_counts": counts,
    }


def _log_rejects(quarantined: DataFrame, root: str, batch_ids: Sequence[str]) -> None:
    """Every reject in the log, one partition a batch, replaced when the batch comes again.

    Numbers hold a random mark of this load above the row number, so two loads do not share any.
    """
    log = writers.rejection_log(quarantined)
    number = F.lit(secrets.randbits(20) << 43).bitwiseOR(F.monotonically_increasing_id())
    log = conform(log.withColumn("rejection_id", number), "etl_rejection_log")
    writers.replace_partitions(log, f"{root.rstrip('/')}/etl_rejection_log", "batch_id", batch_ids)


def load_batches(
    spark: SparkSession, batches: DataFrame, root: str, batch_ids: Sequence[str] | None = None,
    stage: Stage | None = None,
) -> list[str]:
    """Gate and clean delivered batches into ``lines`` and ``quarantine``, both partitioned by delivered batch.

    Each delivered batch replaces its own partitions and no others, also when it has no rejects or nothing else, so
    repeating or reordering batches changes nothing and a late line of an older month takes nothing away.
    The delivered files are read once; ``raw_counts`` keeps the raw lines of each batch, so that no later load counts
    old files again. Returns the ids of the delivered batches.
    """
    wanted = batches if batch_ids is None else batches.filter(F.col("batch_id").isin(list(batch_ids)))
    with stage_of(wanted, stage).passing() as passing:
        gated = passing.table(quality.gate(wanted), "delivered")
        counted = gated.groupBy("batch_id").agg(F.count("*").alias("raw_rows"))
        raw_rows = dict(map(tuple, counted.select("batch_id", "raw_rows").collect()))  # one line per batch
        delivered = sorted({*(batch_ids or ()), *raw_rows})
        if not delivered:
            return []
        writers.replace_partitions(counted, f"{root}/raw_counts", "batch_id", delivered)
        now = F.current_timestamp().cast("timestamp_ntz")
        rejected = quality.rejected_of(gated, F.col("batch_id"), now)
        writers.replace_partitions(rejected, f"{root}/quarantine", "batch_id", delivered)
        clean = gated.filter(F.col(quality.REASON).isNull()).drop(quality.REASON)
        turns = turns_of((i, raw_rows.get(i, 0)) for i in delivered)
        for ids in turns:  # one after the other, so that shuffle files of few batches exist at a time
            some = clean if len(turns) == 1 else clean.filter(F.col("batch_id").isin(ids))
            writers.replace_partitions(clean_and_transform(some), f"{root}/lines", "batch_id", ids, some)
    held = spark.read.schema(rejected.schema).parquet(f"{root}/quarantine").filter(F.col("batch_id").isin(delivered))
    _log_rejects(held, root, delivered)
    return delivered


def _batches_log(spark: SparkSession, root: str, started: float, counts: dict[str, int]) -> None:
    rejected = spark.read.schema("batch_id string").parquet(f"{root}/quarantine").count()
    raw = spark.read.schema("raw_rows long, batch_id string").parquet(f"{root}/raw_counts").agg(F.sum("raw_rows")).first()[0]
    _log(spark, root, "incremental", "batches", started, raw or 0, rejected, counts)


def rebuild(
    spark: SparkSession,
    master: DataFrame | None,
    root: str,
    stage: Stage | None = None,
) -> dict:
    """Recompute all dimensions, facts and marts from the loaded lines of every batch; the first batch of a line counts."""
    started = time.time()
    counts = upkeep.build(spark, root, master, stage)
    _batches_log(spark, root, started, counts)
    return counts


def run_incremental(
    spark: SparkSession,
    batches: DataFrame,
    master: DataFrame | None,
    root: str,
    batch_ids: Sequence[str] | None = None,
    stage: Stage | None = None,
) -> dict:
    """Load batches (all of them, or the named ones) and bring the tables up to date.

    New batches are added at their own cost; one that was loaded before makes the tables be built from all loaded lines.
    """
    started = time.time()
    delivered = load_batches(spark, batches, root, batch_ids, stage)
    counts = upkeep.refresh(spark, root, delivered, master, stage)
    _batches_log(spark, root, started, counts)
    return counts


def run_latest(
    spark: SparkSession, folder: str, master: DataFrame | None, root: str, stage: Stage | None = None
) -> dict | None:
    """Load the newest batch that the manifest in ``folder`` names, reading its files only, and add it to the tables.

    An empty manifest loads nothing and gives None.
    """
    newest = latest_batch(spark.read.json(f"{folder}/manifest")).first()
    if newest is None:
        return None
    ids = [newest["batch_id"]]
    return run_incremental(spark, read_monthly(spark, folder, ids), master, root, ids, stage)
