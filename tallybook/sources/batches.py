"""Monthly batches of raw lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.coerce import to_moment
from tallybook.schemas import RAW_SCHEMA
from tallybook.sources.readers import read_csv
from tallybook.sources.writers import write_csv


def batch_of(moment: Column | str = "InvoiceDate") -> Column:
    return F.concat(F.lit("batch_"), F.date_format(to_moment(moment), "yyyy_MM"))


def monthly(raw: DataFrame) -> DataFrame:
    """Raw lines with their batch; lines without a readable date belong to none and are left out."""
    return raw.withColumn("batch_id", batch_of()).filter("batch_id is not null")


def batch_counts(raw: DataFrame) -> DataFrame:
    return monthly(raw).groupBy("batch_id").agg(F.count("*").alias("row_count"))


def batch_manifest(raw: DataFrame) -> DataFrame:
    """Period, rows and date range of every batch."""
    moment = to_moment("InvoiceDate")
    grouped = monthly(raw).groupBy("batch_id").agg(
        F.count("*").alias("row_count"),
        F.min(moment).cast("string").alias("min_invoice_date"),
        F.max(moment).cast("string").alias("max_invoice_date"),
    )
    month = F.substring("batch_id", 7, 7)
    return grouped.select(
        "batch_id",
        F.replace(month, F.lit("_"), F.lit("-")).alias("period"),
        F.concat(F.lit("orders_"), month, F.lit(".csv")).alias("filename"),
        "row_count",
        "min_invoice_date",
        "max_invoice_date",
        F.lit("READY_FOR_INGESTION").alias("status"),
    )


def latest_batch(manifest: DataFrame) -> DataFrame:
    return manifest.orderBy(F.desc("batch_id")).limit(1)


def export_monthly(raw: DataFrame, folder: str) -> DataFrame:
    """Write one folder of compressed CSV files per month plus the manifest, and return the manifest as stored.

    Rebalanced by month: few files per month, and several tasks for a month holding most rows.
    """
    spark = raw.sparkSession
    lines = monthly(raw).withColumn("InvoiceDate", to_moment("InvoiceDate").cast("string"))
    lines = lines.hint("rebalance", F.col("batch_id"))
    write_csv(lines, f"{folder}/batches", "batch_id", compressed=True)
    batch_manifest(raw).write.mode("overwrite").json(f"{folder}/manifest")
    return spark.read.json(f"{folder}/manifest")


def read_monthly(
    spark: SparkSession, folder: str, batch_ids: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """Exported batches; a list of ids prunes to their folders. Broken records are marked as in ``read_batch``."""
    df = read_csv(spark, f"{folder}/batches", [f.name for f in RAW_SCHEMA.fields], multi_line, "batch_id")
    return df if batch_ids is None else df.filter(F.col("batch_id").isin(batch_ids))
