"""Writing staging extracts, quarantine, warehouse tables, logs and samples."""

from __future__ import annotations

import secrets
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.schemas import PARTITION_KEYS, RAW_COLUMNS, TABLES, UNIQUE_COLUMNS, conform
from tallybook.sources import versions
from tallybook.staging import freeing

SAMPLE_ROWS = 100
#: Lines of a compressed file, which one task must read whole.
FILE_ROWS = 1_000_000
_LOG_NAMES = {
    "InvoiceNo": "invoice_no", "StockCode": "stock_code", "Quantity": "quantity", "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
}


def overwrite_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Replace only the partitions present in ``df``, so loading a batch again changes nothing else.

    Rebalancing gives each partition few files, and still several tasks to one holding most rows.
    """
    writer = df.hint("rebalance", *[F.col(k) for k in keys]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with freeing(df.sparkSession):
        writer.partitionBy(*keys).parquet(path)


def replace_partitions(df: DataFrame, path: str, key: str, values: Sequence[str], source: DataFrame | None = None) -> None:
    """Replace the partitions of all ``values``; those without rows in ``df`` end up empty.

    ``source`` is a stored table with rows of the same keys as ``df``, if looking there takes less.
    """
    overwrite_partitions(df, path, key)
    spark = df.sparkSession
    now = {r[0] for r in (source or df).select(key).distinct().collect()}  # batches of one delivery
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for value in set(values) - now:
        stale = jvm.org.apache.hadoop.fs.Path(f"{path}/{key}={value}")
        stale.getFileSystem(conf).delete(stale, True)


def write_csv(df: DataFrame, path: str, *keys: str, compressed: bool = False) -> None:
    """CSV with a header. Blanks around values survive; empty text reads back as missing. Files can be gzip ones of few lines each."""
    kind = {"compression": "gzip", "maxRecordsPerFile": FILE_ROWS} if compressed else {}
    writer = df.write.options(**kind).mode("overwrite").option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    with freeing(df.sparkSession):
        (writer.partitionBy(*keys) if keys else writer).csv(path)


def stage_extract(raw: DataFrame, root: str, batch_id: str) -> None:
    overwrite_partitions(raw.withColumn("batch_id", F.lit(batch_id)), f"{root}/staging", "batch_id")


def landing_text(raw: DataFrame) -> DataFrame:
    """Keys as text, missing descriptions and countries as empty text."""
    text = {c: F.col(c).cast("string") for c in ("InvoiceNo", "StockCode")}
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("Description", "Country")}
    return raw.select(*[{**text, **filled}.get(c, F.col(c)).alias(c) for c in RAW_COLUMNS])


def land(raw: DataFrame, root: str, name: str = "retail_raw") -> None:
    """Store the normalised raw set as Parquet and as CSV."""
    lines = landing_text(raw)
    lines.write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    write_csv(lines, f"{root}/{name}.csv")


def log_ingestion(spark: SparkSession, root: str, source: str, rows: int, columns: list[str], at: datetime) -> None:
    """Append one ingestion event."""
    event = spark.createDataFrame(
        [("DATASET_INGESTION", source, rows, len(columns), columns, at.isoformat(), "SUCCESS")],
        "event string, source string, row_count bigint, column_count int, columns array<string>, "
        "timestamp string, status string")
    event.coalesce(1).write.mode("append").json(f"{root}/ingestion_log")


def quarantine(rejected: DataFrame, root: str) -> None:
    overwrite_partitions(rejected, f"{root}/quarantine", "batch_id")


def rejection_log(rejected: DataFrame, rows: int | None = None) -> DataFrame:
    """The rejected lines under the log's column names; ``rows`` keeps only the first ones."""
    order = [F.col(c) for c in ("batch_id", "rejection_reason", "InvoiceNo", "StockCode", "Quantity", "UnitPrice",
                                "CustomerID")]
    first = (rejected if rows is None else rejected.orderBy(*order).limit(rows)).withColumnsRenamed(_LOG_NAMES)
    wanted = [c for c in TABLES["etl_rejection_log"] if c in first.columns]
    return first.select(*wanted).withColumn("logged_at", F.col("logged_at").try_cast("timestamp_ntz"))


def write_table(df: DataFrame, root: str, table: str, keep_if_empty: bool = False) -> int:
    """Replace a warehouse table, empty or not, and return its rows; ``keep_if_empty`` leaves the old one for no rows.

    The rows are written beside the old ones, which readers see until the new version is published.
    """
    if keep_if_empty and df.isEmpty():
        return 0
    spark = df.sparkSession
    base = versions.current(spark, root)
    folders, rows = versions.write(conform(df, table), root, table, versions.new_load(), PARTITION_KEYS.get(table))
    versions.publish(spark, root, base, {table: folders})
    return rows


def audit_row(
    spark: SparkSession, batch_id: str, source: str, at: datetime, raw: int, cleaned: int, rejected: int,
    seconds: float, sales: int, profiles: int,
) -> DataFrame:
    notes = f"Successfully loaded {sales} sales and {profiles} customer RFM profiles."
    number = int(at.timestamp() * 1_000_000) << 10 | secrets.randbits(10)  # loads of one microsecond still differ
    row = (number, batch_id, source, at.isoformat(sep=" "), raw, cleaned, rejected, "COMPLETED",
           str(round(seconds, 2)), notes)
    names = list(TABLES["etl_audit_log"])
    kinds = ["bigint", "string", "string", "string", "bigint", "bigint", "bigint", "string", "string", "string"]
    ddl = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    return conform(spark.createDataFrame([row], ddl), "etl_audit_log")


def append_log(df: DataFrame, root: str, table: str) -> None:
    df.write.mode("append").parquet(f"{root.rstrip('/')}/{table}")


def export_samples(tables: dict[str, DataFrame], root: str, rows: int = SAMPLE_ROWS) -> None:
    """First rows of every filled table by primary key, as one CSV file each.

    Facts are numbered from 1, so a bound on the number reaches the scan.
    """
    for name, df in tables.items():
        key = UNIQUE_COLUMNS[name][0]
        first = df.filter(F.col(key) <= rows) if name.startswith("fact_") else df
        sample = first.orderBy(key).limit(rows)
        if not sample.isEmpty():
            write_csv(sample.coalesce(1), f"{root}/exports/{name}_sample")
