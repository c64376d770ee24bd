"""Reading raw batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.schemas import BROKEN_RECORD, FULL_BATCH, RAW_COLUMNS, column_types, empty_table
from tallybook.sources import versions


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def require_columns(df: DataFrame) -> DataFrame:
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        raise KeyError(f"columns missing from extract: {missing}")
    return df


def read_csv(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool = False, partition: str | None = None
) -> DataFrame:
    """Delivered CSV with a header: text columns, the partition column if there is one, and the text of broken records.

    A record is a line, so that files can be split. A line is broken if it has another number of values than there are columns, or
    ends inside quotes (their number is odd). ``multi_line`` reads quoted line breaks, a file in one task.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, BROKEN_RECORD]])
    options = {"escape": '"', "columnNameOfCorruptRecord": BROKEN_RECORD, "columnPruning": "false"}  # skipped values are not counted
    if multi_line:
        whole = T.StructType([*schema.fields, *([T.StructField(partition, T.StringType())] if partition else [])])
        return spark.read.schema(whole).options(header=True, multiLine=True, **options).csv(path)
    lines = spark.read.schema("value string" + (f", `{partition}` string" if partition else "")).text(path)
    header = lines.filter(F.trim("value") != "").first()
    lines = lines.filter((F.trim("value") != "") & (F.col("value") != (header["value"] if header else "")))
    cut = F.when(F.regexp_count("value", F.lit('"')) % 2 == 1, F.col("value"))
    parsed = lines.withColumn("_line", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), options))
    fields = [F.col(f"_line.{c}").alias(c) for c in columns]
    broken = F.coalesce(F.col(f"_line.{BROKEN_RECORD}"), cut).alias(BROKEN_RECORD)
    return parsed.select(*fields, broken, *([partition] if partition else []))


def read_batch(spark: SparkSession, path: str, with_source: bool = False, multi_line: bool = False) -> DataFrame:
    """Parquet (also a folder of it) or CSV/TXT with a header, by suffix.

    Text columns stay text; the gate parses. ``with_source`` adds file and row so that the first of
    several copies is the first in the file (Parquet only: text files have no row numbers). CSV records cut by a quoted line
    break carry their text in ``_broken_record``, and the gate rejects them, unless ``multi_line`` reads them whole.
    """
    name = path.rstrip("/").lower()
    if name.endswith((".csv", ".txt")):
        # The header decides the columns, so a file with columns in another order reads right.
        columns = spark.read.option("header", True).option("escape", '"').csv(path).columns
        df = read_csv(spark, path, columns, multi_line)
    elif name.endswith(".parquet") or "." not in name.rsplit("/", 1)[-1]:
        df = spark.read.parquet(path)
        if with_source:
            df = df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                           F.col("_metadata.row_index").alias("_source_row"))
    else:
        raise ValueError(f"unsupported file format: {path}")
    return require_columns(df)


def read_full(spark: SparkSession, folder: str, name: str = "retail_raw") -> tuple[DataFrame, str]:
    """The whole raw set (Parquet preferred over CSV) and its batch id."""
    for suffix in ("parquet", "csv"):
        path = f"{folder.rstrip('/')}/{name}.{suffix}"
        if path_exists(spark, path):
            return read_batch(spark, path), FULL_BATCH
    raise FileNotFoundError(f"no {name}.parquet or {name}.csv in {folder}")


def limit_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """Trial runs on the first rows only; no limit by default."""
    return df.limit(limit) if limit and limit > 0 else df


def extract_metadata(df: DataFrame, batch_id: str, source: str) -> DataFrame:
    """One row describing an extract."""
    return df.agg(F.count("*").alias("raw_row_count")).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(source.rstrip("/").rsplit("/", 1)[-1]).alias("source_file"),
        F.current_timestamp().cast("timestamp_ntz").alias("extraction_timestamp"),
        "raw_row_count",
        F.lit(",".join(RAW_COLUMNS)).alias("raw_columns"),
        F.lit(len(RAW_COLUMNS)).alias("raw_column_count"),
        F.lit("EXTRACTED").alias("status"),
    )


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A warehouse table as last published (logs: as stored), empty with the declared columns when it was never loaded."""
    version = versions.current(spark, root)
    if table in version.folders:
        return versions.read(spark, root, table, column_types(table), version)
    path = f"{root.rstrip('/')}/{table}"
    return spark.read.parquet(path) if path_exists(spark, path) else empty_table(spark, table)
