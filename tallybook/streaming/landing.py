"""Monthly batches arriving in a landing folder, loaded by a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallybook.plans.etl import load_batches
from tallybook.schemas import RAW_COLUMNS
from tallybook.sources.batches import read_monthly


def load_arriving_batches(
    spark: SparkSession, folder: str, root: str, checkpoint: str, files_per_trigger: int | None = None,
    multi_line: bool = False,
) -> StreamingQuery:
    """Load what is new below ``folder/batches`` and stop.

    New files only say which months changed. Those months are read whole from the landing folder and
    replace their partitions, so a month arriving in pieces, or a repeated trigger, stays correct.
    """
    reader = spark.readStream.schema(", ".join(f"{c} string" for c in [*RAW_COLUMNS, "batch_id"]))
    reader = reader.option("header", True).option("escape", '"')
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    arriving = reader.csv(f"{folder}/batches")

    def load(new: DataFrame, _: int) -> None:
        months = [r[0] for r in new.select("batch_id").distinct().collect()]  # months in one trigger
        if months:
            load_batches(spark, read_monthly(spark, folder, months, multi_line), root)

    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
