"""Session settings for local runs; a cluster brings its own session."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallybook")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Hundreds of generated classes and column objects per load: keep the former, do not trace the latter.
        .config("spark.sql.codegen.cache.maxEntries", "5000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apart(spark: SparkSession) -> SparkSession:
    """A session of its own with the settings that ``spark`` has now; ``newSession`` alone drops those made while it ran.

    Settings of the context, which a later ``getOrCreate`` can leave in a session, stay behind: no session can set them, and the
    context is the same.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.get(key, None) != value:
            try:
                own.conf.set(key, value)
            except AnalysisException as refused:
                if refused.getCondition() not in ("CANNOT_MODIFY_CONFIG", "CANNOT_MODIFY_STATIC_CONFIG"):
                    raise
    return own
