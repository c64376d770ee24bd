"""Shared scratch folder for tables written once and read many times.

Written tables cut lineage and survive the loss of executors. The folder is the one the
session names in ``spark.checkpoint.dir``; only a local session without one gets its own.
"""

from __future__ import annotations

import itertools
import re
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_lock = threading.Lock()
_FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Threads inside ``freeing`` and the setting before the first of them, by session.
_inside: dict[str, tuple[int, str | None]] = {}


def shared_folder(spark: SparkSession) -> str:
    with _lock:
        folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if folder:
            return folder
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # local-cluster is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tallybook-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that begins inside go when it ends, not when the driver happens to collect its garbage.

    A write has a plan of its own, so nothing else reads them. The setting is the session's; it is as before once no thread is inside.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        threads, before = _inside.get(session) or (0, spark.conf.get(_FREEING, None))
        _inside[session] = threads + 1, before
        spark.conf.set(_FREEING, "true")
    try:
        yield
    finally:
        with _lock:
            threads, before = _inside.pop(session)
            if threads > 1:
                _inside[session] = threads - 1, before
            elif before is None:
                spark.conf.unset(_FREEING)
            else:
                spark.conf.set(_FREEING, before)


class Stage:
    """Writes intermediate tables below one run-specific folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_folder(spark).rstrip('/')}/tallybook-{uuid.uuid4().hex}"
        self._names = itertools.count()

    def path(self, name: str) -> str:
        """A path that nothing was written to."""
        return f"{self.root}/{next(self._names):03d}-{name}"

    def table(self, df: DataFrame | Iterable[DataFrame], name: str, reader: SparkSession | None = None) -> DataFrame:
        """``df`` as written, read by ``reader``, or by the session of the stage.

        Several frames of one schema are written one after the other, so that shuffle files of only one exist at a time.
        """
        path = self.path(name)
        for one in [df] if isinstance(df, DataFrame) else df:
            schema = one.schema
            with freeing(one.sparkSession):
                one.write.mode("append").parquet(path)
        return (reader or self.spark).read.schema(schema).parquet(path)

    @contextmanager
    def passing(self) -> Iterator[Stage]:
        """A stage below this one whose tables go at the end, for what nothing reads later."""
        inner = Stage(self.spark, f"{self.root}/passing-{uuid.uuid4().hex}")
        try:
            yield inner
        finally:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(inner.root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_of(df: DataFrame, stage: Stage | None) -> Stage:
    return stage or Stage(df.sparkSession)
