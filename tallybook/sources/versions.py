"""Tables that change as a whole: a load writes beside what is there, then one small file switches to it.

The files of a load lie below ``<table>/load=<id>``, fact and mart partitions below that. A version is a file in ``_published`` that
names, for every table, the folders it consists of; readers take the newest version. A load that dies before it publishes leaves
folders that nobody reads, and a load may keep folders of earlier ones, so adding a batch does not copy the others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybook.staging import freeing

_PUBLISHED = "_published"


class Version(NamedTuple):
    """Number and folders (below the table's own) of a published version; number 0 holds nothing."""

    number: int
    folders: dict[str, list[str]]


class LoadConflict(RuntimeError):
    """Another load published while this one was running."""


def _at(spark: SparkSession, path: str):
    """A path and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    hadoop, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def new_load() -> str:
    return uuid.uuid4().hex


def current(spark: SparkSession, root: str) -> Version:
    folder = f"{root.rstrip('/')}/{_PUBLISHED}"
    names = [n for n in _names(spark, folder) if n.endswith(".json") and n[0].isdigit()]
    if not names:
        return Version(0, {})
    text = spark.read.text(f"{folder}/{names[-1]}", wholetext=True).first()[0]
    return Version(int(names[-1].split(".")[0]), json.loads(text))


def publish(spark: SparkSession, root: str, base: Version, changed: dict[str, list[str]]) -> Version:
    """Switch to ``base`` with the folders of ``changed`` tables; fails if ``base`` is no longer the newest version."""
    made = Version(base.number + 1, base.folders | changed)
    folder = f"{root.rstrip('/')}/{_PUBLISHED}"
    target, fs = _at(spark, f"{folder}/{made.number:08d}.json")
    written, _ = _at(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = fs.create(written, False)
    out.write(json.dumps(made.folders).encode())
    out.close()
    jvm = spark._jvm
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:  # fails if the target exists
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(written), fs.makeQualified(target), none)
    except Exception as error:
        fs.delete(written, False)
        if fs.exists(target):
            raise LoadConflict(f"version {made.number} of {root} was published by another load") from error
        raise
    return made


def write(
    df: DataFrame | Iterable[DataFrame], root: str, table: str, load: str, key: str | None = None
) -> tuple[list[str], int]:
    """Write rows beside the table's others; the folders they are in, and their number (observed while they are written).

    Several frames are written one after the other.
    """
    path, total = f"{root.rstrip('/')}/{table}/load={load}", 0
    for one in [df] if isinstance(df, DataFrame) else df:
        spark, rows = one.sparkSession, Observation()
        writer = one.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("append")
        with freeing(spark):
            (writer.partitionBy(key) if key else writer).parquet(path)
        total += rows.get["n"]
    if not key:
        return [f"load={load}"], total
    return [f"load={load}/{n}" for n in _names(spark, path) if n.startswith(f"{key}=")], total


def read(spark: SparkSession, root: str, table: str, columns: dict[str, str], version: Version | None = None) -> DataFrame:
    """A table as of a version (the newest one), with the given columns and types; empty if the version has no such table."""
    version = version or current(spark, root)
    ddl = ", ".join(f"`{n}` {t}" for n, t in columns.items())
    folders = version.folders.get(table)
    if not folders:
        return spark.createDataFrame([], ddl)
    base = f"{root.rstrip('/')}/{table}"
    found = spark.read.schema(f"{ddl}, load string").option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
    return found.select(*columns)


def remove_unread(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the load folders that none of the last ``keep`` versions names, and older versions; call it when no load runs."""
    folder = f"{root.rstrip('/')}/{_PUBLISHED}"
    names = [n for n in _names(spark, folder) if n.endswith(".json") and n[0].isdigit()]
    held, tables = set(), set()
    for name in names[-keep:]:
        folders = json.loads(spark.read.text(f"{folder}/{name}", wholetext=True).first()[0])
        held |= {(t, f.split("/")[0]) for t, fs in folders.items() for f in fs}
        tables |= set(folders)
    gone = [f"{folder}/{n}" for n in names[:-keep]]
    gone += [f"{root.rstrip('/')}/{t}/{n}" for t in tables for n in _names(spark, f"{root.rstrip('/')}/{t}")
             if n.startswith("load=") and (t, n) not in held]
    for path in gone:
        hadoop, fs = _at(spark, path)
        fs.delete(hadoop, True)
    return len(gone)
