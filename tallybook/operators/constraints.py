"""Audit of the declared constraints: not null, unique, foreign key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.schemas import FOREIGN_KEYS, UNIQUE_COLUMNS, required_columns


def _line(df: DataFrame, table: str, kind: str, column: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("constraint_type"), F.lit(column).alias("column_name"),
        F.col("violations").cast("bigint").alias("violations"))


def not_null_audit(df: DataFrame, table: str) -> DataFrame:
    """All required columns of a table in one scan."""
    columns = required_columns(table)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column_name", "violations")
    return long.select(
        F.lit(table).alias("table_name"), F.lit("not_null").alias("constraint_type"), "column_name",
        F.col("violations").cast("bigint").alias("violations"))


def unique_audit(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows beyond the first of each value; the values count before they are compared."""
    extra = df.filter(F.col(column).isNotNull()).groupBy(column).agg((F.count("*") - 1).alias("extra"))
    return _line(extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations")), table, "unique", column)


def foreign_key_audit(df: DataFrame, table: str, column: str, parent: DataFrame) -> DataFrame:
    """Rows without a parent. References collapse to counts first, so a hot one is a single row."""
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    orphans = used.join(parent.select(column), column, "left_anti")
    return _line(orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")), table, "foreign_key", column)


def constraint_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """One line per declared constraint of the given tables."""
    lines = [not_null_audit(df, n) for n, df in tables.items()]
    lines += [unique_audit(df, n, c) for n, df in tables.items() for c in UNIQUE_COLUMNS[n]]
    lines += [
        foreign_key_audit(tables[t], t, c, tables[parent])
        for t, c, parent in FOREIGN_KEYS if t in tables and parent in tables]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionAll(line)
    return out
