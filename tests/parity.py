"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_cell(r[i]) for i in order] for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences, empty when both agree."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    kinds = {d[0]: str(d[1]) for d in theirs.description}
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for f in df.schema.fields:
        want = KINDS.get(f.dataType.simpleString(), f.dataType.simpleString())
        if want != kinds[f.name]:
            found.append(f"type of {f.name}: {want} vs {kinds[f.name]}")
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    expected = _rows(names, theirs.fetchall())
    if len(ours) != len(expected):
        found.append(f"rows {len(ours)} vs {len(expected)}")
    bad = [(a, b) for a, b in zip(ours, expected) if a != b]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[0][0]} vs {bad[0][1]} (columns {sorted(names)})")
    return found
