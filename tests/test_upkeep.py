"""Batches added at their own cost, and tables that switch from version to version."""

import json
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tallybook.plans import etl, upkeep
from tallybook.schemas import RAW_COLUMNS, UNIQUE_COLUMNS, WAREHOUSE_TABLES
from tallybook.sources import adapter, batches, readers, versions, writers

SCHEMA = ", ".join(f"{c} string" for c in [*RAW_COLUMNS, "batch_id"])


@pytest.fixture(scope="module")
def master(spark, tiny):
    return adapter.retail_master(spark, tiny)


@pytest.fixture(scope="module")
def months(spark, tiny, tmp_path_factory):
    """A year and a half of months as delivered, and their ids."""
    folder = str(tmp_path_factory.mktemp("months"))
    batches.export_monthly(adapter.retail_raw(spark, tiny), folder)
    ids = sorted(r[0] for r in spark.read.json(f"{folder}/manifest").select("batch_id").collect())[-18:]
    return folder, ids


def tables(spark, root):
    return {n: readers.read_table(spark, root, n) for n in WAREHOUSE_TABLES}


def same(spark, root, other):
    a, b = tables(spark, root), tables(spark, other)
    assert {r["table_name"]: r["rows"] for r in upkeep.differences(a, b).collect()} == dict.fromkeys(upkeep.NATURAL, 0)
    for name, df in a.items():
        for key in UNIQUE_COLUMNS[name]:
            assert df.count() == df.select(key).distinct().count(), (name, key)


def load(spark, months, master, root, ids):
    return etl.run_incremental(spark, batches.read_monthly(spark, months[0], ids), master, root, ids)


@pytest.fixture(scope="module")
def grown(spark, months, master, tmp_path_factory):
    """Sixteen months in one load."""
    root = str(tmp_path_factory.mktemp("grown"))
    load(spark, months, master, root, months[1][:16])
    return root


def spoil(folder):
    """Make every data file below a folder unreadable."""
    files = [p for p in Path(folder).rglob("*.parquet") if p.is_file()]
    assert files
    for p in files:
        p.write_bytes(b"gone")
        crc = p.with_name(f".{p.name}.crc")
        if crc.exists():
            crc.unlink()


def test_a_month_reads_only_that_month(spark, months, master, grown, tmp_path):
    """Lines and facts of all other months can be gone: the load does not touch them."""
    ids = months[1]
    root = f"{tmp_path}/warehouse"
    shutil.copytree(grown, root)
    spoil(f"{root}/lines")
    for table in ("fact_sales", "orders", "sold_invoices", "mart_sales_performance"):
        spoil(f"{root}/{table}")
    stage_rows = upkeep.refresh  # the samples of the load log read the fact, so the steps are called one by one
    etl.load_batches(spark, batches.read_monthly(spark, months[0], ids[16:17]), root, ids[16:17])
    base = versions.current(spark, root)
    with pytest.raises(Exception, match="Parquet|parquet|gone|magic"):
        readers.read_table(spark, root, "fact_sales").agg(F.sum("quantity")).collect()
    # Counting the result reads footers of old files, hence the error comes only after the switch.
    with pytest.raises(Exception, match="Parquet|parquet|magic"):
        stage_rows(spark, root, ids[16:17], master)
    made = versions.current(spark, root)
    assert made.number == base.number + 1
    added = [f for f in made.folders["fact_sales"] if f not in base.folders["fact_sales"]]
    assert [f.rsplit("=", 1)[-1] for f in added] == ids[16:17]
    assert set(base.folders["fact_sales"]) < set(made.folders["fact_sales"])


def test_months_one_by_one_equal_one_load(spark, months, master, grown, tmp_path):
    root, whole = f"{tmp_path}/warehouse", f"{tmp_path}/whole"
    shutil.copytree(grown, root)
    for i in months[1][16:]:
        load(spark, months, master, root, [i])
    load(spark, months, master, whole, months[1])
    same(spark, root, whole)
    assert versions.current(spark, root).number == 3 and versions.current(spark, whole).number == 1
    keys = readers.read_table(spark, root, "fact_sales").agg(F.min("sales_key"), F.max("sales_key"), F.count("*")).first()
    assert keys[0] == 1 and keys[1] == keys[2]
    fact = readers.read_table(spark, root, "fact_sales")
    plan = fact.filter(F.col("batch_id") == months[1][3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    last = spark.read.parquet(f"{root}/raw_counts").select("batch_id", "raw_rows").filter("raw_rows > 0")
    pruned = fact.join(last.filter(F.col("batch_id") > months[1][15]), "batch_id")
    assert "dynamicpruning" in pruned._jdf.queryExecution().executedPlan().toString()


def line(invoice, code, moment, quantity="2", customer="17", price="1.50", country="France"):
    return (invoice, code, f"THING {code}", quantity, moment, price, customer, country)


def deliver(spark, root, batch_id, rows):
    df = spark.createDataFrame([(*r, batch_id) for r in rows], SCHEMA)
    return etl.run_incremental(spark, df, None, root, [batch_id])


LATE = [
    [("b1", [line("1", "A", "2011-01-05 10:00:00"), line("2", "B", "2011-01-06 10:00:00", customer="18"),
             line("3", "A", "2011-02-01 09:00:00"), line("9", "A", "2011-01-05 10:00:00", customer=None)]),
     # A copy of an old line, another line of an old invoice, a late order, a new country and product, a cancellation.
     ("b2", [line("1", "A", "2011-01-05 10:00:00"), line("1", "C", "2011-01-05 10:00:00"), line("4", "B", "2011-01-01 08:00:00"),
             line("5", "D", "2011-03-01 08:00:00", customer="20", country="Spain"), line("C6", "A", "2011-03-02 08:00:00", "-1"),
             line("7", "A", "2011-01-05 11:00:00", price="3.50", customer="18")]),
     ("b3", [line("8", "A", "2011-04-01 08:00:00", "-3"), line("8", "B", "not a date")]),  # all rejected
     ("b4", [line("10", "E", "2011-02-01 09:00:00", customer="18"), line("11", "A", "2011-05-01 09:00:00")])],
]


@pytest.mark.parametrize("story", LATE)
def test_late_lines(spark, tmp_path, story):
    root, whole = f"{tmp_path}/a", f"{tmp_path}/b"
    for batch_id, rows in story:
        deliver(spark, root, batch_id, rows)
        shutil.rmtree(whole, ignore_errors=True)
        for n in ("lines", "quarantine", "raw_counts"):
            shutil.copytree(f"{root}/{n}", f"{whole}/{n}")
        etl.rebuild(spark, None, whole)
        same(spark, root, whole)
    fact = readers.read_table(spark, root, "fact_sales")
    assert fact.filter("invoice_no = '1'").count() == 2
    rfm = {r["customer_id"]: r["frequency"] for r in readers.read_table(spark, root, "mart_customer_rfm").collect()}
    assert rfm == {17: 4, 18: 3, 20: 1}


def test_earlier_and_repeated_batches_are_built_anew(spark, tmp_path):
    root = str(tmp_path)
    deliver(spark, root, "b2", [line("1", "A", "2011-01-05 10:00:00"), line("2", "B", "2011-01-05 10:00:00")])
    # An earlier id with a copy: its line counts first.
    deliver(spark, root, "b1", [line("1", "A", "2011-01-05 10:00:00")])
    fact = readers.read_table(spark, root, "fact_sales")
    assert {(r["invoice_no"], r["batch_id"]) for r in fact.collect()} == {("1", "b1"), ("2", "b2")}
    deliver(spark, root, "b2", [line("3", "B", "2011-01-05 10:00:00")])
    fact = readers.read_table(spark, root, "fact_sales")
    assert {(r["invoice_no"], r["batch_id"]) for r in fact.collect()} == {("1", "b1"), ("3", "b2")}


@pytest.mark.parametrize("dies_at", ["customer_keys", "mart_customer_rfm", "publish"])
def test_a_load_that_dies_changes_nothing(spark, tmp_path, monkeypatch, dies_at):
    root = str(tmp_path)
    deliver(spark, root, "b1", LATE[0][0][1])
    before = {n: sorted(map(tuple, t.collect()), key=repr) for n, t in tables(spark, root).items()}
    write, publish = versions.write, versions.publish

    def dying_write(df, root, table, load, key=None):
        if table == dies_at:
            raise RuntimeError("killed")
        return write(df, root, table, load, key)

    def dying_publish(*args):
        if dies_at == "publish":
            raise RuntimeError("killed")
        return publish(*args)

    with monkeypatch.context() as m:
        m.setattr(versions, "write", dying_write)
        m.setattr(versions, "publish", dying_publish)
        with pytest.raises(RuntimeError, match="killed"):
            deliver(spark, root, "b2", LATE[0][1][1])
    assert {n: sorted(map(tuple, t.collect()), key=repr) for n, t in tables(spark, root).items()} == before
    deliver(spark, root, "b2", LATE[0][1][1])
    assert readers.read_table(spark, root, "fact_sales").count() == 9
    folders = len(os.listdir(f"{root}/dim_customer"))
    assert versions.remove_unread(spark, root, 1) > 0 and len(os.listdir(f"{root}/dim_customer")) < folders
    assert readers.read_table(spark, root, "fact_sales").count() == 9


def test_overwrite_of_one_table_is_a_switch(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    deliver(spark, root, "b1", LATE[0][0][1])
    old = readers.read_table(spark, root, "dim_geography")
    base = versions.current(spark, root)
    assert writers.write_table(old.limit(0), root, "dim_geography") == 0
    assert readers.read_table(spark, root, "dim_geography").count() == 0 and old.count() == 1  # its files are still there
    with pytest.raises(versions.LoadConflict):
        versions.publish(spark, root, base, {})
    names = [n for n in os.listdir(f"{root}/_published") if n.endswith(".json") and not n.startswith(".")]
    assert len(names) == 2 and all(json.loads(Path(root, "_published", n).read_text()) for n in names)
