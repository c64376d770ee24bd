"""Sources, sinks, full and incremental loads, the file stream."""

import datetime

import pytest
from tallybook.operators import quality
from tallybook.operators.constraints import constraint_audit
from tallybook.plans import etl
from tallybook.plans.dims import modal_country
from tallybook.plans.warehouse import run_sql
from tallybook.schemas import RAW_COLUMNS, RAW_SCHEMA, WAREHOUSE_TABLES
from tallybook.sources import adapter, batches, readers, writers
from tallybook.streaming.landing import load_arriving_batches


@pytest.fixture(scope="module")
def raw(spark, tiny, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "retail_raw.parquet")
    adapter.retail_raw(spark, tiny).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def master(spark, tiny):
    return adapter.retail_master(spark, tiny)


@pytest.fixture(scope="module")
def full(spark, raw, master, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    return root, etl.run_full(spark, raw, master, root)


def rows(df, *drop):
    df = df.drop(*drop)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_full_load(spark, full):
    root, result = full
    assert (result["raw_records"], result["clean_records"], result["rejected_records"]) == (6116, 6040, 76)
    assert result["table_counts"]["fact_sales"] == 5924
    for name in WAREHOUSE_TABLES:
        assert readers.read_table(spark, root, name).count() == result["table_counts"][name]
        assert spark.read.option("header", True).csv(f"{root}/exports/{name}_sample").count() == min(
            100, result["table_counts"][name])
    audit = readers.read_table(spark, root, "etl_audit_log").collect()
    assert [(r["raw_row_count"], r["cleaned_row_count"], r["rejected_row_count"], r["status"]) for r in audit] == [
        (6116, 5924, 76, "COMPLETED")]
    assert readers.read_table(spark, root, "etl_rejection_log").count() == 76
    assert spark.read.parquet(f"{root}/quarantine").count() == 76
    logs = {n: readers.read_table(spark, root, n) for n in ("etl_audit_log", "etl_rejection_log")}
    assert {r["violations"] for r in constraint_audit(logs).collect()} == {0}


def test_the_source_is_read_once(spark, raw, master, tmp_path):
    """Executed plans that scan the source, by the statistics Spark keeps of them."""
    path = raw.inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/")
    store = spark._jsparkSession.sharedState().statusStore()
    known = store.executionsCount()
    result = etl.run_full(spark, raw, master, str(tmp_path))
    assert result["pass_rate_pct"] == 98.76 and result["table_counts"]["fact_sales"] == 5924
    done = store.executionsList()
    plans = [done.apply(i).physicalPlanDescription() for i in range(done.size())][known:]
    assert len([p for p in plans if path in p]) == 1 and len(plans) > 20


def test_line_breaks_in_csv(spark, tmp_path):
    """A description with line breaks survives the round trip if it is asked for; else both halves are rejected as such."""
    line = ("536365", "85123A", 'WHITE "HANGING"\nHEART, T-LIGHT\n\nHOLDER', "6", "2010-12-01 08:26:00", "2.55", "17850", "United Kingdom")
    last = ("536366", "85123B", "PLAIN", "6", "2010-12-01 08:26:00", "2.55", "17850", "United\nKingdom")
    good = ("536367", "85123C", '"QUOTED" TEXT', "6", "2010-12-01 08:26:00", "2.55", "17850", "France")
    raw = spark.createDataFrame([line, last, good], RAW_SCHEMA)
    batches.export_monthly(raw, str(tmp_path))
    whole = batches.read_monthly(spark, str(tmp_path), multi_line=True)
    assert rows(whole, "batch_id", "_broken_record", "InvoiceDate") == rows(raw, "InvoiceDate")
    cut = quality.gate(batches.read_monthly(spark, str(tmp_path)))
    found = {r["rejection_reason"]: r["count"] for r in cut.groupBy("rejection_reason").count().collect()}
    assert found == {None: 1, "BROKEN_CSV_RECORD": 5}
    root = f"{tmp_path}/root"
    etl.load_batches(spark, batches.read_monthly(spark, str(tmp_path)), root)
    assert spark.read.parquet(f"{root}/lines").count() == 1
    log = readers.read_table(spark, root, "etl_rejection_log")
    assert {r[0] for r in log.select("rejection_reason").collect()} == {"BROKEN_CSV_RECORD"}
    writers.land(raw, f"{tmp_path}/landed")
    assert readers.read_batch(spark, f"{tmp_path}/landed/retail_raw.csv", multi_line=True).count() == 3
    for _ in range(2):
        load_arriving_batches(spark, str(tmp_path), f"{tmp_path}/s", f"{tmp_path}/c", multi_line=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/s/lines").count() == 3


def test_trial_run_on_few_rows(spark, raw, tmp_path):
    result = etl.run_full(spark, raw, None, str(tmp_path), limit=500)
    assert result["raw_records"] == 500
    assert result["table_counts"]["fact_sales"] <= result["clean_records"] <= 500


def test_modal_country_reads_two_columns(raw):
    plan = modal_country(raw)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<CustomerID:string,Country:string>" in plan


def test_months_equal_the_full_load(spark, raw, master, full, tmp_path):
    folder, root = f"{tmp_path}/landing", f"{tmp_path}/warehouse"
    manifest = batches.export_monthly(raw, folder)
    assert manifest.count() == raw.transform(batches.monthly).select("batch_id").distinct().count()
    stored = batches.read_monthly(spark, folder)
    etl.run_incremental(spark, stored, master, root)
    ids = sorted(r["batch_id"] for r in manifest.collect())
    again = etl.run_incremental(spark, stored, master, root, ids[:3])  # repeating batches changes nothing
    assert again["fact_sales"] == 5924
    for name in WAREHOUSE_TABLES:
        ours, whole = (readers.read_table(spark, r, name) for r in (root, full[0]))
        assert rows(ours, "batch_id") == rows(whole, "batch_id"), name
    assert "PartitionFilters: [isnotnull(batch_id" in batches.read_monthly(
        spark, folder, ids[:1])._jdf.queryExecution().executedPlan().toString()


def test_stream_equals_batches(spark, raw, tmp_path):
    folder = f"{tmp_path}/landing"
    batches.export_monthly(raw, folder)
    etl.load_batches(spark, batches.read_monthly(spark, folder), f"{tmp_path}/batch")
    for _ in range(2):
        query = load_arriving_batches(spark, folder, f"{tmp_path}/stream", f"{tmp_path}/ckpt", 40)
        query.awaitTermination()
    for name, drop in (("lines", ()), ("quarantine", ("logged_at",))):
        a, b = (spark.read.parquet(f"{tmp_path}/{r}/{name}") for r in ("batch", "stream"))
        assert rows(a, *drop) == rows(b, *drop)


def test_csv_and_parquet_read_alike(spark, raw, tmp_path):
    writers.land(raw, str(tmp_path))
    parquet = readers.read_batch(spark, f"{tmp_path}/retail_raw.parquet")
    text = readers.read_batch(spark, f"{tmp_path}/retail_raw.csv")
    assert parquet.count() == text.count() == 6116
    assert readers.read_full(spark, str(tmp_path))[1] == "full_historical_baseline"
    from tallybook.operators.quality import summary_of, gate
    assert summary_of(gate(text), "b").drop("broken_csv_record").first() == summary_of(gate(parquet), "b").first()


def test_bad_sources(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_batch(spark, f"{tmp_path}/x.xlsx")
    with pytest.raises(FileNotFoundError):
        readers.read_full(spark, str(tmp_path))
    spark.range(1).write.parquet(f"{tmp_path}/x.parquet")
    with pytest.raises(KeyError):
        readers.read_batch(spark, f"{tmp_path}/x.parquet")


def test_missing_table_is_empty_with_its_columns(spark, tmp_path):
    none = readers.read_table(spark, str(tmp_path), "etl_audit_log")
    assert none.count() == 0 and "execution_duration_sec" in none.columns


def test_empty_result(spark, full, tmp_path):
    root, result = full
    old = readers.read_table(spark, root, "dim_geography")
    assert writers.write_table(old.limit(0), root, "dim_geography", keep_if_empty=True) == 0
    assert readers.read_table(spark, root, "dim_geography").count() == result["table_counts"]["dim_geography"]
    writers.write_table(old, str(tmp_path), "dim_geography")
    assert writers.write_table(old.limit(0), str(tmp_path), "dim_geography") == 0
    assert readers.read_table(spark, str(tmp_path), "dim_geography").count() == 0


def test_late_lines_and_redelivery(spark, tmp_path):
    def batch(batch_id, month, numbers, price="2.5"):
        return [(str(500000 + i), f"A{i}", f"THING {i}", 3, f"2011-{month}-05 10:00:00", price, "12345", "France", batch_id)
                for i in numbers]

    def deliver(*rows, ids=None):
        df = spark.createDataFrame([r for part in rows for r in part], ", ".join(
            f"{c} {'int' if c == 'Quantity' else 'string'}" for c in [*RAW_COLUMNS, "batch_id"]))
        etl.load_batches(spark, df, str(tmp_path), ids)

    def count(table):
        found = spark.read.schema("batch_id string").parquet(f"{tmp_path}/{table}").groupBy("batch_id").count().collect()
        return {r["batch_id"]: r["count"] for r in found}

    deliver(batch("batch_2011_01", "01", range(10)) + batch("batch_2011_01", "01", [99], "-1"))
    deliver(batch("batch_2011_02", "02", range(20, 25)) + batch("batch_2011_02", "01", [30]) + batch("batch_2011_02", "01", [3]))
    assert count("lines") == {"batch_2011_01": 10, "batch_2011_02": 7} and count("quarantine") == {"batch_2011_01": 1}
    assert count("etl_rejection_log") == {"batch_2011_01": 1}
    assert etl.rebuild(spark, None, str(tmp_path))["fact_sales"] == 16  # line 3 came twice
    deliver(batch("batch_2011_01", "01", range(10)))  # again, without rejects
    assert count("lines")["batch_2011_01"] == 10 and count("quarantine") == {} and count("etl_rejection_log") == {}
    deliver(batch("batch_2011_01", "01", range(10), "-1"))  # again, all rejected
    assert count("lines") == {"batch_2011_02": 7} and count("quarantine") == {"batch_2011_01": 10}
    etl.rebuild(spark, None, str(tmp_path))
    audit = readers.read_table(spark, str(tmp_path), "etl_audit_log").orderBy("extraction_timestamp").collect()
    assert [r["raw_row_count"] for r in audit] == [18, 17]


def test_latest_batch(spark, raw, tmp_path):
    folder, root = f"{tmp_path}/landing", f"{tmp_path}/warehouse"
    newest = max(r["batch_id"] for r in batches.export_monthly(raw, folder).collect())
    result = etl.run_latest(spark, folder, None, root)
    loaded = spark.read.parquet(f"{root}/lines")
    assert [r[0] for r in loaded.select("batch_id").distinct().collect()] == [newest]
    assert 0 < result["fact_sales"] <= batches.read_monthly(spark, folder, [newest]).count()


def test_staging_and_quarantine_are_idempotent(spark, raw, tmp_path):
    for _ in range(2):
        writers.stage_extract(raw, str(tmp_path), "b1")
    writers.stage_extract(raw.limit(10), str(tmp_path), "b2")
    staged = spark.read.parquet(f"{tmp_path}/staging")
    assert {r["batch_id"]: r["count"] for r in staged.groupBy("batch_id").count().collect()} == {"b1": 6116, "b2": 10}


def test_ingestion_log_appends(spark, tmp_path):
    for rows_read in (1, 2):
        writers.log_ingestion(spark, str(tmp_path), "raw.parquet", rows_read, RAW_COLUMNS, datetime.datetime(2020, 1, 1))
    assert sorted(r["row_count"] for r in spark.read.json(f"{tmp_path}/ingestion_log").collect()) == [1, 2]


def test_load_without_master_and_without_lines(spark, tmp_path):
    from tallybook.plans import dims, facts, marts
    from tallybook.operators.cleaning import clean_and_transform

    lines = clean_and_transform(spark.createDataFrame(
        [("1", "a", "Tea", "2", "2011-01-01 10:00:00", "1.5", "7", "France")], RAW_SCHEMA), "b")
    people = dims.build_dim_customer(lines, None).collect()
    assert [(p["customer_code"], p["loyalty_tier"], p["country"], str(p["signup_date"])) for p in people] == [
        ("CUST_7", "Bronze", "United Kingdom", "2010-01-01")]
    none = lines.limit(0)
    customers = dims.build_dim_customer(none, None)
    sales = facts.build_fact_sales(
        none, customers, dims.build_dim_product(none), dims.build_dim_geography(none))
    assert sales.count() == 0 and dims.build_dim_date(none).count() == 0
    assert facts.build_fact_customer_retention(none, customers).count() == 0
    assert marts.build_mart_customer_rfm(sales, customers).count() == 0


def test_unknown_references_keep_the_line(spark):
    from tallybook.plans import dims, facts
    from tallybook.operators.cleaning import clean_and_transform

    def lines(*triples):
        return clean_and_transform(spark.createDataFrame(
            [(i, s, "Tea", "2", "2011-01-01 10:00:00", "1.5", c, "France") for i, s, c in triples], RAW_SCHEMA), "b")

    known = lines(("1", "a", None), ("2", "b", "9"))
    customers = dims.build_dim_customer(known, None)
    fact = facts.build_fact_sales(
        lines(("3", "zz", "77"), ("4", "b", "9")), customers, dims.build_dim_product(known),
        dims.build_dim_geography(known)).collect()
    assert {r["invoice_no"]: (r["customer_key"], r["product_key"]) for r in fact} == {"3": (1, 1), "4": (2, 2)}


def test_sql_over_tables(spark, full):
    for name in WAREHOUSE_TABLES:
        readers.read_table(spark, full[0], name).createOrReplaceTempView(name)
    got = run_sql(
        spark,
        "SELECT g.country_name, ROUND(SUM(f.total_amount), 2) AS revenue FROM fact_sales f "
        "JOIN dim_geography g ON f.geography_key = g.geography_key WHERE f.is_cancelled = FALSE "
        "AND g.country_name = :country GROUP BY g.country_name", {"country": "Germany"})
    assert got.count() == 1
