"""What loads leave on disk, and loads that go through their rows in turns."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tallybook import staging
from tallybook.operators import ordering
from tallybook.operators.cleaning import drop_copies
from tallybook.plans import etl, upkeep
from tallybook.schemas import RAW_COLUMNS, RAW_SCHEMA, WAREHOUSE_TABLES
from tallybook.sources import batches, readers, versions, writers
from tallybook.staging import Stage

SCHEMA = ", ".join(f"{c} string" for c in [*RAW_COLUMNS, "batch_id"])


def shuffled(spark):
    """Shuffle files there are now."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_of(spark, before):
    """Shuffle files beyond ``before``; they go a little after the write."""
    for _ in range(50):
        left = shuffled(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def rows(df, *drop):
    df = df.drop(*drop)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def lines(months=(1, 2, 3), days=6):
    """Lines of several months, with copies, cancellations, rejects and text that is no date."""
    made = []
    for m in months:
        for d in range(1, days + 1):
            for i in range(8):
                at = f"2011-{m:02d}-{d:02d} 1{i % 3}:00:00"
                made.append((f"{m}{d:02d}{i % 4}", f"a{i % 5}", f"thing {i % 5}", str(1 + i % 3), at, f"{1 + i % 4}.50",
                             None if i == 7 else str(10 + i % 3), "France" if i % 2 else "Spain"))
        made += made[-3:]
        made += [(f"C{m}", "a1", "thing 1", "-1", f"2011-{m:02d}-02 09:00:00", "2.5", "11", "France"),
                 (f"9{m}", "a1", None, "1", "no date", "2.5", "11", "France"), (None, "a1", "x", "1", f"2011-{m:02d}-02", "1", "11", None)]
    return made


@pytest.fixture
def raw(spark, tmp_path):
    spark.createDataFrame(lines(), RAW_SCHEMA).write.parquet(f"{tmp_path}/raw.parquet")
    return spark.read.parquet(f"{tmp_path}/raw.parquet")


@pytest.fixture
def short_turns(monkeypatch):
    """From now on 20 rows are a turn; the setting before is for the table to compare with."""
    def start():
        monkeypatch.setattr(ordering, "TURN_ROWS", 20)
    return start


@pytest.mark.parametrize("write", [
    lambda df, at: Stage(df.sparkSession, at).table(df, "t"), lambda df, at: versions.write(df, at, "t", "1"),
    lambda df, at: writers.overwrite_partitions(df, at, "k"), lambda df, at: writers.write_csv(df, at)])
def test_a_write_leaves_no_shuffle_files(spark, tmp_path, write):
    before, setting = shuffled(spark), spark.conf.get(staging._FREEING, None)
    write(spark.range(1000, numPartitions=4).select((F.col("id") % 7).alias("k")).groupBy("k").count(), f"{tmp_path}/t")
    assert not left_of(spark, before)
    assert spark.conf.get(staging._FREEING, None) == setting


def test_the_setting_comes_back(spark):
    with pytest.raises(ZeroDivisionError), staging.freeing(spark), staging.freeing(spark):
        assert spark.conf.get(staging._FREEING) == "true"
        1 / 0
    assert spark.conf.get(staging._FREEING, None) is None
    spark.conf.set(staging._FREEING, "false")
    with staging.freeing(spark):
        pass
    assert spark.conf.get(staging._FREEING) == "false"
    spark.conf.unset(staging._FREEING)


def test_a_full_load_leaves_nothing_on_the_way(spark, raw, tmp_path):
    stage = Stage(spark, f"{tmp_path}/stage")
    kept = stage.table(spark.range(3), "kept")
    etl.run_full(spark, raw, None, f"{tmp_path}/root", stage=stage)
    assert {p.relative_to(stage.root).parts[0] for p in Path(stage.root).rglob("*.parquet")} == {"000-kept"}
    assert kept.count() == 3  # what was there before stays


def test_loads_of_batches_leave_nothing_on_the_way(spark, raw, tmp_path):
    stage, ids = Stage(spark, f"{tmp_path}/stage"), ["batch_2011_01", "batch_2011_02", "batch_2011_03"]
    stored = raw.transform(batches.monthly)
    for some in (ids[:2], ids[2:], ids[:1]):  # a build, an added batch, one that comes again
        etl.run_incremental(spark, stored, None, f"{tmp_path}/root", some, stage)
    assert not [*Path(stage.root).rglob("*.parquet")]
    assert len(readers.read_table(spark, f"{tmp_path}/root", "fact_sales").select("batch_id").distinct().collect()) == 3


def test_a_full_load_in_turns(spark, raw, tmp_path, short_turns, monkeypatch):
    whole = etl.run_full(spark, raw, None, f"{tmp_path}/a")
    seen, lay_out = [], ordering.lay_out
    monkeypatch.setattr("tallybook.plans.warehouse.lay_out", lambda df, *a, **k: seen.append(len(df)) or lay_out(df, *a, **k))
    short_turns()
    made = etl.run_full(spark, raw, None, f"{tmp_path}/b")
    assert seen[0] > 4 and made["table_counts"] == whole["table_counts"]
    for name in WAREHOUSE_TABLES:
        a, b = (readers.read_table(spark, f"{tmp_path}/{r}", name) for r in "ab")
        assert rows(a) == rows(b), name


def test_batches_in_turns(spark, raw, tmp_path, short_turns):
    """Months of which one is hot, a copy in a later batch on the same day, and one that was rejected whole."""
    def story(root):
        stored = raw.transform(batches.monthly)
        late = stored.filter("batch_id = 'batch_2011_02' and StockCode = 'a1'").withColumn("batch_id", F.lit("batch_late"))
        more = late.withColumn("InvoiceNo", F.concat("InvoiceNo", F.lit("9"))).unionAll(late)
        gone = late.withColumns({"batch_id": F.lit("batch_none"), "UnitPrice": F.lit("x")})
        etl.run_incremental(spark, stored.unionAll(stored.filter("batch_id = 'batch_2011_02'")), None, root)
        etl.run_incremental(spark, more.unionAll(gone), None, root, ["batch_late", "batch_none", "batch_void"])
        return {n: readers.read_table(spark, root, n) for n in WAREHOUSE_TABLES}

    whole = story(f"{tmp_path}/a")
    short_turns()
    made = story(f"{tmp_path}/b")
    assert {r["table_name"]: r["rows"] for r in upkeep.differences(whole, made).collect()} == dict.fromkeys(upkeep.NATURAL, 0)
    for n in ("lines", "quarantine", "raw_counts"):
        a, b = (spark.read.parquet(f"{tmp_path}/{r}/{n}") for r in "ab")
        assert rows(a, "logged_at") == rows(b, "logged_at"), n
    assert rows(whole["fact_sales"]) == rows(made["fact_sales"])  # keys go by the sales order
    assert len(list(Path(f"{tmp_path}/b/lines").glob("batch_id=*"))) == 4


def test_turns(spark, monkeypatch):
    monkeypatch.setattr(ordering, "TURN_ROWS", 3)
    monkeypatch.setattr(ordering, "TURNS", 4)
    assert ordering.turns_of([]) == [[]]
    assert ordering.turns_of([("a", 2), ("b", 1)]) == [["a", "b"]]
    assert ordering.turns_of([("a", 2), ("b", 2), ("c", 9), ("d", 1), ("e", 1)]) == [["a", "b"], ["c"], ["d", "e"]]
    for days in ([None, 3, 1, 2, 2, 2, None, 5, 4], [None, None, None, None, 1], [], [None], [7, 7, 7, 7]):
        df = spark.createDataFrame([(d,) for d in days], "day int")
        found = [[r[0] for r in one.collect()] for one in ordering.in_turns(df, "day")]
        assert sorted((d for one in found for d in one), key=repr) == sorted(days, key=repr)
        ends = [(min((d or 0) for d in one), max((d or 0) for d in one)) for one in found if one]
        assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_copies_before_a_turn_are_not_missed(spark, tmp_path):
    """A frame for each turn gives the order and the numbers of one for all."""
    df = spark.createDataFrame([(i % 9, i % 4, f"t{i % 2}") for i in range(200)], "day int, n int, text string")
    one = ordering.lay_out(drop_copies(df, ["day", "n"]), ["day", "n"], Stage(spark, f"{tmp_path}/a"))
    cut = [drop_copies(df.filter(c), ["day", "n"]) for c in ("day < 4", "day = 4", "day > 100", "day > 4")]
    many = ordering.lay_out(cut, ["day", "n"], Stage(spark, f"{tmp_path}/b"))
    assert rows(one.ranked("k")) == rows(many.ranked("k")) and many.rows == 36
    turns = [many.ranked("k", [p["_part"]]) for p in many.parts]
    assert sorted((r for t in turns for r in rows(t)), key=repr) == rows(one.ranked("k"))


def test_months_are_compressed_files_of_few_lines(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "FILE_ROWS", 10)
    batches.export_monthly(raw, str(tmp_path / "months"))
    files = [*(tmp_path / "months/batches").rglob("part-*")]
    assert len(files) > 10 and all(f.name.endswith(".csv.gz") for f in files)
    text = F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss")
    stored = raw.transform(batches.monthly).withColumn("InvoiceDate", F.when(F.length("InvoiceDate") > 10, F.col("InvoiceDate")).otherwise(
        text))
    assert rows(batches.read_monthly(spark, str(tmp_path / "months")), "_broken_record") == rows(stored)
