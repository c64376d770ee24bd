"""Global order against plain windows, with a third and more of the rows in one group."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tallybook.operators import ordering
from tallybook.operators.ordering import dense_key, lay_out, running_totals, sequence_within


@pytest.fixture
def rows(many_parts):
    hot = F.when(F.col("id") % 5 < 3, F.lit(7)).otherwise(F.col("id") % 40)
    return many_parts.range(0, 6000, 1, 6).select(
        "id", hot.cast("bigint").alias("g"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("v"),
        (F.col("id") % 13).cast("decimal(10,2)").alias("m"))


def same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_dense_key(rows):
    ours = dense_key(rows, ["g", "v", "id"], "k")
    assert same(ours, rows.withColumn("k", F.row_number().over(W.orderBy("g", "v", "id"))))


def test_descending_key(rows):
    ours = dense_key(rows, [F.desc("m"), F.col("id")], "k")
    assert same(ours, rows.withColumn("k", F.row_number().over(W.orderBy(F.desc("m"), "id"))))


def test_hot_value_spreads_over_parts(rows):
    laid = lay_out(rows, ["g", "id"])
    assert len(laid.parts) > 4 and max(p["rows"] for p in laid.parts) < 2000
    assert laid.rows == 6000


def test_rows_at_ranks(rows):
    laid = lay_out(rows, ["v", "id"])
    expected = [r["id"] for r in rows.orderBy("v", "id").collect()]
    got = laid.at_ranks([1, 2, 2999, 6000])
    assert {k: r["id"] for k, r in got.items()} == {k: expected[k - 1] for k in (1, 2, 2999, 6000)}


def test_running_totals(rows):
    ours = running_totals(rows, ["v", "id"], {"sum_m": "m", "sum_g": "g"}, rank="k")
    w = W.orderBy("v", "id").rowsBetween(W.unboundedPreceding, 0)
    plain = rows.withColumns({"sum_m": F.sum("m").over(w), "sum_g": F.sum("g").over(w),
                              "k": F.row_number().over(W.orderBy("v", "id"))})
    assert same(ours, plain)


@pytest.mark.parametrize("large", [10_000, 500, 100, 0])
def test_sequence_within_hot_group(rows, large):
    """All groups by hash, only the hot one by range parts, some, and all of them."""
    ours = sequence_within(
        rows, "g", ["v", "id"], "n", previous={"before": "m"}, first={"head": "id"}, rank="k", large=large)
    w = W.partitionBy("g").orderBy("v", "id")
    plain = rows.withColumns({
        "n": F.row_number().over(w), "before": F.lag("m").over(w), "head": F.first("id").over(w),
        "k": F.row_number().over(W.orderBy("g", "v", "id"))})
    assert same(ours, plain)


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]


def test_sequence_takes_one_shuffle(rows):
    ours = sequence_within(rows, "g", ["v", "id"], "n", previous={"before": "m"}, first={"head": "id"})
    assert len(exchanges(ours)) == 1


def test_part_count_follows_the_sources(spark, tmp_path, monkeypatch):
    spark.range(0, 200_000).selectExpr("id", "md5(cast(id as string)) as mark").write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    size = ordering.source_bytes(stored)
    assert size > 1_000_000 and ordering.source_bytes(stored.unionAll(stored)) >= 2 * size
    assert ordering.source_bytes(spark.createDataFrame([(1,)], "id long")) < 1000
    monkeypatch.setattr(ordering, "PART_BYTES", size // 20)
    assert ordering.ranged(stored, ["id"]).rdd.getNumPartitions() >= 20


def test_empty(many_parts):
    none = many_parts.range(0).select("id", F.col("id").alias("g"))
    assert dense_key(none, ["id"], "k").count() == 0
    assert running_totals(none, ["id"], {"s": "g"}).count() == 0
    assert sequence_within(none, "g", ["id"], "n", previous={"p": "id"}).count() == 0


@pytest.mark.parametrize("partitions", ["1", "3", "17"])
def test_result_does_not_depend_on_partitions(rows, partitions):
    spark = rows.sparkSession
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        ours = sequence_within(rows.repartition(5), "g", ["v", "id"], "n", previous={"p": "v"})
        w = W.partitionBy("g").orderBy("v", "id")
        assert same(ours, rows.withColumns({"n": F.row_number().over(w), "p": F.lag("v").over(w)}))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
