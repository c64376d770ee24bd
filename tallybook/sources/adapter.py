"""Order, customer and part tables seen as raw retail lines and a customer master."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.joins import lookup_join

# Country per nation key 0..23, age group per customer key modulo 6, description ending per part key modulo 8.
COUNTRIES = [
    "United Kingdom", "Germany", "France", "EIRE", "Netherlands", "Spain", "Italy", "Norway", "Sweden",
    "Poland", "Czech Republic", "USA", "Canada", "Australia", "Japan", "United Arab Emirates", "Israel", "RSA",
    "Nigeria", "Brazil", "Argentina", "Channel Islands", "Unspecified", " portugal ",
]
AGE_GROUPS = ["18-25", "26-35", "36-50", "51-65", "65+"]
ENDINGS = [" heart sign", " tea mug", " travel bag ", " pencil card", " design tape", " puzzle"]


def _pick(index, values, otherwise=None):
    chain = F
    for i, value in enumerate(values):
        chain = chain.when(index == i, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core when a small source comes in fewer splits than there are cores.

    A large source has more splits than cores and passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def retail_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw text lines, dirt and copies included."""
    c = F.col
    lines = spread(_read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        ((c("l_returnflag") == "R") & (c("l_linestatus") == "F")).alias("is_return")))
    orders = _read(spark, folder, "orders").select(
        c("o_orderkey").alias("l_orderkey"), c("o_custkey").alias("c_custkey"), "o_orderdate")
    customers = _read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    parts = _read(spark, folder, "part").select(c("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")

    base = lookup_join(lines, orders, "l_orderkey", "inner")
    base = lookup_join(base, customers, "c_custkey", "inner", probe=orders)
    base = lookup_join(base, parts, "l_partkey", "inner", probe=lines)

    order, line, part = c("l_orderkey"), c("l_linenumber"), c("l_partkey")

    def dirt(modulus, number):
        return (order % modulus == 0) & (line == number)

    quantity = c("l_quantity").cast("int").cast("string")
    minutes = F.make_dt_interval(mins=(F.lit(480) + order % 600).cast("int"))
    raw = base.select(
        order,
        F.when(dirt(211, 1), "").when(dirt(223, 2), None)
        .when(c("is_return"), F.concat(F.lit("C"), order.cast("string")))
        .otherwise(order.cast("string")).alias("InvoiceNo"),
        F.when(dirt(227, 3), "nan").otherwise(F.concat(F.lit(" p"), part.cast("string"))).alias("StockCode"),
        F.when(part % 50 == 0, None)
        .otherwise(F.concat("p_name", _pick(part % 8, ENDINGS, ""))).alias("Description"),
        F.when(dirt(101, 4), "0").when(dirt(103, 5), "abc").when(dirt(107, 6), "-3").when(dirt(109, 7), "60000")
        .when(c("is_return"), F.concat(F.lit("-"), quantity)).otherwise(quantity).alias("Quantity"),
        F.when(dirt(113, 1), "not-a-date").otherwise((c("o_orderdate") + minutes).cast("string")).alias("InvoiceDate"),
        F.when(dirt(97, 2), "0.0").when(dirt(127, 3), "50000.01").when(dirt(131, 4), None)
        .otherwise((c("p_retailprice").cast("decimal(10,2)") + order % 7).cast("string")).alias("UnitPrice"),
        F.when(c("c_custkey") % 20 == 0, None)
        .otherwise(F.concat(c("c_custkey").cast("string"), F.lit(".0"))).alias("CustomerID"),
        _pick(c("c_nationkey"), COUNTRIES).alias("Country"),
    )
    # Lines of every 50th order come twice.
    repeated = raw.withColumn("_copy", F.explode(F.when(order % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1)))))
    return repeated.drop("l_orderkey", "_copy")


def retail_master(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    key, balance = c("c_custkey"), c("c_acctbal")
    customers = _read(spark, folder, "customer").filter((key % 17 != 0) | (key == 0))
    segment = c("c_mktsegment")
    return customers.select(
        key.alias("customer_id"),
        F.concat(F.lit("CUST_"), key.cast("string")).alias("customer_code"),
        _pick(key % 4, ["Female", "Male", "Non-Binary"]).alias("gender"),
        _pick(key % 6, AGE_GROUPS).alias("age_group"),
        F.when(balance < 0, None).when(balance < 4000, "Bronze").when(balance < 7000, "Silver")
        .when(balance < 9000, "Gold").otherwise("Platinum").alias("loyalty_tier"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int")).alias("signup_date"),
        F.when(segment == "BUILDING", "Mobile App").when(segment == "AUTOMOBILE", "Desktop Web")
        .when(segment == "MACHINERY", "Mobile Web").when(segment == "HOUSEHOLD", "Tablet").alias("preferred_device"),
        F.when(c("c_nationkey") == 0, "United Kingdom")
        .otherwise(F.concat(F.lit("Nation "), c("c_nationkey").cast("string"))).alias("country"),
    )


def label_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled scores for evaluating predictions."""
    score = ((F.col("doc_id") * 37 + F.col("quality") * 211) % 1000).cast("double") / 1000
    return _read(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"), score.alias("score"))


def event_sides(spark: SparkSession, folder: str) -> DataFrame:
    """Event values split by date into a baseline and a current side."""
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return _read(spark, folder, "events").select(
        "value", "event_type", F.when(early, "baseline").otherwise("current").alias("side"))


def scoring_requests(features: DataFrame) -> DataFrame:
    """Customer features as scoring input, with gaps and out-of-range values mixed in."""
    key = F.col("customer_id")

    def dirt(name, *cases):
        chain = F
        for modulus, value in cases:
            chain = chain.when(key % modulus == 0, F.lit(value).cast("double"))
        return chain.otherwise(F.col(name).cast("double"))

    return features.withColumns(
        {
            "recency_days": dirt("recency_days", (31, None), (37, -1.0)),
            "frequency_orders": dirt("frequency_orders", (41, 0.0)),
            "cancellation_rate": dirt("cancellation_rate", (43, 1.5), (3, None)),
            "inter_purchase_mean": dirt("inter_purchase_mean", (5, None)),
            "inter_purchase_std": dirt("inter_purchase_std", (11, None)),
            "product_variety": dirt("product_variety", (7, None)),
        })
