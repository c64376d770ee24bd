"""Upkeep of the warehouse: a delivered batch is added at the cost of the batch and of the days it touches.

Beside the eight tables, every load keeps what merges: keys that are only ever appended, and partial aggregates of the batch
(prices per product, invoices per day and country, purchases and orders per customer). A new batch reads its own lines, of older
batches only those of the days it shares with them, the key tables, and one row per customer. It appends to the fact and to the
retention fact, and replaces the mart's months it touches, the customer mart and the dimensions (one row per key).

``refresh`` decides between that and a build from all loaded lines, which a batch needs that was loaded before (its old rows must
go) or whose copies of older lines would have counted first. Both give the same tables up to the numbers of surrogate keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.bitmaps import bitmaps_of, distinct_keys
from tallybook.operators.cleaning import drop_copies
from tallybook.operators.joins import fits_broadcast, lookup_join
from tallybook.operators.ordering import dense_key, in_turns, lay_out
from tallybook.plans import dims, facts, marts
from tallybook.schemas import LINE_KEYS, PARTITION_KEYS, SALES_ORDER, WAREHOUSE_TABLES, column_types, conform
from tallybook.sources import versions
from tallybook.staging import Stage

_MONEY = "decimal(22,2)"
#: What a load keeps beside the eight tables, and the columns of it.
STATE: dict[str, dict[str, str]] = {
    "batch_days": dict(batch_id="string", date_key="int", lines="bigint"),
    "customer_keys": dict(customer_id="bigint", customer_key="bigint"),
    "product_keys": dict(stock_code="string", product_key="bigint"),
    "geography_keys": dict(country_name="string", geography_key="bigint"),
    "product_variants": dict(StockCode="string", Description="string", UnitPrice="decimal(10,2)", seen="timestamp_ntz", n="bigint"),
    "sold_invoices": dict(
        date_key="int", geography_key="bigint", invoice_no="string", customer_key="bigint", amount=_MONEY, units="bigint",
        cancelled="bigint", batch_id="string"),
    "purchased_invoices": dict(customer_key="bigint", invoice_no="string"),
    "customer_totals": dict(customer_key="bigint", last_ts="timestamp_ntz", frequency="bigint", monetary_total=_MONEY),
    "customer_days": dict(date_key="int", bucket="bigint", bits="binary", batch_id="string"),
    "orders": dict(customer_id="bigint", InvoiceNo="string", date_key="int", order_date="timestamp_ntz", order_value=_MONEY),
    "customer_orders": dict(
        customer_id="bigint", orders="bigint", first_date="timestamp_ntz",
        last="struct<order_date:timestamp_ntz,InvoiceNo:string,date_key:int>"),
}
_PARTITIONS = {**PARTITION_KEYS, "sold_invoices": "batch_id", "customer_days": "batch_id"}
_LINES = ("InvoiceNo string, StockCode string, Description string, Country string, InvoiceDate timestamp_ntz, Quantity int, "
          "UnitPrice decimal(10,2), customer_id bigint, date_key int, total_amount decimal(12,2), is_cancelled boolean, "
          "batch_id string")


def read(spark: SparkSession, root: str, table: str, version: versions.Version | None = None) -> DataFrame:
    return versions.read(spark, root, table, STATE.get(table) or column_types(table), version)


def loaded_lines(spark: SparkSession, root: str) -> DataFrame:
    """Clean lines of all delivered batches; copies across batches are among them."""
    return spark.read.schema(_LINES).parquet(f"{root.rstrip('/')}/lines")


class _Load:
    """One version in the making: what it reads is the base version, what it writes lies beside it."""

    def __init__(self, spark: SparkSession, root: str, base: versions.Version, stage: Stage):
        self.spark, self.root, self.base, self.stage = spark, root, base, stage
        self.id, self.changed = versions.new_load(), {}

    def old(self, table: str) -> DataFrame:
        return read(self.spark, self.root, table, self.base)

    def has(self, table: str) -> bool:
        return bool(self.base.folders.get(table))

    def _write(self, table: str, df: DataFrame | Iterable[DataFrame]) -> list[str]:
        columns = STATE.get(table) or column_types(table)
        frames = [df] if isinstance(df, DataFrame) else df
        typed = (one.select(*[F.col(n).cast(t).alias(n) for n, t in columns.items()]) for one in frames)
        return versions.write(typed, self.root, table, self.id, _PARTITIONS.get(table))[0]

    def append(self, table: str, df: DataFrame | Iterable[DataFrame]) -> DataFrame:
        """Add rows (several frames one after the other); returns them as stored."""
        made = self._write(table, df)
        self.changed[table] = self.base.folders.get(table, []) + made
        return read(self.spark, self.root, table, versions.Version(0, {table: made}))

    def replace(self, table: str, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Take rows instead of the old ones, except for the folders to keep."""
        self.changed[table] = [*keep, *self._write(table, df)]
        return self.new(table)

    def new(self, table: str) -> DataFrame:
        """The table as this load leaves it."""
        return read(self.spark, self.root, table, versions.Version(0, self.base.folders | self.changed))

    def keys(self, table: str, names: DataFrame) -> DataFrame:
        """Number the names that have no key yet, in their order, and return all keys."""
        name, key = STATE[table]
        known = self.old(table)
        fresh = names.join(known, name, "left_anti") if self.has(table) else names
        top = known.agg(F.max(key)).first()[0] or 0
        self.append(table, dense_key(fresh, [name], key, self.stage).withColumn(key, F.col(key) + top))
        return self.new(table)


def _fresh_lines(load: _Load, lines: DataFrame, ids: Sequence[str]) -> tuple[list[DataFrame] | None, list[str]]:
    """Lines of the new batches without copies of older ones, and the older batches that have days in common with them.

    The lines come in frames that follow one another by day. None if a new batch would have to come before one of those.
    """
    once = [drop_copies(some, first_by=["batch_id"]) for some in in_turns(lines, "date_key")]  # copies are of one day
    if not load.has("batch_days"):
        return once, []
    days = lines.select("date_key").distinct()
    shared = load.old("batch_days").join(F.broadcast(days), "date_key")  # a row a day, for batches and days that there are
    touched = shared.select("batch_id", "date_key").collect()
    if not touched:
        return once, []
    older = sorted({r["batch_id"] for r in touched})
    if older[-1] > min(ids):
        return None, older
    before = loaded_lines(load.spark, load.root).filter(
        F.col("batch_id").isin(older) & F.col("date_key").isin(sorted({r["date_key"] for r in touched})))
    return [some.join(before.select(*LINE_KEYS), LINE_KEYS, "left_anti") for some in once], older


def _sales_mart(load: _Load, cells: DataFrame, ids: Sequence[str], older: list[str]) -> None:
    """Rows of the days that the new batches touch, counted again from the invoices of all batches on these days."""
    days = [r[0] for r in load.new("batch_days").filter(F.col("batch_id").isin(list(ids))).select("date_key").distinct().collect()]
    months = sorted({f"{d // 10000}-{d // 100 % 100:02d}" for d in days})
    if older:
        cells = cells.unionByName(load.old("sold_invoices").filter(F.col("batch_id").isin(older) & F.col("date_key").isin(days)))
    daily = marts.daily_sales(cells, load.new("dim_date"), load.new("dim_geography"))
    top = load.base.number << 40 if load.has("mart_sales_performance") else 0  # beyond the numbers of earlier versions
    made = dense_key(daily, ["date_key", "year_month", "country_name"], "mart_id", load.stage)
    made = conform(made.withColumn("mart_id", F.col("mart_id") + top), "mart_sales_performance")
    folders = load.base.folders.get("mart_sales_performance", [])
    touched = [f for f in folders if f.rsplit("=", 1)[-1] in months]
    if touched:
        month = read(load.spark, load.root, "mart_sales_performance", versions.Version(0, {"mart_sales_performance": touched}))
        made = made.unionByName(month.filter(~F.col("date_key").isin(days)))
    load.replace("mart_sales_performance", made, [f for f in folders if f not in touched])


def _customer_mart(load: _Load, fact: DataFrame) -> None:
    """Totals of the customers with the batch added; an invoice that came in an earlier batch counts once."""
    bought = load.stage.table(marts.purchased_invoices(fact), "bought")
    pairs = bought.select("customer_key", "invoice_no")
    fresh = pairs.join(load.old("purchased_invoices"), ["customer_key", "invoice_no"], "left_anti") if load.has(
        "purchased_invoices") else pairs
    fresh = load.append("purchased_invoices", fresh)
    counted = fresh.groupBy("customer_key").agg(F.count("*").alias("frequency"))
    added = bought.groupBy("customer_key").agg(F.max("last_ts").alias("last_ts"), F.sum("spend").alias("monetary_total"))
    added = added.join(counted, "customer_key", "left").select(
        "customer_key", "last_ts", F.coalesce("frequency", F.lit(0)).alias("frequency"), "monetary_total")
    both = load.old("customer_totals").unionByName(added).groupBy("customer_key").agg(
        F.max("last_ts").alias("last_ts"), F.sum("frequency").alias("frequency"), F.sum("monetary_total").alias("monetary_total"))
    totals = load.replace("customer_totals", both)
    totals = totals.withColumn("monetary_total", F.col("monetary_total").cast("decimal(14,2)"))
    load.replace("mart_customer_rfm", marts.scored_customers(totals, load.new("dim_customer"), load.stage))


def _retention(load: _Load, lines: DataFrame) -> None:
    """Orders go on where the customers' histories end; only a late order makes all histories be placed anew, from the orders."""
    orders = load.append("orders", facts.customer_orders(lines))
    moment = F.struct("order_date", "InvoiceNo", "date_key")
    history = orders.groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.min("order_date").alias("first_date"), F.max(moment).alias("last"))
    ends = load.old("customer_orders")
    people = load.new("customer_keys")
    started = load.has("customer_orders")
    late = started and not orders.join(ends, "customer_id").filter(moment <= F.col("last")).isEmpty()
    if late:
        whole = load.new("orders").groupBy("customer_id", "InvoiceNo", "date_key").agg(
            F.min("order_date").alias("order_date"), F.sum("order_value").alias("order_value"))
        placed = facts.placed_orders(whole, load.stage)
        load.replace("fact_customer_retention", facts.named_retention(placed, people))
        load.replace("customer_orders", whole.groupBy("customer_id").agg(
            F.count("*").alias("orders"), F.min("order_date").alias("first_date"), F.max(moment).alias("last")))
        return
    placed = facts.placed_orders(orders, load.stage)
    if started:
        top = ends.agg(F.sum("orders")).first()[0] or 0
        before = ends.select("customer_id", "orders", F.col("first_date").alias("began"), F.col("last.order_date").alias("ended"))
        before = load.stage.table(before.join(history.select("customer_id"), "customer_id"), "histories")
        placed = lookup_join(placed, before, "customer_id").withColumns({
            "order_sequence": F.col("order_sequence") + F.coalesce("orders", F.lit(0)),
            "prior_date": F.coalesce("prior_date", "ended"), "first_date": F.coalesce("began", "first_date"),
            "retention_key": F.col("retention_key") + top})
    load.append("fact_customer_retention", facts.named_retention(placed, people, orders))
    load.replace("customer_orders", ends.unionByName(history).groupBy("customer_id").agg(
        F.sum("orders").alias("orders"), F.min("first_date").alias("first_date"), F.max("last").alias("last")))


def _products(load: _Load, lines: DataFrame, keys: DataFrame) -> None:
    """Products of the batch described anew from all their variants; the others stay as they are."""
    variants = load.append("product_variants", dims.product_variants(lines))
    codes = load.stage.table(variants.select("StockCode").distinct(), "sold-codes")
    if load.has("product_variants"):
        few = F.broadcast(codes) if fits_broadcast(codes) else codes
        variants = load.new("product_variants").join(few, "StockCode", "left_semi")
    made = conform(lookup_join(dims.described_products(variants), keys, "stock_code"), "dim_product")
    if load.has("dim_product"):
        old = load.old("dim_product")
        made = made.unionByName(old.join(codes.select(F.col("StockCode").alias("stock_code")), "stock_code", "left_anti"))
    load.replace("dim_product", made)


def add(
    spark: SparkSession, root: str, ids: Sequence[str], master: DataFrame | None, stage: Stage, base: versions.Version,
) -> dict[str, int] | None:
    """Add loaded batches to a version and publish the result; rows of the eight tables, or None if a build is needed."""
    with stage.passing() as passing:  # what is written on the way is read by this load only
        return _add(_Load(spark, root, base, passing), ids, master)


def _add(load: _Load, ids: Sequence[str], master: DataFrame | None) -> dict[str, int] | None:
    spark, root, base, stage = load.spark, load.root, load.base, load.stage
    lines, older = _fresh_lines(load, loaded_lines(spark, root).filter(F.col("batch_id").isin(list(ids))), ids)
    if lines is None:
        return None
    laid = lay_out(lines, SALES_ORDER, stage, "new-lines")
    lines = laid.df.select(*laid.plain)
    top = load.old("batch_days").agg(F.sum("lines")).first()[0] or 0
    load.append("batch_days", lines.groupBy("batch_id", "date_key").agg(F.count("*").alias("lines")))

    def customers():
        ids_ = lines.select("customer_id").filter("customer_id is not null").distinct()
        known = ids_ if master is None else ids_.unionByName(master.select(F.col("customer_id").cast("bigint"))).distinct()
        keys = load.keys("customer_keys", known.filter("customer_id is not null"))
        profiles = dims.customer_profiles(keys.select("customer_id"), master)
        load.replace("dim_customer", lookup_join(profiles, keys, "customer_id"))

    def products():
        codes = lines.select(F.col("StockCode").alias("stock_code")).distinct()
        _products(load, lines, load.keys("product_keys", codes))

    def places():
        names = lines.select(F.col("Country").alias("country_name")).filter("country_name is not null").distinct()
        load.replace("dim_geography", dims.regions_of(load.keys("geography_keys", names)))

    def dates():
        day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
        load.replace("dim_date", dims.calendar_of(load.new("batch_days").agg(F.min(day).alias("low"), F.max(day).alias("high"))))

    def together(*jobs):
        with ThreadPoolExecutor(len(jobs)) as pool:
            for job in [pool.submit(j) for j in jobs]:
                job.result()

    together(customers, products, places, dates)
    ranked = (laid.ranked("sales_key", some).withColumn("sales_key", F.col("sales_key") + top) for some in laid.turns())
    fact = (facts.build_fact_sales(
        some, load.new("customer_keys"), load.new("product_keys"), load.new("geography_keys"), stage) for some in ranked)
    fact = load.append("fact_sales", fact)
    cells = load.append("sold_invoices", marts.sold_invoices(fact, "batch_id"))
    load.append("customer_days", bitmaps_of(fact, "customer_key", "date_key", "batch_id"))
    together(lambda: _sales_mart(load, cells, ids, older), lambda: _customer_mart(load, fact), lambda: _retention(load, lines))
    versions.publish(spark, root, base, load.changed)
    return {n: load.new(n).count() for n in WAREHOUSE_TABLES}  # from the files' footers


def customers_between(spark: SparkSession, root: str, first: int, last: int, *by: str) -> DataFrame:
    """Distinct customers (the guest counts as one) with lines from day ``first`` to ``last``, from the stored bitmaps.

    ``by`` may name ``date_key`` or ``year_month``; days and batches merge exactly.
    """
    days = read(spark, root, "customer_days").filter(F.col("date_key").between(first, last))
    month = F.concat_ws("-", F.lpad((F.col("date_key") / 10000).cast("int").cast("string"), 4, "0"), F.substring(
        F.col("date_key").cast("string"), 5, 2))
    return distinct_keys(days.withColumn("year_month", month), "customers", *by)


def refresh(
    spark: SparkSession, root: str, ids: Sequence[str], master: DataFrame | None, stage: Stage | None = None,
) -> dict[str, int]:
    """Bring the tables up to date with batches that were just loaded."""
    stage = stage or Stage(spark)
    base = versions.current(spark, root)
    if base.folders.get("batch_days"):
        known = {r[0] for r in read(spark, root, "batch_days", base).select("batch_id").distinct().collect()}  # one a batch
        if not known & set(ids):
            added = add(spark, root, ids, master, stage, base)
            if added is not None:
                return added
    return build(spark, root, master, stage)


def build(spark: SparkSession, root: str, master: DataFrame | None, stage: Stage | None = None) -> dict[str, int]:
    """All tables from all loaded lines; nothing of the version before is read."""
    all_ids = sorted(r[0] for r in loaded_lines(spark, root).select("batch_id").distinct().collect())
    base = versions.current(spark, root)
    return add(spark, root, all_ids, master, stage or Stage(spark), versions.Version(base.number, {}))


def differences(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """Rows that two warehouses do not share, by table, compared by what keys stand for instead of their numbers."""
    counts = []
    for name in NATURAL:
        a, b = natural(left, name), natural(right, name)
        n = a.exceptAll(b).unionAll(b.exceptAll(a)).agg(F.count("*").alias("rows"))
        counts.append(n.select(F.lit(name).alias("table_name"), "rows"))
    return reduce(DataFrame.unionAll, counts)


#: Surrogate keys of each table, and the columns that stand for them.
NATURAL = {
    "dim_customer": ({"customer_key": None}), "dim_product": ({"product_key": None}), "dim_geography": ({"geography_key": None}),
    "dim_date": {}, "fact_sales": {"sales_key": None, "customer_key": ("dim_customer", "customer_id"),
                                   "product_key": ("dim_product", "stock_code"), "geography_key": ("dim_geography", "country_name")},
    "fact_customer_retention": {"retention_key": None, "customer_key": ("dim_customer", "customer_id")},
    "mart_sales_performance": {"mart_id": None}, "mart_customer_rfm": {"customer_key": None},
}


def natural(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """A table with what its surrogate keys stand for in their place; its own key is left out."""
    df = tables[name]
    for key, stands in NATURAL[name].items():
        if stands:
            dim, column = stands
            df = lookup_join(df, tables[dim].select(key, column), key)
        df = df.drop(key)
    return df
