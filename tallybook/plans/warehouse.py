"""The star schema over one source of raw lines, each table built on first use and written once."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators import quality
from tallybook.operators.cleaning import clean_and_transform
from tallybook.operators.ordering import Ordered, lay_out
from tallybook.plans import dims, facts, marts
from tallybook.schemas import FULL_BATCH, SALES_ORDER, TABLES, WAREHOUSE_TABLES
from tallybook.staging import Stage


class Warehouse:
    """Tables of one load.

    Written tables feed more than one later plan; everything else stays a lazy plan.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: DataFrame,
        master: DataFrame | None = None,
        batch_id: Column | str = FULL_BATCH,
        stage: Stage | None = None,
        raw_is_stored: bool = False,
        gated: quality.Gated | None = None,
    ):
        self.spark, self.master, self.batch_id = spark, master, batch_id
        self.stage = stage or Stage(spark)
        self._raw, self._raw_is_stored, self._gated_once = raw, raw_is_stored, gated

    @classmethod
    def from_lines(
        cls, spark: SparkSession, lines: DataFrame, master: DataFrame | None, stage: Stage | None = None
    ) -> Warehouse:
        """A warehouse over lines that are cleaned already."""
        wh = cls(spark, lines, master, stage=stage, raw_is_stored=True)
        wh._laid_lines = lay_out(lines, SALES_ORDER, wh.stage, "lines")
        return wh

    def build(self) -> None:
        """Build every table, independent ones at the same time."""
        self._laid_lines
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(self.table, ["dim_customer", "dim_product", "dim_geography", "dim_date"]))
            retention = pool.submit(self.table, "fact_customer_retention")
            self.fact_sales
            list(pool.map(self.table, ["mart_sales_performance", "mart_customer_rfm"]))
            retention.result()

    @cached_property
    def raw(self) -> DataFrame:
        """Landed lines: read once for clean lines and once for rejects."""
        return self._raw if self._raw_is_stored else self.stage.table(self._raw, "landing")

    @cached_property
    def gated(self) -> DataFrame:
        return quality.gate(self.raw)

    @cached_property
    def clean(self) -> DataFrame:
        return self._gated_once.clean if self._gated_once else quality.clean_lines(self.raw)

    def rejected(self, batch_id: Column | str | None = None, logged_at: Column | None = None) -> DataFrame:
        batch = self.batch_id if batch_id is None else batch_id
        logged = F.current_timestamp().cast("timestamp_ntz") if logged_at is None else logged_at
        if self._gated_once:
            return self._gated_once.rejected(batch, logged)
        return quality.rejected_lines(self.raw, batch, logged)

    @cached_property
    def _laid_lines(self) -> Ordered:
        # Copies are of one moment, so each turn drops its own.
        turns = self._gated_once.clean_in_turns() if self._gated_once else [self.clean]
        return lay_out([clean_and_transform(t, self.batch_id) for t in turns], SALES_ORDER, self.stage, "lines")

    @cached_property
    def transactions(self) -> DataFrame:
        """Clean, deduplicated lines, stored in sales order."""
        return self._laid_lines.df.select(*self._laid_lines.plain)

    @cached_property
    def line_count(self) -> int:
        return self._laid_lines.rows

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.stage.table(dims.build_dim_date(self.transactions), "dim_date")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.stage.table(
            dims.build_dim_customer(self.transactions, self.master, self.stage), "dim_customer")

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.stage.table(dims.build_dim_product(self.transactions, self.stage), "dim_product")

    @cached_property
    def dim_geography(self) -> DataFrame:
        return self.stage.table(dims.build_dim_geography(self.transactions, self.stage), "dim_geography")

    @cached_property
    def fact_sales(self) -> DataFrame:
        laid = self._laid_lines
        fact = (facts.build_fact_sales(
            laid.ranked("sales_key", some), self.dim_customer, self.dim_product, self.dim_geography, self.stage)
            for some in laid.turns())
        return self.stage.table(fact, "fact_sales")

    @cached_property
    def fact_customer_retention(self) -> DataFrame:
        fact = facts.build_fact_customer_retention(self.transactions, self.dim_customer, self.stage)
        return self.stage.table(fact, "fact_customer_retention")

    @cached_property
    def mart_sales_performance(self) -> DataFrame:
        mart = marts.build_mart_sales_performance(
            self.fact_sales, self.dim_date, self.dim_geography, self.stage)
        return self.stage.table(mart, "mart_sales_performance")

    @cached_property
    def mart_customer_rfm(self) -> DataFrame:
        mart = marts.build_mart_customer_rfm(self.fact_sales, self.dim_customer, self.stage)
        return self.stage.table(mart, "mart_customer_rfm")

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        return getattr(self, name)

    def register_views(self) -> None:
        """Make the eight tables available to SQL under their own names."""
        for name in WAREHOUSE_TABLES:
            self.table(name).createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, params: dict | None = None) -> DataFrame:
    """SQL with named parameters over the registered tables."""
    return spark.sql(text, args=params or {})
