"""Table schemas, declared constraints and domain constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Raw line columns, validity bounds, guest identity.
RAW_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity",
    "InvoiceDate", "UnitPrice", "CustomerID", "Country",
]
MAX_QUANTITY = 50000
MAX_PRICE = 50000.0
GUEST_ID = 0
GUEST_CODE = "GUEST_UNREGISTERED"
FULL_BATCH = "full_historical_baseline"

# Lines sharing these values are copies of one another; together they also order the sales fact.
LINE_KEYS = ["InvoiceNo", "StockCode", "Quantity", "UnitPrice", "InvoiceDate"]
SALES_ORDER = ["InvoiceDate", "InvoiceNo", "StockCode", "Quantity", "UnitPrice"]

# Place of a line in its file, when the source can tell; the first of several copies is the one kept.
SOURCE_COLUMNS = ["_source_file", "_source_row"]

# Text of a CSV record that does not have as many values as columns; null for whole ones.
BROKEN_RECORD = "_broken_record"

REJECT_COLUMNS = [
    "batch_id", "InvoiceNo", "StockCode", "Description", "Quantity",
    "UnitPrice", "CustomerID", "Country", "rejection_reason", "logged_at",
]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


# Declared columns and types; a trailing "!" marks a column declared not null.
TABLES: dict[str, dict[str, str]] = {
    "dim_customer": dict(
        customer_key="bigint!", customer_id="bigint", customer_code="string!", gender="string",
        age_group="string", loyalty_tier="string", signup_date="date", preferred_device="string",
        country="string"),
    "dim_product": dict(
        product_key="bigint!", stock_code="string", description="string", category="string",
        unit_price_nominal="decimal(10,2)"),
    "dim_geography": dict(
        geography_key="bigint!", country_name="string", region="string", market_tier="string"),
    "dim_date": dict(
        date_key="int!", full_date="date", year="int!", quarter="int!", month="int!",
        month_name="string!", day="int!", day_of_week="int!", day_name="string!", is_weekend="boolean!"),
    "fact_sales": dict(
        sales_key="bigint!", invoice_no="string!", customer_key="bigint!", product_key="bigint!",
        geography_key="bigint!", date_key="int!", invoice_timestamp="timestamp_ntz!", quantity="int!",
        unit_price="decimal(10,2)!", total_amount="decimal(12,2)!", is_cancelled="boolean", batch_id="string"),
    "fact_customer_retention": dict(
        retention_key="bigint!", customer_key="bigint!", date_key="int!", cohort_month="string!",
        order_sequence="int!", days_since_prior_order="int", order_value="decimal(12,2)!",
        is_repeat_customer="boolean!"),
    "mart_sales_performance": dict(
        mart_id="bigint!", date_key="int!", year_month="string!", country_name="string!",
        total_revenue="decimal(14,2)!", total_orders="bigint!", total_units_sold="bigint!",
        average_order_value="decimal(10,2)!", unique_customers="bigint!", cancelled_orders_count="bigint!"),
    "mart_customer_rfm": dict(
        customer_key="bigint!", customer_id="bigint", recency_days="int!", frequency="bigint!",
        monetary_total="decimal(14,2)!", r_score="int!", f_score="int!", m_score="int!",
        rfm_score="string!", customer_segment="string!", loyalty_tier="string", last_order_date="date"),
    "etl_audit_log": dict(
        audit_id="bigint!", batch_id="string!", source_file="string!", extraction_timestamp="timestamp_ntz!",
        raw_row_count="bigint!", cleaned_row_count="bigint!", rejected_row_count="bigint!",
        status="string!", execution_duration_sec="decimal(8,2)!", notes="string"),
    "etl_rejection_log": dict(
        rejection_id="bigint!", batch_id="string!", invoice_no="string", stock_code="string",
        quantity="string", unit_price="string", customer_id="string", rejection_reason="string!",
        logged_at="timestamp_ntz"),
}

# First entry of each list is the primary key; the rest are unique columns.
UNIQUE_COLUMNS = {
    "dim_customer": ["customer_key", "customer_id"],
    "dim_product": ["product_key", "stock_code"],
    "dim_geography": ["geography_key", "country_name"],
    "dim_date": ["date_key", "full_date"],
    "fact_sales": ["sales_key"],
    "fact_customer_retention": ["retention_key"],
    "mart_sales_performance": ["mart_id"],
    "mart_customer_rfm": ["customer_key", "customer_id"],
    "etl_audit_log": ["audit_id"],
    "etl_rejection_log": ["rejection_id"],
}

# (table, column, referenced table); the referenced column has the same name.
FOREIGN_KEYS = [
    ("fact_sales", "customer_key", "dim_customer"),
    ("fact_sales", "product_key", "dim_product"),
    ("fact_sales", "geography_key", "dim_geography"),
    ("fact_sales", "date_key", "dim_date"),
    ("fact_customer_retention", "customer_key", "dim_customer"),
    ("fact_customer_retention", "date_key", "dim_date"),
    ("mart_sales_performance", "date_key", "dim_date"),
    ("mart_customer_rfm", "customer_key", "dim_customer"),
]

# Stored tables that are cut into folders, and the column that says which.
PARTITION_KEYS = {"fact_sales": "batch_id", "mart_sales_performance": "year_month"}

WAREHOUSE_TABLES = [
    "dim_customer", "dim_product", "dim_geography", "dim_date", "fact_sales",
    "fact_customer_retention", "mart_sales_performance", "mart_customer_rfm",
]


def column_types(table: str) -> dict[str, str]:
    return {name: spec.rstrip("!") for name, spec in TABLES[table].items()}


def required_columns(table: str) -> list[str]:
    return [name for name, spec in TABLES[table].items() if spec.endswith("!")]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast ``df`` to the declared columns of ``table``."""
    return df.select(*[df[n].cast(t).alias(n) for n, t in column_types(table).items()])


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in column_types(table).items()))
