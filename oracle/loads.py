"""DuckDB form of the queries over loaded and kept-up warehouses, and over CSV with line breaks."""

from __future__ import annotations

from oracle.base import ratio, with_tables

_D = "CAST({0} AS DOUBLE) AS {0}"
_BROKEN = "Quantity LIKE '%3' AND contains(Description, ' ')"
_REASONS = ["NULL_OR_EMPTY_INVOICE_NO", "NULL_OR_EMPTY_STOCK_CODE", "INVALID_OR_ZERO_UNIT_PRICE",
            "INVALID_OR_ZERO_QUANTITY", "INVALID_INVOICE_DATE_FORMAT"]


def _double(*names: str) -> str:
    return ", ".join(_D.format(n) for n in names)


def sql_by_query() -> dict[str, str]:
    late = "(SELECT batch_id FROM manifest ORDER BY batch_id LIMIT 1 OFFSET (SELECT COUNT(*) // 2 FROM manifest))"
    month = "'batch_' || strftime(f.invoice_timestamp, '%Y_%m')"
    q = {
        "upkept_dim_customer": "SELECT * EXCLUDE (customer_key) FROM dim_customer",
        "upkept_dim_product": "SELECT * EXCLUDE (product_key) FROM dim_product",
        "upkept_dim_geography": "SELECT * EXCLUDE (geography_key) FROM dim_geography",
        "upkept_dim_date": "SELECT * FROM dim_date",
        "upkept_fact_sales": f"""SELECT c.customer_id, p.stock_code, g.country_name, f.invoice_no, f.date_key, f.invoice_timestamp,
            f.quantity, {_double('unit_price', 'total_amount')}, f.is_cancelled,
            CASE WHEN {month} = {late} AND f.invoice_no LIKE '%7' THEN 'batch_late' ELSE {month} END AS batch_id
          FROM fact_sales f JOIN dim_customer c USING (customer_key) JOIN dim_product p USING (product_key)
          JOIN dim_geography g USING (geography_key)""",
        "upkept_fact_customer_retention": f"""SELECT c.customer_id, r.date_key, r.cohort_month, r.order_sequence,
            r.days_since_prior_order, {_double('order_value')}, r.is_repeat_customer
          FROM retention r JOIN dim_customer c USING (customer_key)""",
        "upkept_mart_sales_performance": f"SELECT * EXCLUDE (mart_id) REPLACE ({_double('total_revenue')}) FROM mart_sales",
        "upkept_mart_customer_rfm": f"SELECT * EXCLUDE (customer_key) REPLACE ({_double('monetary_total')}) FROM rfm",
        "customers_by_month": """SELECT strftime(invoice_timestamp, '%Y-%m') AS year_month, COUNT(DISTINCT customer_key) AS customers
          FROM fact_sales GROUP BY 1""",
        "customers_in_range": """SELECT COUNT(DISTINCT customer_key) AS customers FROM fact_sales
          WHERE date_key BETWEEN 19930315 AND 19960210""",
        "csv_line_breaks": rf"""SELECT InvoiceNo, StockCode, CASE WHEN {_BROKEN}
            THEN regexp_replace(Description, '^([^ ]*) ', '\1' || chr(10)) ELSE Description END AS Description, Quantity, InvoiceDate,
            UnitPrice, CustomerID, Country FROM gated WHERE rejection_reason IS NULL""",
        "csv_broken_records": f"""SELECT 'full_historical_baseline' AS batch_id, n + broken AS total_records, valid AS valid_records,
            n + broken - valid AS rejected_records, {ratio('(valid * 100)', '(n + broken)')} AS pass_rate_pct,
            2 * broken AS broken_csv_record, {", ".join(r.lower() for r in _REASONS)}
          FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER ({_BROKEN}) AS broken,
            COUNT(*) FILTER (NOT COALESCE({_BROKEN}, FALSE) AND rejection_reason IS NULL) AS valid,
            {", ".join(f"COUNT(*) FILTER (NOT COALESCE({_BROKEN}, FALSE) AND rejection_reason = '{r}') AS {r.lower()}" for r in _REASONS)}
          FROM gated)""",
    }
    return {name: with_tables(sql) for name, sql in q.items()}
