"""DuckDB form of every registered query that SQL can express."""

from __future__ import annotations

from oracle import loads
from oracle.base import category, mean_amount, ratio, region, segment, share, tier, title, with_tables

_RAW = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"
_D = "CAST({0} AS DOUBLE) AS {0}"


def _double(*names: str) -> str:
    return ", ".join(_D.format(n) for n in names)


def _psi(source: str) -> str:
    """PSI, KS and means per feature of ``source`` (feature, value, side b/c)."""
    return f"""
  vals AS ({source}),
  sizes AS (SELECT feature, COUNT(*) FILTER (side = 'b') AS nb, COUNT(*) FILTER (side = 'c') AS nc,
      MIN(value) AS lo, MAX(value) AS hi, AVG(value) FILTER (side = 'b') AS mean_b,
      AVG(value) FILTER (side = 'c') AS mean_c FROM vals GROUP BY feature),
  cuts AS (SELECT feature, list_sort(list_distinct(quantile_cont(value,
      [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM vals WHERE side = 'b' GROUP BY feature),
  bins AS (SELECT c.feature, i AS bin, len(c.e) - 1 AS bins,
      CASE WHEN i = 1 THEN s.lo - 1e-5 ELSE c.e[i] END AS a,
      CASE WHEN i = len(c.e) - 1 THEN s.hi + 1e-5 ELSE c.e[i + 1] END AS z
    FROM cuts c JOIN sizes s ON s.feature = c.feature, UNNEST(range(1, len(c.e))) AS u(i)),
  filled AS (SELECT b.feature, b.bin,
      COUNT(v.value) FILTER (v.side = 'b') AS xb, COUNT(v.value) FILTER (v.side = 'c') AS xc
    FROM bins b LEFT JOIN vals v ON v.feature = b.feature AND v.value >= b.a
      AND (v.value < b.z OR (b.bin = b.bins AND v.value <= b.z)) GROUP BY 1, 2),
  shares AS (SELECT f.feature, CASE WHEN xb = 0 THEN 1e-4 ELSE CAST(xb AS DOUBLE) END / s.nb AS p,
      CASE WHEN xc = 0 THEN 1e-4 ELSE CAST(xc AS DOUBLE) END / s.nc AS q
    FROM filled f JOIN sizes s ON s.feature = f.feature),
  psis AS (SELECT feature, SUM((p - q) * LN(p / q)) AS psi FROM shares GROUP BY feature),
  curve AS (SELECT feature, value, SUM(xb) OVER w AS cb, SUM(xc) OVER w AS cc FROM (
      SELECT feature, value, COUNT(*) FILTER (side = 'b') AS xb, COUNT(*) FILTER (side = 'c') AS xc
      FROM vals GROUP BY 1, 2) WINDOW w AS (PARTITION BY feature ORDER BY value)),
  kss AS (SELECT c.feature, MAX(ABS(CAST(cb AS DOUBLE) / s.nb - CAST(cc AS DOUBLE) / s.nc)) AS ks
    FROM curve c JOIN sizes s ON s.feature = c.feature GROUP BY 1)"""


_DRIFT_OUT = """
SELECT s.feature, s.nb, s.nc, ROUND(COALESCE(p.psi, 0.0), 4) AS psi_score, ROUND(k.ks, 4) AS ks_statistic,
  ROUND(s.mean_b, 2) AS baseline_mean, ROUND(s.mean_c, 2) AS current_mean
FROM sizes s JOIN kss k ON k.feature = s.feature LEFT JOIN psis p ON p.feature = s.feature"""

# The p-value is the asymptotic Kolmogorov series of the statistic scaled by both sizes.
_ALERTS = """measured AS (SELECT s.feature, COALESCE(p.psi, 0.0) AS psi, k.ks, s.mean_b, s.mean_c,
    SQRT(CAST(s.nb AS DOUBLE) * s.nc / (s.nb + s.nc)) * k.ks AS x
    FROM sizes s JOIN kss k ON k.feature = s.feature LEFT JOIN psis p ON p.feature = s.feature
    WHERE s.nb >= 5 AND s.nc >= 5),
  tested AS (SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE LEAST(1.0, GREATEST(0.0, 2 * list_sum(
    [(CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * EXP(-2 * i * i * x * x) FOR i IN range(1, 101)]))) END AS p FROM measured),
  alerts AS (SELECT feature, ROUND(psi, 4) AS psi_score, ROUND(ks, 4) AS ks_statistic, ROUND(p, 5) AS p_value,
    ROUND(mean_b, 2) AS baseline_mean, ROUND(mean_c, 2) AS current_mean,
    CASE WHEN ROUND(psi, 4) >= 0.25 OR p < 0.01 THEN 'HIGH DRIFT (ALERT)'
      WHEN ROUND(psi, 4) >= 0.10 OR p < 0.05 THEN 'MODERATE DRIFT (WARNING)' ELSE 'STABLE (NO DRIFT)' END AS alert_level
    FROM tested)"""

_NUMERIC = ["recency_days", "frequency_orders", "monetary_spend", "avg_order_value", "total_units",
            "cancellation_rate", "inter_purchase_mean", "inter_purchase_std", "product_variety"]
_SIDE = "CASE WHEN substr(md5(CAST(customer_id AS STRING) || ':42'), 1, 6) < '99999a' THEN 'b' ELSE 'c' END"
_FEATURE_VALUES = " UNION ALL ".join(
    f"SELECT '{n}' AS feature, CAST({n} AS DOUBLE) AS value, {_SIDE} AS side FROM features" for n in _NUMERIC)


def _append(more: str, out: str) -> str:
    """Add CTEs after the shared ones."""
    full = with_tables(more + out)
    head, _, tail = full.partition(more.strip())
    head = head.rstrip()
    joiner = ",\n" if head.startswith("WITH") else "WITH "
    return f"{head}{joiner}{more.strip()}\n{out.strip()}"


# Declared required and unique columns of each table.
_REQUIRED = {
    "dim_customer": ["customer_key", "customer_code"],
    "dim_product": ["product_key"],
    "dim_geography": ["geography_key"],
    "dim_date": ["date_key", "year", "quarter", "month", "month_name", "day", "day_of_week", "day_name", "is_weekend"],
    "fact_sales": ["sales_key", "invoice_no", "customer_key", "product_key", "geography_key", "date_key", "invoice_timestamp",
                   "quantity", "unit_price", "total_amount"],
    "fact_customer_retention": ["retention_key", "customer_key", "date_key", "cohort_month", "order_sequence", "order_value",
                                "is_repeat_customer"],
    "mart_sales_performance": ["mart_id", "date_key", "year_month", "country_name", "total_revenue", "total_orders",
                               "total_units_sold", "average_order_value", "unique_customers", "cancelled_orders_count"],
    "mart_customer_rfm": ["customer_key", "recency_days", "frequency", "monetary_total", "r_score", "f_score", "m_score",
                          "rfm_score", "customer_segment"],
    "etl_rejection_log": ["rejection_id", "batch_id", "rejection_reason"],
    "etl_audit_log": ["audit_id", "batch_id", "source_file", "extraction_timestamp", "raw_row_count", "cleaned_row_count",
                      "rejected_row_count", "status", "execution_duration_sec"],
}
_UNIQUE = {
    "dim_customer": ["customer_key", "customer_id"], "dim_product": ["product_key", "stock_code"],
    "dim_geography": ["geography_key", "country_name"], "dim_date": ["date_key", "full_date"], "fact_sales": ["sales_key"],
    "fact_customer_retention": ["retention_key"], "mart_sales_performance": ["mart_id"],
    "mart_customer_rfm": ["customer_key", "customer_id"], "etl_rejection_log": ["rejection_id"], "etl_audit_log": ["audit_id"],
}


def _constraints() -> str:
    cte = {
        "fact_customer_retention": "retention", "mart_sales_performance": "mart_sales", "mart_customer_rfm": "rfm",
        "etl_rejection_log": "(SELECT ROW_NUMBER() OVER () AS rejection_id, * FROM rejected)",
        # The log of one finished load: one row, nothing missing.
        "etl_audit_log": "(SELECT " + ", ".join(f"1 AS {c}" for c in _REQUIRED["etl_audit_log"]) + ")"}
    parts = []
    for t, required in _REQUIRED.items():
        src = cte.get(t, t)
        for c in required:
            parts.append(f"SELECT '{t}' AS table_name, 'not_null' AS constraint_type, '{c}' AS column_name, "
                         f"COUNT(*) FILTER ({c} IS NULL) AS violations FROM {src}")
        for c in _UNIQUE[t]:
            parts.append(f"SELECT '{t}', 'unique', '{c}', COUNT({c}) - COUNT(DISTINCT {c}) FROM {src}")
    for t, c, parent in [
        ("fact_sales", "customer_key", "dim_customer"), ("fact_sales", "product_key", "dim_product"),
        ("fact_sales", "geography_key", "dim_geography"), ("fact_sales", "date_key", "dim_date"),
        ("fact_customer_retention", "customer_key", "dim_customer"),
        ("fact_customer_retention", "date_key", "dim_date"), ("mart_sales_performance", "date_key", "dim_date"),
        ("mart_customer_rfm", "customer_key", "dim_customer"),
    ]:
        parts.append(f"SELECT '{t}', 'foreign_key', '{c}', COUNT(*) FROM {cte.get(t, t)} x "
                     f"WHERE NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{c} = x.{c})")
    return "\nUNION ALL ".join(parts)


_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {src}" for t, src in [
        ("dim_customer", "dim_customer"), ("dim_product", "dim_product"), ("dim_geography", "dim_geography"),
        ("dim_date", "dim_date"), ("fact_sales", "fact_sales"), ("fact_customer_retention", "retention"),
        ("mart_sales_performance", "mart_sales"), ("mart_customer_rfm", "rfm")])

_REASONS = ["NULL_OR_EMPTY_INVOICE_NO", "NULL_OR_EMPTY_STOCK_CODE", "INVALID_OR_ZERO_UNIT_PRICE",
            "INVALID_OR_ZERO_QUANTITY", "INVALID_INVOICE_DATE_FORMAT"]

_GEO = f"""SELECT country_name, region, market_tier, CAST(SUM(total_revenue) AS DOUBLE) AS revenue,
  CAST(SUM(total_orders) AS BIGINT) AS orders, CAST(SUM(total_units_sold) AS BIGINT) AS units,
  CAST(SUM(unique_customers) AS BIGINT) AS customers FROM sales_view"""

_SALES_VIEW = (f"SELECT mart_id, date_key, year_month, country_name, {_double('total_revenue')}, total_orders, "
               "total_units_sold, average_order_value, unique_customers, cancelled_orders_count, year, month, "
               "month_name, full_date, day_name, is_weekend, region, market_tier FROM sales_view")
_PROFILE = (f"SELECT customer_key, customer_id, recency_days, frequency, {_double('monetary_total')}, r_score, f_score, "
            "m_score, rfm_score, customer_segment, loyalty_tier, last_order_date, gender, age_group, "
            "preferred_device, country FROM profiles")

_CONFUSION = """SELECT COUNT(*) FILTER (label = 1 AND score >= 0.5) AS tp, COUNT(*) FILTER (label = 0 AND score >= 0.5) AS fp,
    COUNT(*) FILTER (label = 1 AND score < 0.5) AS fn, COUNT(*) FILTER (label = 0 AND score < 0.5) AS tn,
    AVG(-CASE WHEN label = 1 THEN LN(p) ELSE LN(1 - p) END) AS loss
  FROM (SELECT label, score, LEAST(GREATEST(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM label_scores)"""

_SCORING = """SELECT CAST(customer_id AS STRING) AS customer_id,
    CASE WHEN customer_id % 31 = 0 THEN NULL WHEN customer_id % 37 = 0 THEN -1.0 ELSE CAST(recency_days AS DOUBLE) END AS recency_days,
    CASE WHEN customer_id % 41 = 0 THEN 0.0 ELSE CAST(frequency_orders AS DOUBLE) END AS frequency_orders,
    CAST(monetary_spend AS DOUBLE) AS monetary_spend, CAST(avg_order_value AS DOUBLE) AS avg_order_value,
    CAST(total_units AS DOUBLE) AS total_units,
    COALESCE(CASE WHEN customer_id % 43 = 0 THEN 1.5 WHEN customer_id % 3 = 0 THEN NULL ELSE CAST(cancellation_rate AS DOUBLE) END, 0.0) AS cancellation_rate,
    COALESCE(CASE WHEN customer_id % 5 = 0 THEN NULL ELSE CAST(inter_purchase_mean AS DOUBLE) END, 30.0) AS inter_purchase_mean,
    COALESCE(CASE WHEN customer_id % 11 = 0 THEN NULL ELSE CAST(inter_purchase_std AS DOUBLE) END, 10.0) AS inter_purchase_std,
    COALESCE(CASE WHEN customer_id % 7 = 0 THEN NULL ELSE CAST(product_variety AS DOUBLE) END, 5.0) AS product_variety,
    COALESCE(gender, 'Unknown') AS gender, COALESCE(age_group, '36-50') AS age_group,
    COALESCE(loyalty_tier, 'Bronze') AS loyalty_tier, COALESCE(preferred_device, 'Desktop Web') AS preferred_device,
    COALESCE(country, 'United Kingdom') AS country FROM features"""

_QUOTAS = """
  sized AS (SELECT is_churned, COUNT(*) AS n FROM features GROUP BY 1),
  total AS (SELECT CAST(SUM(n) AS BIGINT) AS n, CAST(CEIL(CAST(0.2 AS DOUBLE) * SUM(n)) AS BIGINT) AS test FROM sized),
  goal AS (SELECT n, test, CAST(CEIL(CAST(0.15 AS DOUBLE) / (1.0::DOUBLE - 0.2::DOUBLE) * (n - test)) AS BIGINT) AS val FROM total),
  t1 AS (SELECT s.is_churned, s.n, (g.test * s.n) // g.n AS fl, (g.test * s.n) % g.n AS rem, g.test AS want FROM sized s, goal g),
  t2 AS (SELECT *, fl + CASE WHEN ROW_NUMBER() OVER (ORDER BY rem DESC, is_churned) <= want - SUM(fl) OVER () THEN 1 ELSE 0 END AS test_q FROM t1),
  v1 AS (SELECT t.is_churned, t.n, t.test_q, (g.val * (t.n - t.test_q)) // (g.n - g.test) AS fl,
      (g.val * (t.n - t.test_q)) % (g.n - g.test) AS rem, g.val AS want FROM t2 t, goal g),
  v2 AS (SELECT *, fl + CASE WHEN ROW_NUMBER() OVER (ORDER BY rem DESC, is_churned) <= want - SUM(fl) OVER () THEN 1 ELSE 0 END AS val_q FROM v1),
  marked AS (SELECT customer_id, is_churned, ROW_NUMBER() OVER (PARTITION BY is_churned
      ORDER BY md5(CAST(customer_id AS STRING) || ':42'), customer_id) AS rn FROM features),
  assigned AS (SELECT m.customer_id, m.is_churned, CASE WHEN m.rn <= v.test_q THEN 'test'
      WHEN m.rn <= v.test_q + v.val_q THEN 'val' ELSE 'train' END AS split FROM marked m JOIN v2 v ON v.is_churned = m.is_churned)"""


def sql_by_query() -> dict[str, str]:
    q: dict[str, str] = {}
    # sources and batches
    q["extract_metadata"] = f"""SELECT 'full_historical_baseline' AS batch_id, 'retail_raw' AS source_file,
      TRUE AS extraction_timestamp, COUNT(*) AS raw_row_count, '{_RAW.replace(" ", "")}' AS raw_columns, 8 AS raw_column_count,
      'EXTRACTED' AS status FROM retail_raw"""
    q["landing_text"] = """SELECT InvoiceNo, StockCode, COALESCE(Description, '') AS Description, Quantity, InvoiceDate,
      UnitPrice, CustomerID, COALESCE(Country, '') AS Country FROM retail_raw"""
    q["full_source_lines"] = f"SELECT *, 'full_historical_baseline' AS batch_id FROM ({q['landing_text']})"
    q["ingestion_log"] = f"""SELECT 'DATASET_INGESTION' AS event, source, COUNT(*) AS row_count, CAST(8 AS BIGINT) AS column_count,
      '{_RAW.replace(" ", "")}' AS columns, TRUE AS timestamp, 'SUCCESS' AS status
      FROM retail_raw, (VALUES ('retail_raw'), ('retail_raw_again')) s(source) GROUP BY source"""
    q["trial_rows"] = "SELECT LEAST(500, COUNT(*)) AS lines FROM retail_raw"
    q["reloaded_model_agrees"] = "SELECT customer_id, TRUE AS same FROM features"
    q["batch_partition_counts"] = "SELECT batch_id, row_count FROM manifest"
    q["batch_manifest"] = "SELECT * FROM manifest"
    q["latest_batch"] = "SELECT * FROM manifest ORDER BY batch_id DESC LIMIT 1"
    # quality
    q["dq_clean"] = f"SELECT {_RAW} FROM gated WHERE rejection_reason IS NULL"
    q["dq_rejected"] = "SELECT * FROM rejected"
    q["dq_summary"] = f"""SELECT 'full_historical_baseline' AS batch_id, COUNT(*) AS total_records,
      COUNT(*) FILTER (rejection_reason IS NULL) AS valid_records,
      COUNT(*) FILTER (rejection_reason IS NOT NULL) AS rejected_records,
      {ratio("(COUNT(*) FILTER (rejection_reason IS NULL) * 100)", "COUNT(*)")} AS pass_rate_pct,
      {", ".join(f"COUNT(*) FILTER (rejection_reason = '{r}') AS {r.lower()}" for r in _REASONS)} FROM gated"""
    q["dq_audit"] = f"""SELECT rejection_reason, n AS "count", {ratio("(n * 100)", "total")} AS pct FROM (
      SELECT rejection_reason, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total FROM rejected GROUP BY 1)"""
    q["quality_scorecard"] = f"""SELECT total_records, valid_records,
      {ratio("(valid_records * 100)", "total_records")} AS pass_rate_pct, total_records - valid_records AS quarantined,
      valid_records - (SELECT COUNT(*) FROM lines) AS duplicates_removed
      FROM (SELECT COUNT(*) AS total_records, COUNT(*) FILTER (rejection_reason IS NULL) AS valid_records FROM gated)"""
    q["rejection_log"] = """SELECT batch_id, InvoiceNo AS invoice_no, StockCode AS stock_code, Quantity AS quantity,
      UnitPrice AS unit_price, CustomerID AS customer_id, rejection_reason FROM rejected
      ORDER BY batch_id, rejection_reason, InvoiceNo NULLS FIRST, StockCode NULLS FIRST, Quantity NULLS FIRST,
        UnitPrice NULLS FIRST, CustomerID NULLS FIRST"""
    q["q6_rejection_summary"] = """SELECT COALESCE('batch_' || strftime(TRY_CAST(InvoiceDate AS TIMESTAMP), '%Y_%m'),
        'full_historical_baseline') AS batch_id, rejection_reason, COUNT(*) AS rejected_record_count
      FROM gated WHERE rejection_reason IS NOT NULL GROUP BY 1, 2"""
    q["d6_rejections"] = "SELECT rejection_reason, COUNT(*) AS rejection_count FROM rejected GROUP BY 1"
    q["etl_audit_row"] = """SELECT 'full_historical_baseline' AS batch_id, (SELECT COUNT(*) FROM gated) AS raw_row_count,
      (SELECT COUNT(*) FROM fact_sales) AS cleaned_row_count, (SELECT COUNT(*) FROM rejected) AS rejected_row_count,
      'COMPLETED' AS status, 'Successfully loaded ' || CAST((SELECT COUNT(*) FROM fact_sales) AS STRING) || ' sales and '
      || CAST((SELECT COUNT(*) FROM rfm) AS STRING) || ' customer RFM profiles.' AS notes"""
    q["d5_audit_trail"] = """SELECT *, 'retail_raw' AS source_file FROM (""" + q["etl_audit_row"] + ")"
    # cleaning
    q["transform_clean"] = """SELECT invoice_no AS InvoiceNo, stock_code AS StockCode, description AS Description,
      country AS Country, ts AS InvoiceDate, q AS Quantity, CAST(up AS DOUBLE) AS UnitPrice, customer_id, date_key,
      CAST(amount AS DOUBLE) AS total_amount, is_cancelled, 'full_historical_baseline' AS batch_id FROM lines"""
    q["dedup_lines"] = """SELECT invoice_no AS InvoiceNo, stock_code AS StockCode, q AS Quantity,
      CAST(up AS DOUBLE) AS UnitPrice, ts AS InvoiceDate, COUNT(*) AS copies FROM standard GROUP BY ALL"""
    # functions over the data
    q["product_category"] = f"""SELECT description, {category('UPPER(description)')} AS category FROM (
      SELECT DISTINCT UPPER(TRIM(COALESCE(Description, 'UNKNOWN_PRODUCT'))) AS description FROM retail_raw)"""
    q["geography_region"] = f"""SELECT country, {region('country')} AS region, {tier('country')} AS market_tier FROM (
      SELECT DISTINCT {title("TRIM(COALESCE(Country, ''))")} AS country FROM retail_raw)"""
    q["rfm_segment_ladder"] = f"""SELECT r_score, f_score, m_score, {segment('r_score', 'f_score', 'm_score')} AS
      customer_segment, COUNT(*) AS customers FROM rfm_scored GROUP BY ALL"""
    q["risk_tier"] = """SELECT doc_id, score, CASE WHEN score >= 0.7 THEN 'High Risk' WHEN score >= 0.4 THEN 'Medium Risk'
        ELSE 'Low Risk' END AS risk_level,
      CASE WHEN score >= 0.7 THEN 'Trigger VIP win-back campaign with 20% discount coupon immediately.'
        WHEN score >= 0.4 THEN 'Send personalized product recommendations and re-engagement email.'
        ELSE 'Standard loyalty engagement. Customer is active and healthy.' END AS recommendation FROM label_scores"""
    # customers
    q["customer_modal_country"] = "SELECT customer_id, country FROM modal"
    q["customer_master"] = """SELECT i.customer_id, CASE WHEN i.customer_id = 0 THEN 'GUEST_UNREGISTERED'
        ELSE 'CUST_' || CAST(i.customer_id AS STRING) END AS customer_code,
      CASE WHEN i.customer_id = 0 THEN 'Unknown' ELSE m.gender END AS gender,
      CASE WHEN i.customer_id = 0 THEN 'Unknown' ELSE m.age_group END AS age_group,
      CASE WHEN i.customer_id = 0 THEN 'None' ELSE m.loyalty_tier END AS loyalty_tier, m.signup_date,
      CASE WHEN i.customer_id = 0 THEN 'Guest Checkout' ELSE m.preferred_device END AS preferred_device, i.country
      FROM (SELECT CAST(0 AS BIGINT) AS customer_id, 'United Kingdom' AS country UNION ALL
            SELECT customer_id, country FROM modal WHERE customer_id <> 0) i
      LEFT JOIN retail_master m ON m.customer_id = i.customer_id"""
    # sinks and loads
    month = "'batch_' || strftime({0}, '%Y_%m')"
    q["staged_extract"] = f"SELECT {_RAW}, 'full_historical_baseline' AS batch_id FROM retail_raw"
    # CSV does not tell empty text from a missing value: both come back as missing.
    q["landed_csv_clean"] = f"SELECT {_RAW} FROM gated WHERE rejection_reason IS NULL"
    q["monthly_export"] = f"SELECT * REPLACE (NULLIF(InvoiceNo, '') AS InvoiceNo) FROM (SELECT {_RAW}, batch_id FROM batches)"
    q["quarantine_by_month"] = f"""SELECT COALESCE({month.format('TRY_CAST(InvoiceDate AS TIMESTAMP)')},
        'full_historical_baseline') AS batch_id, InvoiceNo, StockCode, Description, Quantity, UnitPrice, CustomerID,
        Country, rejection_reason FROM gated WHERE rejection_reason IS NOT NULL"""
    q["loaded_row_counts"] = _COUNTS
    q["fact_sales_sample"] = f"""SELECT * REPLACE ({_double('unit_price', 'total_amount')}) FROM fact_sales
      ORDER BY sales_key LIMIT 100"""
    q["incremental_fact_sales"] = f"""SELECT * REPLACE ({_double('unit_price', 'total_amount')},
      {month.format('invoice_timestamp')} AS batch_id) FROM fact_sales"""
    q["incremental_rfm"] = f"SELECT * REPLACE ({_double('monetary_total')}) FROM rfm"
    q["streamed_lines"] = f"""SELECT invoice_no AS InvoiceNo, stock_code AS StockCode, description AS Description,
      country AS Country, ts AS InvoiceDate, q AS Quantity, CAST(up AS DOUBLE) AS UnitPrice, customer_id, date_key,
      CAST(amount AS DOUBLE) AS total_amount, is_cancelled, {month.format('ts')} AS batch_id FROM lines"""
    q["latest_batch_lines"] = f"SELECT * FROM ({q['streamed_lines']}) QUALIFY batch_id = MAX(batch_id) OVER ()"
    q["batch_raw_counts"] = f"SELECT batch_id, row_count AS raw_rows FROM ({q['batch_partition_counts']})"
    q["sql_western_europe"] = """SELECT g.country_name, d.year, COUNT(DISTINCT f.invoice_no) AS orders,
      CAST(SUM(f.total_amount) AS DOUBLE) AS revenue FROM fact_sales f
      JOIN dim_geography g ON g.geography_key = f.geography_key JOIN dim_date d ON d.date_key = f.date_key
      WHERE NOT f.is_cancelled AND g.region = 'Western Europe' GROUP BY 1, 2"""
    # tables
    for t in ("dim_date", "dim_customer", "dim_product", "dim_geography"):
        q[t] = f"SELECT * FROM {t}"
    q["fact_sales"] = f"SELECT * REPLACE ({_double('unit_price', 'total_amount')}) FROM fact_sales"
    q["fact_customer_retention"] = f"SELECT * REPLACE ({_double('order_value')}) FROM retention"
    q["mart_sales_performance"] = f"SELECT * REPLACE ({_double('total_revenue')}) FROM mart_sales"
    q["mart_customer_rfm"] = f"SELECT * REPLACE ({_double('monetary_total')}) FROM rfm"
    q["table_row_counts"] = _COUNTS
    q["constraint_audit"] = _constraints()
    q["etl_run_counts"] = """SELECT 'raw_records' AS measure, COUNT(*) AS n FROM gated
      UNION ALL SELECT 'clean_records', COUNT(*) FROM gated WHERE rejection_reason IS NULL
      UNION ALL SELECT 'rejected_records', COUNT(*) FROM rejected
      UNION ALL SELECT table_name, row_count FROM (""" + _COUNTS + ")"
    # business queries
    q["q1_monthly_revenue"] = f"""SELECT d.year, d.month_name, COUNT(DISTINCT f.invoice_no) AS total_orders,
      CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold, CAST(SUM(f.total_amount) AS DOUBLE) AS gross_revenue_gbp,
      {mean_amount('SUM(f.total_amount)', 'COUNT(*)')} AS average_line_item_value,
      {mean_amount('SUM(f.total_amount)', 'COUNT(DISTINCT f.invoice_no)')} AS average_order_value_gbp
      FROM fact_sales f JOIN dim_date d ON d.date_key = f.date_key WHERE NOT f.is_cancelled
      GROUP BY d.year, d.month, d.month_name ORDER BY d.year, d.month"""
    q["q2_top_products"] = """SELECT stock_code, description, category, units_sold,
      CAST(total_revenue AS DOUBLE) AS total_revenue_gbp, avg_price AS avg_unit_price FROM products
      ORDER BY total_revenue DESC, stock_code LIMIT 10"""
    q["q3_rfm_segments"] = f"""SELECT customer_segment, COUNT(*) AS customer_count,
      {ratio('SUM(recency_days)', 'COUNT(*)', 1)} AS avg_recency_days,
      {ratio('SUM(frequency)', 'COUNT(*)', 1)} AS avg_frequency_orders,
      {mean_amount('SUM(monetary_total)', 'COUNT(*)')} AS avg_monetary_spend_gbp,
      CAST(SUM(monetary_total) AS DOUBLE) AS segment_total_spend_gbp,
      {share('SUM(monetary_total)', '(SELECT SUM(monetary_total) FROM rfm)')} AS revenue_share_pct
      FROM rfm GROUP BY customer_segment"""
    q["q4_geo_performance"] = f"""SELECT g.region, g.market_tier, g.country_name,
      COUNT(DISTINCT f.invoice_no) AS total_orders, CAST(SUM(f.total_amount) AS DOUBLE) AS market_revenue_gbp,
      {share('SUM(f.total_amount)', '(SELECT SUM(total_amount) FROM fact_sales WHERE NOT is_cancelled)')}
        AS revenue_contribution_pct
      FROM fact_sales f JOIN dim_geography g ON g.geography_key = f.geography_key WHERE NOT f.is_cancelled
      GROUP BY g.geography_key, g.region, g.market_tier, g.country_name
      ORDER BY SUM(f.total_amount) DESC, g.country_name LIMIT 15"""
    q["q5_cohort_retention"] = f"""SELECT cohort_month, COUNT(DISTINCT customer_key) AS total_cohort_customers,
      COUNT(*) FILTER (is_repeat_customer) AS repeat_orders_placed,
      {ratio('SUM(days_since_prior_order)', 'COUNT(*)', 1)} AS avg_days_between_orders,
      CAST(SUM(order_value) AS DOUBLE) AS cohort_lifetime_value_gbp FROM retention GROUP BY cohort_month"""
    q["d1_sales_mart"] = _SALES_VIEW
    q["d2_rfm_profile"] = _PROFILE
    q["d3_product_revenue"] = f"SELECT * REPLACE ({_double('total_revenue')}) FROM products"
    q["d4_retention"] = f"""SELECT r.cohort_month, r.order_sequence, r.days_since_prior_order,
      CAST(r.order_value AS DOUBLE) AS order_value, r.is_repeat_customer, d.year, d.month
      FROM retention r JOIN dim_date d ON d.date_key = r.date_key"""
    # dashboard
    q["filter_options"] = """SELECT 'country' AS "filter", country_name AS choice FROM (SELECT DISTINCT country_name FROM sales_view)
      UNION ALL SELECT 'category', category FROM (SELECT DISTINCT category FROM products)
      UNION ALL SELECT 'loyalty_tier', loyalty_tier FROM (SELECT DISTINCT loyalty_tier FROM rfm)
      UNION ALL SELECT 'first_date', CAST(MIN(full_date) AS STRING) FROM sales_view
      UNION ALL SELECT 'last_date', CAST(MAX(full_date) AS STRING) FROM sales_view"""
    q["dash_filtered_sales"] = _SALES_VIEW + """ WHERE country_name = 'Germany'
      AND full_date >= DATE '1996-01-01' AND full_date <= DATE '1997-12-31'"""
    q["kpi_scorecard"] = f"""SELECT CAST(SUM(total_revenue) AS DOUBLE) AS revenue, CAST(SUM(total_orders) AS BIGINT) AS orders,
      CAST(SUM(total_units_sold) AS BIGINT) AS units, {mean_amount('SUM(total_revenue)', 'SUM(total_orders)')} AS aov,
      (SELECT COUNT(DISTINCT customer_id) FROM rfm) AS active_customers FROM sales_view"""
    q["monthly_trend"] = """SELECT year_month, CAST(SUM(total_revenue) AS DOUBLE) AS revenue,
      CAST(SUM(total_orders) AS BIGINT) AS orders, CAST(SUM(total_units_sold) AS BIGINT) AS units
      FROM sales_view GROUP BY year_month"""
    q["day_of_week_revenue"] = """SELECT d.day_name, CAST(SUM(s.total_revenue) AS DOUBLE) AS total_revenue
      FROM (VALUES ('Monday'), ('Tuesday'), ('Wednesday'), ('Thursday'), ('Friday'), ('Sunday')) d(day_name)
      LEFT JOIN sales_view s ON s.day_name = d.day_name GROUP BY d.day_name"""
    q["top15_products"] = f"""SELECT * REPLACE ({_double('total_revenue')}) FROM products
      ORDER BY total_revenue DESC, stock_code LIMIT 15"""
    q["top15_bags"] = f"""SELECT * REPLACE ({_double('total_revenue')}) FROM products WHERE category = 'Bags & Travel'
      ORDER BY total_revenue DESC, stock_code LIMIT 15"""
    q["category_share"] = f"""SELECT category, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue,
      {share('SUM(total_revenue)', '(SELECT SUM(total_revenue) FROM products)')} AS share_pct FROM products GROUP BY 1"""
    q["pareto_products"] = """SELECT *, cumulative_revenue_pct <= 80 AS within_80_pct_revenue,
        sku_pct <= 20 AS within_20_pct_skus FROM (
      SELECT stock_code, category, CAST(total_revenue AS DOUBLE) AS total_revenue,
        CAST(SUM(total_revenue) OVER w AS DOUBLE) AS cumulative_revenue, ROW_NUMBER() OVER w AS sku_rank,
        CAST(SUM(total_revenue) OVER w AS DOUBLE) / (SELECT CAST(SUM(total_revenue) AS DOUBLE) FROM products) * 100
          AS cumulative_revenue_pct,
        CAST(ROW_NUMBER() OVER w AS DOUBLE) / CAST(COUNT(*) OVER () AS DOUBLE) * 100 AS sku_pct
      FROM products WINDOW w AS (ORDER BY total_revenue DESC, stock_code ROWS UNBOUNDED PRECEDING))"""
    q["segment_summary"] = f"""SELECT customer_segment, COUNT(*) AS customer_count,
      CAST(SUM(monetary_total) AS DOUBLE) AS total_spend, AVG(recency_days) AS avg_recency,
      AVG(frequency) AS avg_frequency, {mean_amount('SUM(monetary_total)', 'COUNT(*)')} AS avg_spend
      FROM profiles GROUP BY customer_segment"""
    q["rfm_sample"] = _PROFILE + " ORDER BY md5(CAST(customer_id AS STRING) || ':42'), customer_id LIMIT 1500"
    q["tier_gender_spend"] = """SELECT loyalty_tier, gender, CAST(SUM(monetary_total) AS DOUBLE) AS monetary_total
      FROM profiles GROUP BY 1, 2"""
    q["device_customers"] = "SELECT preferred_device, COUNT(customer_id) AS customers FROM profiles GROUP BY 1"
    q["geo_summary"] = _GEO + " GROUP BY 1, 2, 3"
    q["top_export_markets"] = _GEO + """ WHERE country_name <> 'United Kingdom' GROUP BY 1, 2, 3
      ORDER BY SUM(total_revenue) DESC, country_name LIMIT 10"""
    q["order_sequence_profile"] = """SELECT order_sequence, COUNT(*) AS order_count,
      CAST(SUM(order_value) AS DOUBLE) AS total_revenue FROM retention GROUP BY 1 ORDER BY 1 LIMIT 10"""
    q["repeat_latency_hist"] = """SELECT CAST(b.bin AS INTEGER) AS bin, lo + b.bin * span / 40 AS from_days,
      lo + (b.bin + 1) * span / 40 AS to_days, MIN(d) AS least_days, MAX(d) AS most_days, COUNT(d) AS orders
      FROM (SELECT MIN(days_since_prior_order) AS lo, GREATEST(MAX(days_since_prior_order) - MIN(days_since_prior_order), 1) AS span
            FROM retention WHERE is_repeat_customer) r CROSS JOIN range(40) b(bin)
      LEFT JOIN (SELECT days_since_prior_order AS d FROM retention WHERE is_repeat_customer) x
        ON LEAST((d - lo) * 40 // span, 39) = b.bin GROUP BY b.bin, lo, span"""
    q["cohort_value"] = f"""SELECT cohort_month, COUNT(*) AS total_orders, CAST(SUM(order_value) AS DOUBLE) AS lifetime_revenue,
      {mean_amount('SUM(order_value)', 'COUNT(*)')} AS avg_basket FROM retention GROUP BY 1"""
    # churn
    q["churn_features"] = f"SELECT * REPLACE ({_double('monetary_spend')}) FROM features"
    q["scoring_input_validate"] = f"""SELECT *, CASE WHEN recency_days IS NULL THEN 'MISSING_RECENCY_DAYS'
        WHEN recency_days < 0 THEN 'OUT_OF_RANGE_RECENCY_DAYS' WHEN frequency_orders < 1 THEN 'OUT_OF_RANGE_FREQUENCY_ORDERS'
        WHEN cancellation_rate < 0 OR cancellation_rate > 1 THEN 'OUT_OF_RANGE_CANCELLATION_RATE' END AS rejection_reason
      FROM ({_SCORING})"""
    q["confusion_matrix"] = """SELECT CAST(l.label AS INTEGER) AS label, CAST(p.prediction AS INTEGER) AS prediction, COUNT(s.doc_id) AS n
      FROM (VALUES (0), (1)) l(label) CROSS JOIN (VALUES (0), (1)) p(prediction)
      LEFT JOIN label_scores s ON s.label = l.label AND CAST(s.score >= 0.5 AS INTEGER) = p.prediction GROUP BY 1, 2"""
    out = {name: with_tables(sql) for name, sql in q.items()} | loads.sql_by_query()

    more = f"""counts AS ({_CONFUSION}),
  ranked AS (SELECT label, 2 * RANK() OVER (ORDER BY score) + COUNT(*) OVER (PARTITION BY score) - 1 AS r2 FROM label_scores),
  auc AS (SELECT SUM(r2) FILTER (label = 1) AS r2, COUNT(*) FILTER (label = 1) AS p, COUNT(*) FILTER (label = 0) AS n FROM ranked)"""
    out["eval_metrics"] = _append(more, f"""SELECT {ratio('(tp + tn)', '(tp + fp + fn + tn)', 4)} AS accuracy,
      {ratio('tp', '(tp + fp)', 4)} AS "precision", {ratio('tp', '(tp + fn)', 4)} AS recall,
      {ratio('(2 * tp)', '(2 * tp + fp + fn)', 4)} AS f1_score,
      {ratio('(r2 - p * (p + 1))', '(2 * p * n)', 4)} AS roc_auc, ROUND(loss, 4) AS log_loss FROM counts, auc""")
    more = """points AS (SELECT score, SUM(COUNT(*) FILTER (label = 1)) OVER w AS tp, SUM(COUNT(*) FILTER (label = 0)) OVER w AS fp
    FROM label_scores GROUP BY score WINDOW w AS (ORDER BY score DESC)),
  totals AS (SELECT COUNT(*) FILTER (label = 1) AS p, COUNT(*) FILTER (label = 0) AS n FROM label_scores)"""
    out["roc_curve"] = _append(more, """SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL
      SELECT score, CAST(fp AS DOUBLE) / n, CAST(tp AS DOUBLE) / p FROM points, totals""")
    out["churn_split"] = _append(_QUOTAS, "SELECT customer_id, is_churned, split FROM assigned")
    out["split_sizes"] = _append(_QUOTAS, "SELECT split, is_churned, COUNT(*) AS n FROM assigned GROUP BY 1, 2")
    stats = ", ".join(f"AVG(CAST({n} AS DOUBLE)) AS m_{n}, STDDEV_POP(CAST({n} AS DOUBLE)) AS s_{n}" for n in _NUMERIC)
    scaled = ", ".join(
        f"ROUND((CAST(f.{n} AS DOUBLE) - m_{n}) / CASE WHEN s_{n} = 0 THEN 1 ELSE s_{n} END, 6) AS {n}" for n in _NUMERIC)
    more = _QUOTAS + f""",
  learnt AS (SELECT {stats} FROM features f JOIN assigned a ON a.customer_id = f.customer_id WHERE a.split = 'train')"""
    out["scaled_features"] = _append(more, f"SELECT f.customer_id, {scaled} FROM features f, learnt")
    slots = " UNION ALL ".join(
        f"SELECT f.customer_id, a.split, '{c}_' || COALESCE(f.{c}, 'nan') AS slot FROM features f JOIN assigned a USING (customer_id)"
        for c in ("gender", "age_group", "loyalty_tier", "preferred_device", "country"))
    more = _QUOTAS + f",\n  slots AS ({slots})"
    out["encoded_categories"] = _append(more, """SELECT customer_id, slot FROM slots
      WHERE slot IN (SELECT slot FROM slots WHERE split = 'train')""")
    names = " UNION ALL ".join(f"SELECT '{n}'" for n in [*_NUMERIC, "intercept"])
    out["logistic_optimality"] = _append(more, f"""SELECT slot, TRUE AS optimal FROM (
      SELECT DISTINCT slot FROM slots WHERE split = 'train' UNION ALL {names})""")
    out["tree_replay"] = with_tables("""SELECT model, customer_id, TRUE AS same
      FROM features, (VALUES ('Random_Forest'), ('Gradient_Boosting')) m(model)""")
    events = "SELECT 'value' AS feature, value, side FROM event_sides"
    shifted = "SELECT 'value' AS feature, CASE WHEN side = 'c' THEN value * 1.5 ELSE value END AS value, side FROM event_sides"
    out["psi"] = _append(_psi(events), "SELECT feature, ROUND(psi, 4) AS psi_score FROM psis")
    out["psi_shifted"] = _append(_psi(shifted), "SELECT feature, ROUND(psi, 4) AS psi_score FROM psis")
    out["event_drift"] = _append(_psi(shifted), _DRIFT_OUT)
    out["drift_report"] = _append(_psi(_FEATURE_VALUES), _DRIFT_OUT)
    out["drift_alerts"] = _append(f"{_psi(_FEATURE_VALUES)},\n  {_ALERTS}", "SELECT * FROM alerts")
    out["drift_status"] = _append(f"{_psi(_FEATURE_VALUES)},\n  {_ALERTS}", """
SELECT COUNT(*) FILTER (alert_level = 'HIGH DRIFT (ALERT)') AS high_drift_features,
  COUNT(*) FILTER (alert_level = 'HIGH DRIFT (ALERT)') = 0 AS is_stable FROM alerts""")
    return out
