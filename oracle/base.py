"""Shared table definitions of the DuckDB checks, written independently of the Spark plans."""

from __future__ import annotations

import re

# Classification lists of the retail domain (same as in the engine).
CATEGORIES = [
    ("Seasonal & Festive", "HEART|CHRISTMAS|XMAS|STAR|LIGHT|CANDLE|TREE|FESTIVE|DECORATION"),
    ("Kitchen & Dining", "MUG|CUP|PLATE|BOWL|TEA|COFFEE|BAKING|CUTLERY|KITCHEN|JAR|BOTTLE"),
    ("Bags & Travel", "BAG|TOTE|PURSE|WALLET|LUGGAGE|TRAVEL"),
    ("Stationery & Office", "PEN|NOTEBOOK|PENCIL|CARD|STICKER|PAPER|STATIONERY"),
    ("Home Decor & Furnishing", "BOX|CLOCK|FRAME|MIRROR|CUSHION|SIGN|LANTERN|DOORSTOP"),
    ("Toys & Children", "TOY|GAME|DOLL|PUZZLE|CHILD"),
]
REGIONS = [
    ("Domestic UK", "Tier 1 - Domestic", ["United Kingdom", "Uk"]),
    ("Western Europe", "Tier 2 - Core Europe", ["Germany", "France", "Eire", "Ireland", "Netherlands", "Belgium", "Switzerland", "Austria"]),
    ("Southern Europe", "Tier 2 - Core Europe", ["Spain", "Portugal", "Italy", "Greece", "Cyprus", "Malta"]),
    ("Nordics", "Tier 2 - Core Europe", ["Norway", "Sweden", "Finland", "Denmark", "Iceland"]),
    ("Eastern Europe", "Tier 3 - Extended EU", ["Poland", "Czech Republic", "Lithuania", "European Community"]),
    ("North America", "Tier 3 - International", ["Usa", "United States", "Canada"]),
    ("Asia-Pacific", "Tier 3 - International", ["Australia", "Japan", "Singapore", "Hong Kong"]),
    ("Middle East", "Tier 3 - International", ["United Arab Emirates", "Saudi Arabia", "Bahrain", "Israel", "Lebanon"]),
    ("Africa", "Tier 3 - International", ["Rsa", "South Africa", "Nigeria"]),
    ("Latin America", "Tier 3 - International", ["Brazil", "Argentina"]),
]


def category(text: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({text}, '{words}') THEN '{name}'" for name, words in CATEGORIES)
    return f"CASE {cases} ELSE 'Gifts & Accessories' END"


def _in(text: str, names: list[str]) -> str:
    return f"{text} IN (" + ", ".join(f"'{n}'" for n in names) + ")"


def region(country: str) -> str:
    return "CASE " + " ".join(
        f"WHEN {_in(country, ns)} THEN '{r}'" for r, _, ns in REGIONS) + " ELSE 'Other / Overseas' END"


def tier(country: str) -> str:
    return "CASE " + " ".join(
        f"WHEN {_in(country, ns)} THEN '{t}'" for _, t, ns in REGIONS) + " ELSE 'Tier 3 - International' END"


def title(text: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({text}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def ratio(num: str, den: str, places: int = 2) -> str:
    """num / den of whole numbers, half away from zero, as a double."""
    size = f"(ABS(CAST({num} AS HUGEINT)) * {2 * 10**places} + CAST({den} AS HUGEINT)) // (2 * CAST({den} AS HUGEINT))"
    sign = f"(CASE WHEN {num} < 0 THEN -1 ELSE 1 END)"
    return f"(CASE WHEN {den} = 0 THEN 0.0 ELSE CAST({sign} * ({size}) AS DOUBLE) / {10**places} END)"


def cents(amount: str) -> str:
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def mean_amount(total: str, n: str, places: int = 2) -> str:
    return ratio(cents(total), f"(({n}) * 100)", places)


def share(part: str, whole: str, places: int = 2) -> str:
    return ratio(f"({cents(part)} * 100)", cents(whole), places)


def segment(r: str, f: str, m: str) -> str:
    return f"""CASE WHEN {r} >= 4 AND {f} >= 4 AND {m} >= 4 THEN 'Champions'
      WHEN {r} <= 2 AND ({f} >= 3 OR {m} >= 3) THEN 'At Risk - Needs Attention'
      WHEN {r} >= 3 AND {f} >= 3 AND {m} >= 3 THEN 'Loyal Customers'
      WHEN {r} >= 4 AND {f} <= 2 THEN 'New / Potential Loyalists'
      WHEN {r} >= 3 THEN 'Promising Customers'
      WHEN {r} = 1 THEN 'Lost Customers'
      WHEN {r} <= 2 AND {f} <= 2 AND {m} <= 2 THEN 'Hibernating'
      ELSE 'Standard Regulars' END"""


CTES: dict[str, str] = {}

CTES["raw_line"] = """
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, o.o_orderdate, o.o_custkey, c.c_nationkey,
         p.p_name, p.p_retailprice, (l.l_returnflag = 'R' AND l.l_linestatus = 'F') AS is_ret
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN part p ON p.p_partkey = l.l_partkey"""

CTES["raw_base"] = """
  SELECT l_orderkey,
    CASE WHEN l_orderkey % 211 = 0 AND l_linenumber = 1 THEN ''
         WHEN l_orderkey % 223 = 0 AND l_linenumber = 2 THEN NULL
         WHEN is_ret THEN 'C' || CAST(l_orderkey AS STRING)
         ELSE CAST(l_orderkey AS STRING) END AS InvoiceNo,
    CASE WHEN l_orderkey % 227 = 0 AND l_linenumber = 3 THEN 'nan'
         ELSE ' p' || CAST(l_partkey AS STRING) END AS StockCode,
    CASE WHEN l_partkey % 50 = 0 THEN NULL
         ELSE p_name || CASE l_partkey % 8 WHEN 0 THEN ' heart sign' WHEN 1 THEN ' tea mug'
              WHEN 2 THEN ' travel bag ' WHEN 3 THEN ' pencil card' WHEN 4 THEN ' design tape'
              WHEN 5 THEN ' puzzle' ELSE '' END END AS Description,
    CASE WHEN l_orderkey % 101 = 0 AND l_linenumber = 4 THEN '0'
         WHEN l_orderkey % 103 = 0 AND l_linenumber = 5 THEN 'abc'
         WHEN l_orderkey % 107 = 0 AND l_linenumber = 6 THEN '-3'
         WHEN l_orderkey % 109 = 0 AND l_linenumber = 7 THEN '60000'
         WHEN is_ret THEN '-' || CAST(CAST(l_quantity AS INT) AS STRING)
         ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS Quantity,
    CASE WHEN l_orderkey % 113 = 0 AND l_linenumber = 1 THEN 'not-a-date'
         ELSE CAST(o_orderdate + INTERVAL '1' MINUTE * CAST(480 + l_orderkey % 600 AS INT) AS STRING) END AS InvoiceDate,
    CASE WHEN l_orderkey % 97 = 0 AND l_linenumber = 2 THEN '0.0'
         WHEN l_orderkey % 127 = 0 AND l_linenumber = 3 THEN '50000.01'
         WHEN l_orderkey % 131 = 0 AND l_linenumber = 4 THEN NULL
         ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) + l_orderkey % 7 AS STRING) END AS UnitPrice,
    CASE WHEN o_custkey % 20 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) || '.0' END AS CustomerID,
    CASE c_nationkey WHEN 0 THEN 'United Kingdom' WHEN 1 THEN 'Germany' WHEN 2 THEN 'France' WHEN 3 THEN 'EIRE'
      WHEN 4 THEN 'Netherlands' WHEN 5 THEN 'Spain' WHEN 6 THEN 'Italy' WHEN 7 THEN 'Norway' WHEN 8 THEN 'Sweden'
      WHEN 9 THEN 'Poland' WHEN 10 THEN 'Czech Republic' WHEN 11 THEN 'USA' WHEN 12 THEN 'Canada' WHEN 13 THEN 'Australia'
      WHEN 14 THEN 'Japan' WHEN 15 THEN 'United Arab Emirates' WHEN 16 THEN 'Israel' WHEN 17 THEN 'RSA' WHEN 18 THEN 'Nigeria'
      WHEN 19 THEN 'Brazil' WHEN 20 THEN 'Argentina' WHEN 21 THEN 'Channel Islands' WHEN 22 THEN 'Unspecified'
      WHEN 23 THEN ' portugal ' ELSE NULL END AS Country
  FROM raw_line"""

_RAW = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"

CTES["retail_raw"] = f"""
  SELECT {_RAW} FROM raw_base
  UNION ALL
  SELECT {_RAW} FROM raw_base WHERE l_orderkey % 50 = 0"""

CTES["retail_master"] = """
  SELECT c_custkey AS customer_id,
    'CUST_' || CAST(c_custkey AS STRING) AS customer_code,
    CASE c_custkey % 4 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' WHEN 2 THEN 'Non-Binary' ELSE NULL END AS gender,
    CASE c_custkey % 6 WHEN 0 THEN '18-25' WHEN 1 THEN '26-35' WHEN 2 THEN '36-50' WHEN 3 THEN '51-65' WHEN 4 THEN '65+' ELSE NULL END AS age_group,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 4000 THEN 'Bronze' WHEN c_acctbal < 7000 THEN 'Silver' WHEN c_acctbal < 9000 THEN 'Gold' ELSE 'Platinum' END AS loyalty_tier,
    CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS DATE) AS signup_date,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Mobile App' WHEN 'AUTOMOBILE' THEN 'Desktop Web' WHEN 'MACHINERY' THEN 'Mobile Web' WHEN 'HOUSEHOLD' THEN 'Tablet' ELSE NULL END AS preferred_device,
    CASE WHEN c_nationkey = 0 THEN 'United Kingdom' ELSE 'Nation ' || CAST(c_nationkey AS STRING) END AS country
  FROM customer WHERE c_custkey % 17 <> 0 OR c_custkey = 0"""

CTES["gated"] = """
  SELECT *, CASE
    WHEN InvoiceNo IS NULL OR TRIM(InvoiceNo) = '' OR LOWER(TRIM(InvoiceNo)) = 'nan' THEN 'NULL_OR_EMPTY_INVOICE_NO'
    WHEN StockCode IS NULL OR TRIM(StockCode) = '' OR LOWER(TRIM(StockCode)) = 'nan' THEN 'NULL_OR_EMPTY_STOCK_CODE'
    WHEN TRY_CAST(UnitPrice AS DOUBLE) IS NULL OR TRY_CAST(UnitPrice AS DOUBLE) <= 0
      OR TRY_CAST(UnitPrice AS DOUBLE) > 50000 THEN 'INVALID_OR_ZERO_UNIT_PRICE'
    WHEN TRY_CAST(Quantity AS DOUBLE) IS NULL OR TRY_CAST(Quantity AS DOUBLE) = 0
      OR (UPPER(TRIM(InvoiceNo)) NOT LIKE 'C%' AND TRY_CAST(Quantity AS DOUBLE) < 0)
      OR ABS(TRY_CAST(Quantity AS DOUBLE)) > 50000 THEN 'INVALID_OR_ZERO_QUANTITY'
    WHEN TRY_CAST(InvoiceDate AS TIMESTAMP) IS NULL THEN 'INVALID_INVOICE_DATE_FORMAT' END AS rejection_reason
  FROM retail_raw"""

CTES["rejected"] = """
  SELECT 'full_historical_baseline' AS batch_id, InvoiceNo, StockCode, Description, Quantity, UnitPrice, CustomerID,
    Country, rejection_reason
  FROM gated WHERE rejection_reason IS NOT NULL"""

CTES["standard"] = f"""
  SELECT TRIM(InvoiceNo) AS invoice_no, UPPER(TRIM(StockCode)) AS stock_code,
    UPPER(TRIM(COALESCE(Description, 'UNKNOWN_PRODUCT'))) AS description,
    {title("TRIM(COALESCE(Country, 'United Kingdom'))")} AS country,
    TRY_CAST(InvoiceDate AS TIMESTAMP) AS ts,
    CAST(TRUNC(TRY_CAST(Quantity AS DOUBLE)) AS INTEGER) AS q,
    TRY_CAST(UnitPrice AS DECIMAL(10,2)) AS up,
    COALESCE(TRY_CAST(TRY_CAST(CustomerID AS DOUBLE) AS BIGINT), 0) AS customer_id
  FROM gated WHERE rejection_reason IS NULL"""

CTES["lines"] = """
  SELECT * EXCLUDE (copy), CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(q * up AS DECIMAL(12,2)) AS amount,
    (UPPER(invoice_no) LIKE 'C%' OR q < 0) AS is_cancelled,
    ROW_NUMBER() OVER (ORDER BY ts, invoice_no, stock_code, q, up) AS sales_key
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY invoice_no, stock_code, q, up, ts
                                     ORDER BY description, country, customer_id) AS copy FROM standard)
  WHERE copy = 1"""

CTES["dim_date"] = """
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
    CAST(YEAR(d) AS INTEGER) AS year, CAST(QUARTER(d) AS INTEGER) AS quarter, CAST(MONTH(d) AS INTEGER) AS month,
    strftime(d, '%B') AS month_name, CAST(DAY(d) AS INTEGER) AS day, CAST(ISODOW(d) AS INTEGER) AS day_of_week,
    strftime(d, '%A') AS day_name, ISODOW(d) >= 6 AS is_weekend
  FROM (SELECT UNNEST(generate_series((SELECT CAST(CAST(MIN(ts) AS DATE) AS TIMESTAMP) FROM lines),
                                      (SELECT CAST(CAST(MAX(ts) AS DATE) AS TIMESTAMP) FROM lines),
                                      INTERVAL '1' DAY)) AS d)"""

CTES["dim_customer"] = """
  SELECT ROW_NUMBER() OVER (ORDER BY i.customer_id) AS customer_key, i.customer_id,
    CASE WHEN i.customer_id = 0 THEN 'GUEST_UNREGISTERED'
         ELSE COALESCE(m.customer_code, 'CUST_' || CAST(i.customer_id AS STRING)) END AS customer_code,
    CASE WHEN i.customer_id = 0 THEN 'Unknown' ELSE COALESCE(m.gender, 'Unknown') END AS gender,
    CASE WHEN i.customer_id = 0 THEN 'Unknown' ELSE COALESCE(m.age_group, 'Unknown') END AS age_group,
    CASE WHEN i.customer_id = 0 THEN 'None' ELSE COALESCE(m.loyalty_tier, 'Bronze') END AS loyalty_tier,
    m.signup_date,
    CASE WHEN i.customer_id = 0 THEN 'Guest Checkout' ELSE COALESCE(m.preferred_device, 'Desktop Web') END AS preferred_device,
    m.country
  FROM (SELECT customer_id FROM lines UNION SELECT customer_id FROM retail_master) i
  LEFT JOIN retail_master m ON m.customer_id = i.customer_id"""

CTES["dim_product"] = f"""
  SELECT ROW_NUMBER() OVER (ORDER BY m.stock_code) AS product_key, m.stock_code, f.description,
    {category('f.description')} AS category, FLOOR(m.median_cents + 0.5) / 100 AS unit_price_nominal
  FROM (SELECT stock_code, quantile_cont(CAST(up * 100 AS BIGINT), 0.5) AS median_cents FROM lines GROUP BY stock_code) m
  JOIN (SELECT stock_code, description, ROW_NUMBER() OVER (PARTITION BY stock_code ORDER BY ts, description) AS rn
        FROM lines) f ON f.stock_code = m.stock_code AND f.rn = 1"""

CTES["dim_geography"] = f"""
  SELECT ROW_NUMBER() OVER (ORDER BY country) AS geography_key, country AS country_name,
    {region('country')} AS region, {tier('country')} AS market_tier
  FROM (SELECT DISTINCT country FROM lines)"""

CTES["fact_sales"] = """
  SELECT l.sales_key, l.invoice_no,
    COALESCE(c.customer_key, (SELECT customer_key FROM dim_customer WHERE customer_id = 0), 1) AS customer_key,
    COALESCE(p.product_key, 1) AS product_key, COALESCE(g.geography_key, 1) AS geography_key, l.date_key,
    l.ts AS invoice_timestamp, l.q AS quantity, l.up AS unit_price, l.amount AS total_amount, l.is_cancelled,
    'full_historical_baseline' AS batch_id
  FROM lines l
  LEFT JOIN dim_customer c ON c.customer_id = l.customer_id
  LEFT JOIN dim_product p ON p.stock_code = l.stock_code
  LEFT JOIN dim_geography g ON g.country_name = l.country"""

CTES["retention"] = """
  SELECT ROW_NUMBER() OVER (ORDER BY o.customer_id, o.order_date, o.invoice_no, o.date_key) AS retention_key,
    COALESCE(c.customer_key, 1) AS customer_key, o.date_key,
    strftime(MIN(o.order_date) OVER (PARTITION BY o.customer_id), '%Y-%m') AS cohort_month,
    CAST(ROW_NUMBER() OVER w AS INTEGER) AS order_sequence,
    CAST(COALESCE(date_sub('day', LAG(o.order_date) OVER w, o.order_date), 0) AS INTEGER) AS days_since_prior_order,
    o.order_value, ROW_NUMBER() OVER w > 1 AS is_repeat_customer
  FROM (SELECT customer_id, invoice_no, date_key, MIN(ts) AS order_date, SUM(amount) AS order_value
        FROM lines WHERE customer_id <> 0 AND NOT is_cancelled AND amount > 0 GROUP BY 1, 2, 3) o
  LEFT JOIN dim_customer c ON c.customer_id = o.customer_id
  WINDOW w AS (PARTITION BY o.customer_id ORDER BY o.order_date, o.invoice_no, o.date_key)"""

CTES["mart_sales"] = f"""
  SELECT ROW_NUMBER() OVER (ORDER BY date_key, year_month, country_name) AS mart_id, date_key, year_month,
    country_name, total_revenue, total_orders, total_units_sold,
    {mean_amount('total_revenue', 'total_orders')} AS average_order_value, unique_customers, cancelled_orders_count
  FROM (SELECT f.date_key, strftime(d.full_date, '%Y-%m') AS year_month, g.country_name,
          SUM(f.total_amount) AS total_revenue, COUNT(DISTINCT f.invoice_no) AS total_orders,
          CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold, COUNT(DISTINCT f.customer_key) AS unique_customers,
          CAST(SUM(CAST(f.is_cancelled AS INT)) AS BIGINT) AS cancelled_orders_count
        FROM fact_sales f JOIN dim_date d ON d.date_key = f.date_key
        JOIN dim_geography g ON g.geography_key = f.geography_key GROUP BY 1, 2, 3)"""

CTES["rfm_base"] = """
  SELECT f.customer_key, c.customer_id, c.loyalty_tier, MAX(f.invoice_timestamp) AS last_ts,
    COUNT(DISTINCT f.invoice_no) AS frequency, SUM(f.total_amount) AS monetary_total
  FROM fact_sales f JOIN dim_customer c ON c.customer_key = f.customer_key
  WHERE c.customer_id <> 0 AND NOT f.is_cancelled AND f.total_amount > 0 GROUP BY 1, 2, 3"""

CTES["rfm_ranked"] = """
  SELECT *, date_sub('day', last_ts, (SELECT MAX(last_ts) FROM rfm_base) + INTERVAL '1' DAY) AS recency_days,
    ROW_NUMBER() OVER (ORDER BY frequency, customer_key) AS f_rank,
    ROW_NUMBER() OVER (ORDER BY monetary_total, customer_key) AS m_rank, COUNT(*) OVER () AS n
  FROM rfm_base"""

CTES["rfm_scored"] = """
  SELECT *, CAST(CASE WHEN recency_days <= e[1] THEN 5 WHEN recency_days <= e[2] THEN 4
      WHEN recency_days <= e[3] THEN 3 WHEN recency_days <= e[4] THEN 2 ELSE 1 END AS INTEGER) AS r_score,
    CAST(GREATEST(1, (5 * (f_rank - 1) + n - 2) // (n - 1)) AS INTEGER) AS f_score,
    CAST(GREATEST(1, (5 * (m_rank - 1) + n - 2) // (n - 1)) AS INTEGER) AS m_score
  FROM rfm_ranked, (SELECT quantile_cont(recency_days, [0.2, 0.4, 0.6, 0.8]) AS e FROM rfm_ranked)"""

CTES["rfm"] = f"""
  SELECT customer_key, customer_id, CAST(recency_days AS INTEGER) AS recency_days, frequency, monetary_total,
    r_score, f_score, m_score,
    CAST(r_score AS STRING) || CAST(f_score AS STRING) || CAST(m_score AS STRING) AS rfm_score,
    {segment('r_score', 'f_score', 'm_score')} AS customer_segment,
    COALESCE(loyalty_tier, 'Bronze') AS loyalty_tier, CAST(last_ts AS DATE) AS last_order_date
  FROM rfm_scored"""

CTES["sales_view"] = """
  SELECT m.*, d.year, d.month, d.month_name, d.full_date, d.day_name, d.is_weekend, g.region, g.market_tier
  FROM mart_sales m JOIN dim_date d ON d.date_key = m.date_key JOIN dim_geography g ON g.country_name = m.country_name"""

CTES["profiles"] = """
  SELECT r.*, c.gender, c.age_group, c.preferred_device, c.country
  FROM rfm r JOIN dim_customer c ON c.customer_key = r.customer_key"""

CTES["products"] = f"""
  SELECT p.stock_code, p.description, p.category, CAST(SUM(f.quantity) AS BIGINT) AS units_sold,
    SUM(f.total_amount) AS total_revenue, {mean_amount('SUM(f.unit_price)', 'COUNT(*)')} AS avg_price
  FROM fact_sales f JOIN dim_product p ON p.product_key = f.product_key
  WHERE NOT f.is_cancelled GROUP BY p.product_key, p.stock_code, p.description, p.category"""

CTES["batches"] = """
  SELECT *, 'batch_' || strftime(TRY_CAST(InvoiceDate AS TIMESTAMP), '%Y_%m') AS batch_id FROM retail_raw
  WHERE TRY_CAST(InvoiceDate AS TIMESTAMP) IS NOT NULL"""

CTES["manifest"] = """
  SELECT batch_id, replace(substr(batch_id, 7), '_', '-') AS period,
    'orders_' || substr(batch_id, 7) || '.csv' AS filename, COUNT(*) AS row_count,
    CAST(MIN(CAST(InvoiceDate AS TIMESTAMP)) AS STRING) AS min_invoice_date,
    CAST(MAX(CAST(InvoiceDate AS TIMESTAMP)) AS STRING) AS max_invoice_date, 'READY_FOR_INGESTION' AS status
  FROM batches GROUP BY batch_id"""

CTES["modal"] = """
  SELECT customer_id, COALESCE(country, 'United Kingdom') AS country FROM (
    SELECT customer_id, country, ROW_NUMBER() OVER (PARTITION BY customer_id
             ORDER BY country IS NULL, COUNT(*) DESC, country) AS rn
    FROM (SELECT TRY_CAST(TRY_CAST(CustomerID AS DOUBLE) AS BIGINT) AS customer_id, Country AS country FROM retail_raw)
    WHERE customer_id IS NOT NULL GROUP BY customer_id, country) WHERE rn = 1"""

CTES["known_lines"] = """
  SELECT f.*, c.customer_id FROM fact_sales f JOIN dim_customer c ON c.customer_key = f.customer_key
  WHERE c.customer_id <> 0"""

CTES["horizon"] = """
  SELECT MAX(invoice_timestamp) AS latest, MAX(invoice_timestamp) - INTERVAL '90' DAY AS cutoff,
    MAX(invoice_timestamp) - INTERVAL '270' DAY AS start FROM known_lines"""

CTES["observed"] = """
  SELECT k.* FROM known_lines k, horizon h WHERE k.invoice_timestamp >= h.start AND k.invoice_timestamp < h.cutoff"""

CTES["gaps"] = """
  SELECT customer_id, date_sub('day', LAG(ts) OVER (PARTITION BY customer_id ORDER BY ts), ts) AS gap
  FROM (SELECT DISTINCT customer_id, invoice_no, invoice_timestamp AS ts FROM observed WHERE NOT is_cancelled)"""

CTES["features"] = f"""
  SELECT o.customer_id, CAST(date_sub('day', o.last_ts, h.cutoff) AS INTEGER) AS recency_days, o.frequency_orders,
    o.monetary_spend, {mean_amount('o.monetary_spend', 'o.frequency_orders')} AS avg_order_value, o.total_units,
    {ratio('o.cancelled', 'o.n', 4)} AS cancellation_rate,
    CASE WHEN g.n > 0 THEN {ratio('g.total', 'g.n')} ELSE 180.0 END AS inter_purchase_mean,
    CASE WHEN g.n > 1 THEN ROUND(g.sd, 2) ELSE 0.0 END AS inter_purchase_std, o.product_variety,
    c.gender, c.age_group, c.loyalty_tier, c.preferred_device, c.country,
    CAST(CASE WHEN o.customer_id IN (SELECT k.customer_id FROM known_lines k, horizon h
      WHERE k.invoice_timestamp >= h.cutoff AND k.invoice_timestamp <= h.latest AND NOT k.is_cancelled)
      THEN 0 ELSE 1 END AS INTEGER) AS is_churned
  FROM (SELECT customer_id, MAX(invoice_timestamp) FILTER (NOT is_cancelled) AS last_ts,
          COUNT(DISTINCT invoice_no) FILTER (NOT is_cancelled) AS frequency_orders,
          SUM(total_amount) FILTER (NOT is_cancelled) AS monetary_spend,
          CAST(SUM(quantity) FILTER (NOT is_cancelled) AS BIGINT) AS total_units,
          COUNT(*) FILTER (is_cancelled) AS cancelled, COUNT(*) AS n,
          COUNT(DISTINCT product_key) FILTER (NOT is_cancelled) AS product_variety
        FROM observed GROUP BY customer_id) o
  JOIN dim_customer c ON c.customer_id = o.customer_id
  LEFT JOIN (SELECT customer_id, COUNT(gap) AS n, SUM(gap) AS total, stddev_samp(gap) AS sd FROM gaps GROUP BY 1) g
    ON g.customer_id = o.customer_id, horizon h
  WHERE o.last_ts IS NOT NULL"""

CTES["label_scores"] = """
  SELECT doc_id, quality AS label, CAST((doc_id * 37 + quality * 211) % 1000 AS DOUBLE) / 1000 AS score FROM labels"""

CTES["event_sides"] = """
  SELECT value, event_type, CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'b' ELSE 'c' END AS side FROM events"""


def with_tables(body: str) -> str:
    """``body`` with the definitions it needs, directly or through one another, in order."""
    needed: set[str] = set()
    frontier = [body]
    while frontier:
        text = frontier.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                frontier.append(CTES[name])
    chain = ",\n".join(f"{n} AS ({sql}\n)" for n, sql in CTES.items() if n in needed)
    return f"WITH {chain}\n{body.strip()}" if chain else body.strip()
