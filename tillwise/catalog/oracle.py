"""SQL twins of the queries, in DuckDB's dialect, used only to check results.

`CTES` holds named building blocks; `sql` puts the blocks a statement mentions in front of it.
"""

from __future__ import annotations

import re

from tillwise import model
from tillwise.operators.attribution import CREDIT_UNIT, HALF_LIFE_DAYS, N, W, WEIGHT_UNIT, WINDOW_DAYS

ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}
_ORDER: list[str] = []


def cte(name: str, body: str) -> None:
    CTES[name] = body
    _ORDER.append(name)


def sql(statement: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\w+", text)) & CTES.keys() - needed:
            needed.add(name)
            visit(CTES[name])

    visit(statement)
    blocks = [f"{n} AS ({CTES[n]})" for n in _ORDER if n in needed]
    return ("WITH " + ",\n".join(blocks) + "\n" if blocks else "") + statement


def oracle(name: str, statement: str) -> None:
    ORACLES[name] = statement


# --- expressions ----------------------------------------------------------------------------

def R(num: str, den: str, places: int, times: int = 1) -> str:
    """times * num / den, half away from zero."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    q = f"CAST((abs({n}) * {2 * times * 10**places} + abs({d})) // nullif(abs({d}) * 2, 0) AS BIGINT)"
    sign = f"CASE WHEN {q} <> 0 AND ({n} < 0) <> ({d} < 0) THEN -1::DOUBLE ELSE 1::DOUBLE END"
    return f"(({sign}) * (CAST({q} AS DOUBLE) / {10**places}::DOUBLE))"


def P(num: str, den: str, places: int) -> str:
    return R(num, den, places, 100)


def GBP(pence: str) -> str:
    return f"(CAST(CAST({pence} AS BIGINT) AS DOUBLE) / 100::DOUBLE)"


def SK(text: str) -> str:
    key = "0::BIGINT"
    for i in range(4):
        key = f"(({key} * 294967296 + ('0x' || substr(md5({text}), {1 + 8 * i}, 8))::BIGINT) % 1000000000)"
    return key


def TITLE(c: str) -> str:
    runs = f"regexp_extract_all(trim({c}), '([a-zA-Z]+|[^a-zA-Z]+)')"
    return f"array_to_string(list_transform({runs}, lambda x: upper(x[1]) || lower(x[2:])), '')"


def BIG(*aggregates: str) -> str:
    """`sum(x) AS y` items as bigints."""
    return ", ".join(f"CAST({a.rsplit(' AS ', 1)[0]} AS BIGINT) AS {a.rsplit(' AS ', 1)[1]}" for a in aggregates)


def PICK(value: str, *names: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names[:-1]))
    return f"CASE {value} {cases} ELSE '{names[-1]}' END"


def DKEY(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS BIGINT)"


PENCE = "CAST(round({} * 100) AS BIGINT)".format
AS_OF = "DATE '2001-08-02'"

# --- raw inputs -----------------------------------------------------------------------------

cte("raw_customers", f"""
SELECT 'CUS-' || c_custkey AS customer_id, 'user' || c_custkey || '@example.com' AS email, n_name AS city, r_name AS region,
  {PICK('c_custkey % 6', '18-24', '25-34', '35-44', '45-54', '55-64', '65+')} AS age_band,
  {PICK('c_custkey % 4', 'female', 'MALE', ' non-binary ', 'prefer not to say')} AS gender,
  CASE WHEN c_acctbal < 3000 THEN 'bronze' WHEN c_acctbal < 6500 THEN 'silver' WHEN c_acctbal < 9000 THEN 'gold' ELSE 'platinum' END AS loyalty_tier,
  c_mktsegment AS acquisition_channel, DATE '1995-01-01' + CAST(c_custkey % 2400 AS INTEGER) AS acquisition_date
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
cte("raw_products", f"""
SELECT 'SKU-' || p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory, p_brand AS brand,
  'SUP-' || p_partkey % 30 AS supplier_id, {PENCE('p_retailprice')} AS rrp_pence, {PENCE('p_retailprice')} * 40 // 100 AS cost_price_pence,
  p_partkey % 20 <> 0 AS is_active, DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS launch_date
FROM part""")
cte("raw_stores", """
SELECT 'STR-' || s_suppkey AS store_id, s_name AS store_name, CASE WHEN s_suppkey % 5 = 0 THEN 'Online' ELSE 'Physical' END AS store_type,
  n_name AS city, r_name AS region, CAST(NULL AS VARCHAR) AS postcode, DATE '1990-01-01' + CAST(s_suppkey % 1500 AS INTEGER) AS opening_date, true AS is_active
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
cte("raw_orders", f"""
SELECT o_orderkey AS k, 'ORD-' || o_orderkey AS order_id, 'CUS-' || o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Online' WHEN '2-HIGH' THEN 'In-Store' WHEN '3-MEDIUM' THEN 'App' WHEN '5-LOW' THEN 'Wholesale' ELSE 'Kiosk' END AS channel,
  CASE WHEN o_orderkey % 5 < 2 THEN 'CAM-' || o_orderkey % 100 END AS campaign_id, {PENCE('o_totalprice')} AS order_total_pence, 'POS' AS source_system
FROM orders""")
cte("raw_lines", f"""
SELECT *, net_revenue_pence - cost_of_goods_pence AS gross_profit_pence FROM (
SELECT l_orderkey AS ok, l_partkey AS pk, 'ORD-' || l_orderkey || '-' || l_linenumber AS order_line_id, 'ORD-' || l_orderkey AS order_id,
  'SKU-' || l_partkey AS product_id, 'STR-' || l_suppkey AS store_id, CAST(l_quantity AS BIGINT) AS units_sold, g AS gross_revenue_pence,
  g * CAST(round(l_discount * 100) AS BIGINT) // 100 AS discount_pence, g - g * CAST(round(l_discount * 100) AS BIGINT) // 100 AS net_revenue_pence,
  g * (40 + l_partkey % 30) // 100 AS cost_of_goods_pence, l_returnflag = 'R' AS is_returned,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS return_date
FROM (SELECT *, {PENCE('l_extendedprice')} AS g FROM lineitem))""")
cte("raw_inventory", f"""
SELECT day AS snapshot_date, 'SKU-' || l_partkey AS product_id, 'STR-' || l_suppkey AS store_id,
  CAST((l_partkey * 7 + l_suppkey * 13 + line * 29) % 201 AS BIGINT) AS stock_on_hand, 0::BIGINT AS units_received, units AS units_sold,
  0::BIGINT AS units_returned, CAST(10 + l_partkey % 31 AS BIGINT) AS reorder_point, CAST(3 * (10 + l_partkey % 31) AS BIGINT) AS reorder_quantity, 'WMS' AS source_system
FROM (SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day, max(l_linenumber) AS line, {BIG('sum(CAST(l_quantity AS BIGINT)) AS units')} FROM lineitem GROUP BY 1, 2, 3)""")
cte("keyed_events", "SELECT *, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
cte("raw_marketing", f"""
SELECT *, upper(replace(channel, ' ', '_')) AS source_system FROM (
SELECT 'CAM-' || k AS campaign_id, {PICK('k % 3', 'Paid Search', 'Paid Social', 'Email')} AS channel, CAST(ts AS DATE) AS date,
  {BIG(f"coalesce(sum({PENCE('value')}) FILTER (event_type = 'view'), 0) AS spend_pence", "count(*) * 20 AS impressions",
       "count(*) FILTER (event_type = 'click') AS clicks", "count(*) FILTER (event_type = 'purchase') AS attributed_orders",
       f"coalesce(sum({PENCE('value')}) FILTER (event_type = 'purchase'), 0) AS attributed_revenue_pence")}
FROM keyed_events GROUP BY 1, 2, 3)""")
cte("raw_touches", f"""
SELECT event_id AS touch_id, 'CUS-' || user_id AS customer_id, ts, {PICK('k % 5', *model.TOUCH_CHANNELS)} AS channel
FROM keyed_events WHERE event_type IN ('click', 'view')""")
cte("raw_conversions", f"""
SELECT event_id AS conversion_id, 'CUS-' || user_id AS customer_id, ts, {PENCE('value')} AS revenue_pence FROM events WHERE event_type = 'purchase'""")
cte("bad_orders", """
SELECT CASE WHEN k % 97 <> 0 THEN order_id END AS order_id, CASE WHEN k % 101 <> 0 THEN customer_id END AS customer_id,
  CASE WHEN k % 103 <> 0 THEN 'STR-' || k % 100 END AS store_id,
  CASE WHEN k % 73 = 0 THEN 'not-a-date' WHEN k % 109 <> 0 THEN strftime(order_date, '%Y-%m-%d') END AS order_date, channel, campaign_id,
  CASE WHEN k % 83 = 0 THEN -500 WHEN k % 79 <> 0 THEN order_total_pence END AS order_total_pence, source_system
FROM (SELECT *, unnest(range(CASE WHEN k % 89 = 0 THEN 2 ELSE 1 END)) AS copy FROM raw_orders)""")
cte("bad_lines", """
SELECT CASE WHEN ok % 107 <> 0 THEN order_line_id END AS order_line_id, CASE WHEN ok % 71 = 0 THEN 'ORD-X' WHEN ok % 97 <> 0 THEN order_id END AS order_id,
  CASE WHEN pk % 67 = 0 THEN 'SKU-X' WHEN pk % 113 <> 0 THEN product_id END AS product_id, CASE WHEN pk % 61 = 0 THEN 0 ELSE units_sold END AS units_sold
FROM raw_lines""")

# --- validation -----------------------------------------------------------------------------

NULLS = "CASE " + " ".join(f"WHEN {f} IS NULL THEN 'null_check:{f}'" for f in ("order_id", "customer_id", "store_id", "order_date")) + " END"
BAD_TOTAL = "(order_total_pence IS NULL OR order_total_pence <= 0)"
cte("checked_orders", f"""
SELECT order_id, customer_id, store_id, order_date, channel, campaign_id, order_total_pence, source_system,
  CASE WHEN missing IS NOT NULL THEN missing WHEN rn > 1 THEN 'duplicate_check:order_id' WHEN {BAD_TOTAL} THEN 'range_check:order_total_pence'
  WHEN try_cast(order_date AS DATE) IS NULL THEN 'date_check:order_date' END AS failed_check
FROM (SELECT *, row_number() OVER (PARTITION BY order_id, missing IS NULL ORDER BY customer_id, store_id, order_date, channel, campaign_id, order_total_pence) AS rn
      FROM (SELECT *, {NULLS} AS missing FROM bad_orders))""")
cte("checked_lines", """
SELECT order_line_id, order_id, product_id, units_sold, CASE WHEN order_line_id IS NULL THEN 'null_check:order_line_id' WHEN order_id IS NULL THEN 'null_check:order_id'
  WHEN product_id IS NULL THEN 'null_check:product_id' WHEN order_id NOT IN (SELECT order_id FROM checked_orders WHERE failed_check IS NULL) THEN 'ref_integrity:order_id'
  WHEN product_id NOT IN (SELECT product_id FROM raw_products) THEN 'ref_integrity:product_id' WHEN units_sold IS NULL OR units_sold < 1 THEN 'range_check:units_sold' END AS failed_check
FROM bad_lines""")
TALLY = "SELECT failed_check, channel, count(*) AS n FROM ({}) GROUP BY 1, 2".format
oracle("dq_null_check", TALLY(f"SELECT channel, {NULLS} AS failed_check FROM bad_orders"))
oracle("dq_duplicates", TALLY("""SELECT channel, CASE WHEN row_number() OVER (PARTITION BY order_id ORDER BY channel) > 1 THEN 'duplicate_check:order_id' END AS failed_check
FROM bad_orders WHERE order_id IS NOT NULL"""))
oracle("dq_range_check", TALLY(f"SELECT channel, CASE WHEN {BAD_TOTAL} THEN 'range_check:order_total_pence' END AS failed_check FROM bad_orders"))
oracle("dq_date_check", TALLY("SELECT channel, CASE WHEN try_cast(order_date AS DATE) IS NULL THEN 'date_check:order_date' END AS failed_check FROM bad_orders"))
oracle("dq_orphan_orders", f"""SELECT order_id, count(*) AS n, {BIG('sum(units_sold) AS units')} FROM bad_lines
WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM raw_orders) GROUP BY 1""")
oracle("dq_unknown_products", f"""SELECT product_id, count(*) AS n, {BIG('sum(units_sold) AS units')} FROM bad_lines
WHERE product_id IS NULL OR product_id NOT IN (SELECT product_id FROM raw_products) GROUP BY 1""")
REASON = """CASE split_part(failed_check, ':', 1) WHEN 'null_check' THEN 'NULL_PRIMARY_KEY' WHEN 'duplicate_check' THEN 'DUPLICATE_RECORD'
WHEN 'range_check' THEN 'INVALID_RANGE' WHEN 'date_check' THEN 'INVALID_DATE' END"""
oracle("dq_quarantine", f"""SELECT 'run-1' AS run_id, 'POS' AS source_system, {REASON} AS failure_reason, failed_check, order_id,
CAST(order_total_pence AS VARCHAR) AS order_total_pence FROM checked_orders WHERE failed_check IS NOT NULL""")
oracle("dq_validate_orders", "SELECT * FROM checked_orders")
oracle("dq_validate_lines", "SELECT * FROM checked_lines")
REPORT = ("SELECT '{0}' AS source, count(*) AS records_input, count(*) - count(failed_check) AS records_clean, count(failed_check) AS records_quarantined, "
          + P("count(failed_check)", "count(*)", 2) + " AS quarantine_rate_pct FROM {1}").format
oracle("dq_report", REPORT("orders", "checked_orders") + " UNION ALL " + REPORT("order_lines", "checked_lines"))
oracle("dq_dedupe_latest", """SELECT event_type, user_id, event_id, value FROM (
SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
oracle("dq_fill_missing", f"""SELECT channel, try_cast(order_date AS DATE) IS NULL AS date_missing, {BIG('sum(coalesce(order_total_pence, 0)) AS total_pence')},
count(*) FILTER (customer_id IS NULL) AS unknown_customers, count(*) FILTER (campaign_id IS NULL) AS unknown_campaigns, count(*) AS amounts,
round(max(coalesce(CAST(order_total_pence AS DOUBLE), m)), 0) AS max_amount FROM bad_orders, (SELECT avg(order_total_pence) AS m FROM bad_orders) GROUP BY 1, 2""")
oracle("dq_value_ceiling", "SELECT order_total_pence >= 5000000 AS needs_review, count(*) AS n, max(order_total_pence) AS largest FROM raw_orders GROUP BY 1")
oracle("dq_unknown_customers", """SELECT * FROM (SELECT CASE WHEN length(order_id) % 3 = 0 THEN customer_id || 'X' ELSE customer_id END AS customer_id, order_id
FROM bad_orders WHERE customer_id IS NOT NULL) WHERE customer_id NOT IN (SELECT customer_id FROM raw_customers)""")
FRESH = ("SELECT '{0}' AS source, CAST(date_diff('microsecond', max({1}), TIMESTAMP '{2}') // 1000000 AS BIGINT) AS age_seconds, "
         "date_diff('microsecond', max({1}), TIMESTAMP '{2}') // 1000000 > 26 * 3600 AS is_stale FROM {0}").format
oracle("dq_freshness", FRESH("orders", "o_orderdate", "2001-08-02 12:00:00") + " UNION ALL " + FRESH("events", "ts", "2024-01-31"))
oracle("dq_volume", f"""SELECT channel, order_date, records, {BIG('t AS prior_total')}, d AS prior_days,
coalesce(abs(records * d - t) * 100 > t * 20, false) AS is_outside FROM (
SELECT *, sum(records) OVER w AS t, count(records) OVER w AS d FROM (SELECT channel, order_date, count(*) AS records FROM raw_orders GROUP BY 1, 2)
WINDOW w AS (PARTITION BY channel ORDER BY order_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))""")
cte("run_log", f"""
SELECT run_date, source_system, n AS records_extracted, n - bad AS records_loaded, bad AS records_quarantined,
  CASE WHEN bad = 0 THEN 'SUCCESS' WHEN bad < n THEN 'PARTIAL' ELSE 'FAILED' END AS status, CAST(NULL AS VARCHAR) AS error_message, n * 2 AS duration_seconds
FROM (SELECT try_cast(order_date AS DATE) AS run_date, channel AS source_system, count(*) AS n, count(*) FILTER ({BAD_TOTAL} OR order_id IS NULL) AS bad
      FROM bad_orders WHERE try_cast(order_date AS DATE) IS NOT NULL GROUP BY 1, 2)""")
oracle("q8_pipeline_health", f"""SELECT run_date, source_system, status, records_extracted, records_loaded, records_quarantined,
{P('records_quarantined', 'records_extracted', 2)} AS quarantine_rate_pct, duration_seconds, error_message FROM run_log WHERE run_date >= {AS_OF} - 7""")
oracle("gate_reject_rate", "SELECT *, CASE WHEN quarantine_rate_pct > 5 THEN 'KEEP_PREVIOUS' ELSE 'PUBLISH' END AS action FROM ("
       + REPORT("faulty_orders", "checked_orders") + " UNION ALL "
       + REPORT("orders", f"(SELECT CASE WHEN {BAD_TOTAL} THEN 'x' END AS failed_check FROM raw_orders)") + ")")
oracle("gate_publish", """SELECT t.table_name, t.is_published, (SELECT count(*) FROM raw_orders) AS stored FROM (
SELECT 'orders' AS table_name, (SELECT count(*) FROM raw_orders WHERE order_id IS NULL) = 0 AS is_published UNION ALL
SELECT 'faulty_orders', (SELECT count(*) FROM bad_orders WHERE order_id IS NULL) = 0) t""")

# --- sources and sinks ----------------------------------------------------------------------

oracle("src_sql_query", f"SELECT channel, count(*) AS orders, {GBP('sum(order_total_pence)')} AS total_gbp FROM raw_orders WHERE order_total_pence > 0 GROUP BY 1")
oracle("src_read_columns", "SELECT product_id, category FROM raw_products")
oracle("src_lower_columns", "SELECT * FROM raw_stores")
oracle("src_read_raw", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, {c} AS n" for n, c in [(t, f"(SELECT count(*) FROM {s})") for t, s in (
        ("customers", "customer"), ("products", "part"), ("stores", "supplier"), ("orders", "orders"), ("order_lines", "lineitem"), ("marketing", "raw_marketing"))]
    + [("inventory", "0")]))
JSON_ROW = """('{"order_id":"' || order_id || '","customer_id":"' || customer_id || '","order_total_pence":' || order_total_pence || '}')"""
oracle("src_json_landing", f"""SELECT length({JSON_ROW}) % 7 = 0 AS is_corrupt, count(*) AS n,
{BIG(f"sum(CASE WHEN length({JSON_ROW}) % 7 <> 0 THEN order_total_pence END) AS total_pence")} FROM raw_orders GROUP BY 1""")
oracle("sink_load_roundtrip", f"SELECT 2 * count(*) AS stored, 2 * count(*) AS reported, {BIG('2 * sum(units_sold) AS units')} FROM raw_lines")
oracle("sink_write_processed", " UNION ALL ".join(f"SELECT '{n}' AS table_name, (SELECT count(*) FROM {t}) AS n" for n, t in (
    ("dim_customer", "customer"), ("dim_product", "part"), ("dim_store", "supplier"), ("fact_sales", "fact_sales"),
    ("fact_inventory", "raw_inventory"), ("fact_marketing_spend", "raw_marketing"))))
oracle("sink_quarantine", f"""SELECT 'run-1' AS run_id, 'POS' AS source_system, {REASON} AS failure_reason, failed_check, count(*) AS n,
(SELECT count(*) FROM checked_orders WHERE failed_check IS NOT NULL) AS appended FROM checked_orders WHERE failed_check IS NOT NULL GROUP BY failed_check""")
oracle("audit_run_log", f"""SELECT 'run-1' AS run_id, DATE '2001-08-02' AS run_date, 'ALL' AS source_system, {BIG("sum(records_input) AS records_extracted",
"sum(records_clean) AS records_loaded", "sum(records_quarantined) AS records_quarantined")}, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message,
TIMESTAMP '2001-08-02' AS started_at, TIMESTAMP '2001-08-02' AS completed_at, 0::BIGINT AS duration_seconds
FROM ({REPORT("orders", "checked_orders")} UNION ALL {REPORT("order_lines", "checked_lines")})""")
TESTED = [("bad_orders", c) for c in ("order_id", "customer_id", "store_id", "order_date")] + [
    (f"raw_{t}", c) for t, columns in (("customers", ("customer_id", "region")), ("products", ("product_id", "category")), ("stores", ("store_id", "region")),
                                       ("lines", ("order_line_id", "order_id", "product_id")), ("marketing", ("campaign_id", "channel"))) for c in columns]
AGE = "date_diff('microsecond', CAST(max({1}) AS TIMESTAMP), TIMESTAMP '2001-08-02') // 1000000 / 3600.0".format
oracle("dq_dashboard", "SELECT 'run' AS kind, status AS name, count(*) AS n, CAST(sum(records_extracted) AS DOUBLE) AS value FROM run_log GROUP BY status UNION ALL "
       "SELECT 'test', CASE WHEN f = 0 THEN 'passed' ELSE 'failed' END, count(*), CAST(sum(f) AS DOUBLE) FROM ("
       + " UNION ALL ".join(f"SELECT count(*) AS f FROM {t} WHERE {c} IS NULL" for t, c in TESTED) + ") GROUP BY 2 UNION ALL "
       + " UNION ALL ".join(f"SELECT 'freshness', '{t}', 1, {AGE(t, c)} FROM {t}" for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))))
oracle("sink_publish", "SELECT store_type, count(*) AS stores, true AS view_exists FROM raw_stores GROUP BY 1")
oracle("sink_partition_prune", f"""SELECT store_key, count(*) AS lines, {BIG('sum(units_sold) AS units')}, {GBP('sum(net_revenue_pence)')} AS revenue_gbp
FROM fact_sales WHERE date_key // 10000 = 1998 GROUP BY 1""")

# --- dimensions and facts -------------------------------------------------------------------

VERSION = "DATE '2001-08-02' AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current"
cte("dim_customer", f"""
SELECT customer_id, {TITLE('city')} AS city, {TITLE('region')} AS region, {TITLE('age_band')} AS age_band, {TITLE('gender')} AS gender, acquisition_channel, acquisition_date,
  {TITLE('loyalty_tier')} AS loyalty_tier, left(email, 1) || '***@' || split_part(email, '@', 2) AS email_masked, {SK('customer_id')} AS customer_key,
  CAST(NULL AS VARCHAR) AS postcode_district, CAST(NULL AS BIGINT) AS rfm_recency_score, CAST(NULL AS BIGINT) AS rfm_frequency_score,
  CAST(NULL AS BIGINT) AS rfm_monetary_score, CAST(NULL AS VARCHAR) AS rfm_segment, CAST(NULL AS DOUBLE) AS customer_ltv_gbp, {VERSION}
FROM raw_customers""")
cte("dim_product", f"""
SELECT product_id, product_name, {TITLE('category')} AS category, {TITLE('subcategory')} AS subcategory, brand, supplier_id, rrp_pence, cost_price_pence, is_active, launch_date,
  {SK('product_id')} AS product_key, CAST(NULL AS VARCHAR) AS supplier_name, CAST(NULL AS DATE) AS discontinue_date, {VERSION} FROM raw_products""")
cte("dim_store", f"SELECT *, {SK('store_id')} AS store_key, 'United Kingdom' AS country, {VERSION} FROM raw_stores")
HOLIDAYS = " UNION ALL ".join(f"SELECT '{n}' AS holiday_name, DATE '{d}' AS holiday_date" for n, d in model.UK_HOLIDAYS)
cte("computus", """
SELECT y, make_date(y, e // 31, e % 31 + 1) AS easter FROM (SELECT y, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS e FROM (
SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM (
SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM (
SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM (SELECT unnest(range(1990, 2031)) AS y)))))""")
cte("rule_holidays", """
SELECT 'New Year' AS holiday_name, make_date(y, 1, 1) + CASE WHEN isodow(make_date(y, 1, 1)) = 7 THEN 1 ELSE 0 END AS holiday_date FROM computus
UNION ALL SELECT 'Good Friday', easter - 2 FROM computus UNION ALL SELECT 'Easter Monday', easter + 1 FROM computus
UNION ALL SELECT 'Early May Bank', make_date(y, 5, 1) + CAST((8 - isodow(make_date(y, 5, 1))) % 7 AS INTEGER) FROM computus
UNION ALL SELECT 'Spring Bank', make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) FROM computus
UNION ALL SELECT 'Summer Bank', make_date(y, 8, 31) - CAST(isodow(make_date(y, 8, 31)) - 1 AS INTEGER) FROM computus
UNION ALL SELECT 'Christmas Day', make_date(y, 12, 25) FROM computus UNION ALL SELECT 'Boxing Day', make_date(y, 12, 26) FROM computus""")
cte("fixed_holidays", HOLIDAYS)
cte("holidays", "SELECT * FROM fixed_holidays UNION ALL SELECT * FROM rule_holidays WHERE year(holiday_date) NOT IN (SELECT year(holiday_date) FROM fixed_holidays)")
PROMO = " OR ".join(f"month(d) * 100 + day(d) BETWEEN {a} AND {b}" for a, b in model.PROMO_PERIODS)
cte("cal", f"""
SELECT {DKEY('d')} AS date_key, d AS full_date, dayname(d) AS day_of_week, isodow(d) AS day_of_week_num, week(d) AS week_number, month(d) AS month_num,
  monthname(d) AS month_name, quarter(d) AS quarter, year(d) AS year, isoyear(d) AS iso_year, isodow(d) >= 6 AS is_weekend,
  holiday_date IS NOT NULL AS is_uk_public_holiday, holiday_name, ({PROMO}) AS is_promotional,
  CASE WHEN month(d) IN (3, 4, 5) THEN 'Spring' WHEN month(d) IN (6, 7, 8) THEN 'Summer' WHEN month(d) IN (9, 10, 11) THEN 'Autumn' ELSE 'Winter' END AS season
FROM (SELECT CAST(unnest(range(DATE '1990-01-01', DATE '2031-01-01', INTERVAL 1 DAY)) AS DATE) AS d) LEFT JOIN holidays ON d = holiday_date""")
oracle("dim_customer", "SELECT * FROM dim_customer")
oracle("dim_product", "SELECT * FROM dim_product")
oracle("dim_store", "SELECT * FROM dim_store")
SPAN = "(SELECT min(order_date) FROM raw_orders) AND (SELECT max(order_date) FROM raw_orders)"
oracle("dim_date", f"SELECT * FROM cal WHERE full_date BETWEEN {SPAN}")
oracle("fn_date_spine", f"SELECT full_date AS calendar_date FROM cal WHERE full_date BETWEEN {SPAN}")
KEYS = "CASE {} WHEN 'Online' THEN 1 WHEN 'In-Store' THEN 2 WHEN 'App' THEN 3 WHEN 'Wholesale' THEN 4 ELSE 99 END".format
oracle("dim_channel", f"""SELECT channel_key, orders, channel_id, channel_name, channel_type FROM (
SELECT CAST({KEYS('channel')} AS BIGINT) AS channel_key, count(*) AS orders FROM raw_orders GROUP BY 1) LEFT JOIN (VALUES (1, 'ONLINE', 'Online', 'Digital'),
(2, 'IN_STORE', 'In-Store', 'Physical'), (3, 'APP', 'App', 'Digital'), (4, 'WHOLESALE', 'Wholesale', 'Physical')) c(channel_key, channel_id, channel_name, channel_type) USING (channel_key)""")
cte("campaigns", f"""
SELECT {SK('campaign_id')} AS campaign_key, campaign_id, campaign_id AS campaign_name, min(channel) AS channel, min(date) AS start_date, max(date) AS end_date,
  {BIG('sum(spend_pence) AS budget_pence')}, 'Conversion' AS objective FROM raw_marketing GROUP BY campaign_id""")
oracle("dim_campaign", "SELECT * FROM campaigns")
cte("all_days", """SELECT order_date AS day, 1 AS o, 0 AS e FROM raw_orders UNION ALL SELECT CAST(ts AS DATE), 0, 1 FROM events""")
oracle("dim_holiday_effects", f"""SELECT holiday_name, year(day) AS effect_year, {BIG('sum(o) AS orders', 'sum(e) AS events')}
FROM all_days JOIN (SELECT holiday_name, holiday_date + unnest([0, 1]) AS effect_date FROM rule_holidays) ON day = effect_date GROUP BY 1, 2""")
oracle("key_surrogate", f"SELECT product_id, {SK('product_id')} AS product_key FROM raw_products")
oracle("key_date", f"SELECT {DKEY('order_date')} AS date_key, count(*) AS orders FROM raw_orders GROUP BY 1")
cte("fact_sales", f"""
SELECT {SK('order_line_id')} AS sale_key, l.order_id, order_line_id, {DKEY('order_date')} AS date_key, customer_key, product_key, store_key,
  CAST({KEYS('channel')} AS BIGINT) AS channel_key, {SK('campaign_id')} AS campaign_key, units_sold, gross_revenue_pence, discount_pence, net_revenue_pence,
  cost_of_goods_pence, gross_profit_pence, is_returned, return_date, {DKEY('return_date')} AS return_date_key, 'POS' AS source_system, 'run-1' AS pipeline_run_id
FROM raw_lines l LEFT JOIN raw_orders o USING (order_id) LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
LEFT JOIN dim_product p ON l.product_id = p.product_id LEFT JOIN dim_store s ON l.store_id = s.store_id""")
oracle("fact_sales", "SELECT * FROM fact_sales")
RAG = "CASE WHEN {} THEN 'RED' WHEN stock_on_hand * 10 <= reorder_point * 12 THEN 'AMBER' ELSE 'GREEN' END".format
cte("stock", f"""
SELECT *, {RAG('stock_on_hand <= reorder_point')} AS stock_status,
  {R('stock_on_hand * count(*) OVER p', 'sum(units_sold) OVER p', 1)} AS days_of_stock_remaining
FROM raw_inventory WINDOW p AS (PARTITION BY product_id, store_id)""")
cte("fact_inventory", f"""
SELECT i.*, product_key, store_key, {DKEY('snapshot_date')} AS date_key, {SK("product_id || store_id || strftime(snapshot_date, '%Y-%m-%d')")} AS inventory_key, 'run-1' AS pipeline_run_id
FROM stock i LEFT JOIN (SELECT product_id, product_key FROM dim_product) USING (product_id) LEFT JOIN (SELECT store_id, store_key FROM dim_store) USING (store_id)""")
oracle("fact_inventory", "SELECT * FROM fact_inventory")
cte("fact_marketing", f"""
SELECT *, {DKEY('date')} AS date_key, {SK('campaign_id')} AS campaign_key, {SK("campaign_id || strftime(date, '%Y-%m-%d')")} AS spend_key,
  CAST(clicks AS DOUBLE) / nullif(impressions, 0) AS ctr, CAST(coalesce(round_even(CAST(spend_pence AS DOUBLE) / nullif(clicks, 0), 0), 0) AS BIGINT) AS cpc_pence,
  CAST(attributed_revenue_pence AS DOUBLE) / nullif(spend_pence, 0) AS roas, 'run-1' AS pipeline_run_id FROM raw_marketing""")
oracle("fact_marketing_spend", "SELECT * FROM fact_marketing")
oracle("fn_safe_divide", "SELECT campaign_id, channel, date, CAST(attributed_revenue_pence AS DOUBLE) / nullif(spend_pence, 0) AS roas FROM raw_marketing")
cte("snapshots", """
SELECT customer_id, city, unnest([DATE '2001-06-01', DATE '2001-07-01', DATE '2001-08-01']) AS snapshot_date, loyalty_tier FROM dim_customer""")
cte("changed_snapshots", """
SELECT customer_id, city, snapshot_date, CASE WHEN snapshot_date = DATE '2001-07-01' AND CAST(substr(customer_id, 5) AS BIGINT) % 7 = 0 THEN 'Platinum' ELSE loyalty_tier END AS loyalty_tier FROM snapshots""")
oracle("scd2_history", """SELECT customer_id, loyalty_tier, city, snapshot_date AS valid_from, lead(snapshot_date) OVER w - 1 AS valid_to, lead(snapshot_date) OVER w IS NULL AS is_current,
row_number() OVER w AS version FROM (SELECT *, lag(loyalty_tier) OVER (PARTITION BY customer_id ORDER BY snapshot_date) AS prev FROM changed_snapshots)
WHERE prev IS NULL OR prev <> loyalty_tier WINDOW w AS (PARTITION BY customer_id ORDER BY snapshot_date)""")
cte("merge_input", "SELECT customer_id, loyalty_tier, city, CAST(substr(customer_id, 5) AS BIGINT) AS k FROM dim_customer")
FIRST, TODAY = "DATE '2001-06-01'", AS_OF
def dated_versions(dim: str, natural: str, every: int) -> str:
    """Versions (first day, key) of every member: one, or three where it moved and came back."""
    k = f"CAST(substr({natural}, 5) AS BIGINT) % {every}"
    days = "DATE '1993-01-01', DATE '1996-03-01', DATE '1998-09-01'"
    keyed = SK(f"CASE WHEN version = 1 THEN {natural} ELSE {natural} || '#' || version END")
    return f"""SELECT *, {keyed} AS version_key, coalesce(lead(valid_from) OVER (PARTITION BY {natural} ORDER BY valid_from), DATE '9999-01-01') AS next_from FROM (
SELECT {natural}, unnest(CASE WHEN {k} = 0 THEN [{days}] ELSE [DATE '1993-01-01'] END) AS valid_from,
  unnest(CASE WHEN {k} = 0 THEN [1, 2, 3] ELSE [1] END) AS version FROM {dim})"""


cte("customer_versions", dated_versions("dim_customer", "customer_id", 7))
cte("product_versions", dated_versions("dim_product", "product_id", 3))
oracle("fact_sales_asof", f"""
SELECT order_line_id, {DKEY('order_date')} AS date_key, c.version_key AS customer_key, p.version_key AS product_key, store_key, net_revenue_pence
FROM raw_lines l LEFT JOIN raw_orders o USING (order_id) LEFT JOIN dim_store s ON l.store_id = s.store_id
LEFT JOIN customer_versions c ON o.customer_id = c.customer_id AND (order_date >= c.valid_from OR c.version = 1) AND order_date < c.next_from
LEFT JOIN product_versions p ON l.product_id = p.product_id AND (order_date >= p.valid_from OR p.version = 1) AND order_date < p.next_from""")
oracle("scd2_merge", f"""
SELECT customer_id || '-old' AS customer_id, loyalty_tier, city, {FIRST} AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current, 1::BIGINT AS version FROM merge_input WHERE k % 11 = 0
UNION ALL SELECT customer_id, CASE WHEN k % 7 = 0 THEN 'Platinum' ELSE loyalty_tier END, city, {TODAY}, NULL, true, 1 FROM merge_input WHERE k % 11 = 0
UNION ALL SELECT customer_id, loyalty_tier, city, {FIRST}, CASE WHEN k % 7 = 0 AND loyalty_tier <> 'Platinum' THEN {TODAY} - 1 END, NOT (k % 7 = 0 AND loyalty_tier <> 'Platinum'), 1 FROM merge_input WHERE k % 11 <> 0
UNION ALL SELECT customer_id, 'Platinum', city, {TODAY}, NULL, true, 2 FROM merge_input WHERE k % 11 <> 0 AND k % 7 = 0 AND loyalty_tier <> 'Platinum'""")

# --- staging and intermediate ---------------------------------------------------------------

MONEY = ", ".join(f"{GBP(m + '_pence')} AS {m}_gbp" for m in ("gross_revenue", "discount", "net_revenue", "cost_of_goods", "gross_profit"))
MARGIN = P("gross_profit_pence", "net_revenue_pence", 2) + " AS gross_margin_pct"
cte("stg_sales", f"""
SELECT sale_key, order_id, order_line_id, date_key, customer_key, product_key, store_key, channel_key, campaign_key, units_sold, {MONEY}, {MARGIN}, is_returned, return_date_key,
  source_system, pipeline_run_id FROM fact_sales""")
oracle("stg_sales", "SELECT * FROM stg_sales")
oracle("stg_customers", "SELECT * FROM dim_customer")
oracle("stg_products", f"""SELECT product_key, product_id, product_name, category, subcategory, brand, supplier_id, supplier_name, {GBP('cost_price_pence')} AS cost_price_gbp,
{GBP('rrp_pence')} AS rrp_gbp, is_active, launch_date, discontinue_date, is_current, valid_from, valid_to FROM dim_product""")
oracle("stg_stores", "SELECT * FROM dim_store")
oracle("stg_inventory", "SELECT * EXCLUDE (snapshot_date, product_id, store_id) FROM fact_inventory")
oracle("stg_marketing_spend", f"""SELECT spend_key, date_key, campaign_key, impressions, clicks, {GBP('spend_pence')} AS spend_gbp, {GBP('attributed_revenue_pence')} AS attributed_revenue_gbp,
attributed_orders, ctr, {GBP('cpc_pence')} AS cpc_gbp, roas, source_system, pipeline_run_id FROM fact_marketing""")
cte("enriched", """
SELECT order_line_id, l.order_id, full_date AS order_date, d.year AS order_year, month_num AS order_month, month_name AS order_month_name, d.quarter AS order_quarter,
  week_number AS order_week, iso_year AS order_iso_year, day_of_week AS order_day_of_week, is_weekend, is_uk_public_holiday, is_promotional AS is_promotional_period, season,
  c.customer_id, age_band, gender, c.region AS customer_region, c.city AS customer_city, loyalty_tier, acquisition_channel, acquisition_date, rfm_segment, customer_ltv_gbp,
  p.product_id, product_name, category, subcategory, brand, supplier_id, rrp_pence, s.store_id, store_name, store_type, s.region AS store_region, s.city AS store_city, channel,
  units_sold, gross_revenue_pence, discount_pence, net_revenue_pence, cost_of_goods_pence, gross_profit_pence, is_returned, return_date
FROM raw_lines l LEFT JOIN raw_orders o USING (order_id) LEFT JOIN cal d ON o.order_date = full_date LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
LEFT JOIN dim_product p ON l.product_id = p.product_id LEFT JOIN dim_store s ON l.store_id = s.store_id""")
cte("sold", "SELECT * FROM enriched WHERE NOT is_returned")
oracle("int_sales_enriched", f"""SELECT {SK('order_line_id')} AS sale_key, order_id, order_line_id, order_date, order_year, order_month, order_month_name, order_quarter, order_week, order_day_of_week,
is_weekend, is_uk_public_holiday, is_promotional_period, season, customer_id, age_band, gender, customer_region, customer_city, loyalty_tier, acquisition_channel, rfm_segment,
customer_ltv_gbp, product_id, product_name, category, subcategory, brand, supplier_id, {GBP('rrp_pence')} AS rrp_gbp, store_id, store_name, store_type, store_region, store_city, units_sold,
{MONEY}, {MARGIN}, {GBP('net_revenue_pence')} / nullif(units_sold, 0) AS revenue_per_unit,
{GBP('discount_pence')} / nullif({GBP('gross_revenue_pence')}, 0) * 100 AS discount_pct, is_returned, {DKEY('return_date')} AS return_date_key, 'run-1' AS pipeline_run_id FROM enriched""")
cte("top_category", """
SELECT customer_id, category AS top_category FROM (SELECT customer_id, category, row_number() OVER (PARTITION BY customer_id ORDER BY sum(net_revenue_pence) DESC, category) AS rn
FROM sold GROUP BY 1, 2) WHERE rn = 1""")
oracle("customer_top_category", "SELECT * FROM top_category")


def customer_orders(as_of: str, condition: str = "true") -> str:
    return f"""
SELECT customer_id, customer_region, loyalty_tier, acquisition_channel, {as_of} - max(order_date) AS days_since_last_purchase, max(order_date) AS last_purchase_date,
  min(order_date) AS first_purchase_date, count(DISTINCT order_date) AS purchase_frequency, count(DISTINCT order_id) AS total_orders, {BIG('sum(units_sold) AS total_units_purchased')},
  {GBP('sum(net_revenue_pence)')} AS total_revenue_gbp, {R('sum(net_revenue_pence)', 'count(*) * 100', 2)} AS avg_order_value_gbp, {GBP('sum(gross_profit_pence)')} AS total_profit_gbp,
  count(*) FILTER (is_weekend) AS weekend_orders, count(*) FILTER (is_promotional_period) AS promo_orders, count(*) FILTER (store_type = 'Online') AS online_orders,
  count(*) FILTER (store_type = 'Physical') AS instore_orders, {as_of} - min(order_date) AS customer_age_days, {BIG('sum(net_revenue_pence) AS total_revenue_pence')}
FROM sold WHERE {condition} GROUP BY 1, 2, 3, 4"""


cte("customer_orders", customer_orders(AS_OF))
BEFORE = "DATE '2001-07-02'"
cte("customer_orders_before", customer_orders(BEFORE, f"order_date < {BEFORE}"))
oracle("int_customer_orders", "SELECT * EXCLUDE (total_revenue_pence) FROM customer_orders JOIN top_category USING (customer_id)")
oracle("customer_state", "SELECT * EXCLUDE (total_revenue_pence) FROM customer_orders JOIN top_category USING (customer_id)")
oracle("int_customer_orders_12m", "SELECT customer_id, days_since_last_purchase, purchase_frequency, total_orders, total_revenue_gbp FROM ("
       + customer_orders(AS_OF, "order_date >= DATE '2000-08-02'") + ")")

# --- segments -------------------------------------------------------------------------------

SEGMENT = "CASE " + " ".join(
    f"WHEN r_score BETWEEN {r[0]} AND {r[1]} AND f_score BETWEEN {f[0]} AND {f[1]} AND m_score BETWEEN {m[0]} AND {m[1]} THEN '{name}'" for name, r, f, m in model.SEGMENT_RULES
) + " ELSE 'Others' END"
PRIORITY = "CASE rfm_segment " + " ".join(f"WHEN '{n}' THEN {p}" for n, p in model.SEGMENT_PRIORITY.items()) + " END"


def ntile_scores(source: str, r: str = "{}") -> str:
    tie = "customer_id"
    recency = r.format(f"ntile(5) OVER (ORDER BY days_since_last_purchase DESC, {tie})")
    return f"""
SELECT *, {SEGMENT} AS rfm_segment FROM (SELECT *, {recency} AS r_score,
  ntile(5) OVER (ORDER BY purchase_frequency, {tie}) AS f_score, ntile(5) OVER (ORDER BY total_revenue_pence, {tie}) AS m_score FROM {source})"""


cte("rfm", ntile_scores("customer_orders"))
cte("rfm_before", ntile_scores("customer_orders_before"))
oracle("mart_customer_rfm", f"""SELECT customer_id, customer_region, loyalty_tier, acquisition_channel, top_category, first_purchase_date, last_purchase_date, days_since_last_purchase,
purchase_frequency, total_orders, total_revenue_gbp, avg_order_value_gbp, total_profit_gbp, customer_age_days, online_orders, instore_orders,
{P('online_orders', 'total_orders', 1)} AS online_pct, {P('instore_orders', 'total_orders', 1)} AS instore_pct, r_score, f_score, m_score, r_score + f_score + m_score AS rfm_total_score,
rfm_segment, CAST({PRIORITY} AS BIGINT) AS segment_priority FROM rfm JOIN top_category USING (customer_id)""")
oracle("mart_customer_rfm_literal", "SELECT customer_id, r_score, rfm_segment FROM (" + ntile_scores("customer_orders", "6 - {}") + ")")
cte("metrics", f"""
SELECT customer_id, max(order_date) AS last_purchase_date, min(order_date) AS first_purchase_date, count(DISTINCT order_date) AS purchase_frequency, count(DISTINCT order_id) AS total_orders,
  {GBP('sum(net_revenue_pence)')} AS total_revenue_gbp, {R('sum(net_revenue_pence)', 'count(*) * 100', 2)} AS avg_order_value_gbp,
  {AS_OF} - max(order_date) AS days_since_last_purchase, {AS_OF} - min(order_date) AS customer_age_days, {BIG('sum(net_revenue_pence) AS total_revenue_pence')}
FROM raw_lines JOIN raw_orders USING (order_id) WHERE is_returned IS DISTINCT FROM true GROUP BY 1""")
BIN = f"CASE WHEN count(*) OVER () = 1 THEN 1 ELSE greatest(1, (5 * (row_number() OVER (ORDER BY {{0}}, customer_id) - 1) + count(*) OVER () - 2) // (count(*) OVER () - 1)) END".format
cte("qcut", f"""
SELECT *, {SEGMENT} AS rfm_segment FROM (SELECT *, 6 - {BIN('days_since_last_purchase')} AS r_score, {BIN('purchase_frequency')} AS f_score, {BIN('total_revenue_pence')} AS m_score FROM metrics)""")
oracle("rfm_metrics", "SELECT * EXCLUDE (total_revenue_pence) FROM metrics")
oracle("rfm_qcut_scores", "SELECT customer_id, r_score, f_score, m_score, r_score + f_score + m_score AS rfm_total_score FROM qcut")
oracle("rfm_segments", f"""SELECT q.* EXCLUDE (total_revenue_pence), r_score + f_score + m_score AS rfm_total_score, CAST({PRIORITY} AS BIGINT) AS segment_priority, region, loyalty_tier, acquisition_channel
FROM qcut q LEFT JOIN raw_customers USING (customer_id)""")
oracle("rfm_segment_summary", f"""SELECT rfm_segment, count(*) AS customers, {P('count(*)', 'sum(count(*)) OVER ()', 1)} AS pct_of_base, {GBP('sum(total_revenue_pence)')} AS total_revenue,
{R('sum(total_revenue_pence)', 'count(*) * 100', 2)} AS avg_ltv, {R('sum(total_orders)', 'count(*)', 2)} AS avg_orders, {R('sum(days_since_last_purchase)', 'count(*)', 2)} AS avg_days_since
FROM qcut GROUP BY 1""")
oracle("rfm_heatmap", "SELECT r_score, " + ", ".join(
    R(f"sum(total_revenue_pence) FILTER (f_score = {f})", f"(count(*) FILTER (f_score = {f})) * 100", 0) + f" AS f{f}" for f in range(1, 6)) + " FROM qcut GROUP BY 1")
oracle("rfm_segment_counts", f"""SELECT rfm_segment, count(*) AS customers, {GBP('sum(total_revenue_pence)')} AS revenue_gbp, {P('sum(total_revenue_pence)', 'sum(sum(total_revenue_pence)) OVER ()', 1)} AS revenue_share_pct,
{R(f"sum({PENCE('avg_order_value_gbp')})", 'count(*) * 100', 2)} AS avg_aov_gbp FROM qcut GROUP BY 1""")
oracle("rfm_migration", """SELECT coalesce(b.rfm_segment, 'NONE') AS from_segment, coalesce(a.rfm_segment, 'NONE') AS to_segment, count(*) AS customers
FROM rfm a FULL JOIN rfm_before b USING (customer_id) GROUP BY 1, 2""")
oracle("rfm_moved_at_risk", """SELECT customer_id, b.rfm_segment AS from_segment, a.days_since_last_purchase, a.total_revenue_gbp AS ltv_gbp
FROM rfm a JOIN rfm_before b USING (customer_id) WHERE a.rfm_segment = 'At Risk' AND b.rfm_segment <> 'At Risk'""")
oracle("rfm_acquisition_crosstab", f"SELECT rfm_segment, acquisition_channel, count(*) AS customers, {GBP('sum(total_revenue_pence)')} AS revenue_gbp FROM rfm GROUP BY 1, 2")
oracle("rfm_history", f"""SELECT {BEFORE} AS run_date, rfm_segment, count(*) AS customers FROM rfm_before GROUP BY 2 UNION ALL SELECT {AS_OF}, rfm_segment, count(*) FROM
(SELECT * FROM rfm) GROUP BY 2""")
oracle("rfm_channel_crosstab", f"""SELECT rfm_segment, channel, {BIG('sum(f) AS first_purchase_customers', 'sum(l) AS last_purchase_customers')} FROM rfm JOIN (
SELECT customer_id, channel, CASE WHEN side = 0 THEN 1 ELSE 0 END AS f, CASE WHEN side = 1 THEN 1 ELSE 0 END AS l FROM (
SELECT customer_id, unnest([arg_min(channel, (order_date, order_id)), arg_max(channel, (order_date, order_id))]) AS channel, unnest([0, 1]) AS side FROM raw_orders GROUP BY 1)) USING (customer_id) GROUP BY 1, 2""")
oracle("customer_clv", "SELECT customer_id, total_revenue_gbp AS clv_gbp, total_orders, avg_order_value_gbp FROM metrics")
cte("churn", f"""
SELECT customer_id, days_since_last_purchase, {R('last_purchase_date - first_purchase_date', 'purchase_frequency - 1', 2)} AS mean_gap_days,
  {R('days_since_last_purchase * (purchase_frequency - 1)', 'last_purchase_date - first_purchase_date', 3)} AS churn_score FROM metrics""")
oracle("customer_churn_risk", "SELECT * FROM churn")
oracle("export_segment_members", """SELECT customer_id, email_masked, rfm.rfm_segment AS segment, last_purchase_date, total_revenue_gbp AS ltv_gbp FROM rfm LEFT JOIN dim_customer USING (customer_id)
WHERE rfm.rfm_segment = 'At Risk'""")
oracle("q4_segment_distribution", f"""SELECT rfm_segment, count(*) AS customer_count, {P('count(*)', 'sum(count(*)) OVER ()', 1)} AS pct_of_base,
{R('sum(total_revenue_pence)', 'count(*) * 100', 2)} AS avg_ltv_gbp, {GBP('sum(total_revenue_pence)')} AS total_ltv_gbp FROM rfm GROUP BY 1""")
oracle("dash_top_customers", """SELECT customer_id, rfm_segment, total_revenue_gbp AS ltv_gbp, total_orders, last_purchase_date FROM rfm ORDER BY total_revenue_pence DESC, customer_id LIMIT 100""")
oracle("dash_blend", "SELECT customer_id, rfm_segment, churn.days_since_last_purchase, mean_gap_days, churn_score FROM rfm LEFT JOIN churn USING (customer_id)")

# --- marts ----------------------------------------------------------------------------------

cte("daily", f"""
SELECT order_date, order_year, order_month, order_month_name, order_quarter, order_week, is_weekend, is_promotional_period, season, {GBP('sum(net_revenue_pence)')} AS revenue_gbp,
  {GBP('sum(gross_profit_pence)')} AS gross_profit_gbp, {GBP('sum(discount_pence)')} AS discount_gbp, count(DISTINCT order_id) AS total_orders, {BIG('sum(units_sold) AS total_units')},
  count(DISTINCT customer_id) AS unique_customers, {R('sum(net_revenue_pence)', 'count(DISTINCT order_id) * 100', 2)} AS avg_order_value_gbp,
  {P('sum(gross_profit_pence)', 'sum(net_revenue_pence)', 2)} AS gross_margin_pct, count(*) FILTER (is_returned) AS returned_lines,
  {GBP('sum(CASE WHEN is_returned THEN net_revenue_pence ELSE 0 END)')} AS returned_revenue_gbp, {GBP("sum(CASE WHEN store_type = 'Online' THEN net_revenue_pence ELSE 0 END)")} AS online_revenue_gbp,
  {GBP("sum(CASE WHEN store_type = 'Physical' THEN net_revenue_pence ELSE 0 END)")} AS instore_revenue_gbp,
  count(*) FILTER (acquisition_channel IS NOT NULL AND order_date = first_day) AS new_customer_orders
FROM (SELECT *, min(order_date) OVER (PARTITION BY customer_id) AS first_day FROM enriched) WHERE order_date >= DATE '1995-01-01' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""")
oracle("daily_sales_kpis", "SELECT * FROM daily")
oracle("mart_executive_kpis", f"""SELECT d.*, w.revenue_gbp AS revenue_gbp_wow, w.total_orders AS orders_wow, w.avg_order_value_gbp AS aov_wow, y.revenue_gbp AS revenue_gbp_yoy, y.total_orders AS orders_yoy,
{P(PENCE('d.revenue_gbp') + ' - ' + PENCE('w.revenue_gbp'), PENCE('w.revenue_gbp'), 1)} AS revenue_growth_wow_pct,
{P(PENCE('d.revenue_gbp') + ' - ' + PENCE('y.revenue_gbp'), PENCE('y.revenue_gbp'), 1)} AS revenue_growth_yoy_pct,
{P('d.total_orders - w.total_orders', 'w.total_orders', 1)} AS orders_growth_wow_pct
FROM daily d LEFT JOIN daily w ON w.order_date = d.order_date - 7 LEFT JOIN daily y ON y.order_date = d.order_date - 364""")
oracle("mart_store_performance", f"""SELECT store_id, store_name, store_type, store_region, store_city, order_year, order_month, order_month_name, {GBP('sum(net_revenue_pence)')} AS revenue_gbp,
{GBP('sum(gross_profit_pence)')} AS gross_profit_gbp, {GBP('sum(discount_pence)')} AS discount_gbp, {P('sum(gross_profit_pence)', 'sum(net_revenue_pence)', 2)} AS gross_margin_pct,
count(DISTINCT order_id) AS total_orders, {BIG('sum(units_sold) AS total_units')}, count(DISTINCT customer_id) AS unique_customers,
{R('sum(net_revenue_pence)', 'count(DISTINCT order_id) * 100', 2)} AS avg_order_value_gbp, {P('count(*) FILTER (is_returned)', 'count(*)', 2)} AS return_rate_pct,
rank() OVER (PARTITION BY order_year, order_month ORDER BY sum(net_revenue_pence) DESC) AS revenue_rank_in_month FROM enriched GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""")
oracle("mart_product_performance", f"""SELECT product_id, product_name, category, subcategory, brand, {GBP('rrp_pence')} AS rrp_gbp, order_year, order_iso_year, order_week, {GBP('sum(net_revenue_pence)')} AS revenue_gbp,
{GBP('sum(gross_profit_pence)')} AS gross_profit_gbp, {P('sum(gross_profit_pence)', 'sum(net_revenue_pence)', 2)} AS gross_margin_pct, {BIG('sum(units_sold) AS units_sold')},
count(DISTINCT order_id) AS orders_containing_product, count(DISTINCT customer_id) AS unique_buyers, {R('sum(net_revenue_pence)', 'sum(units_sold) * 100', 2)} AS avg_selling_price_gbp,
{P('rrp_pence * sum(units_sold) - sum(net_revenue_pence)', 'rrp_pence * sum(units_sold)', 1)} AS avg_discount_vs_rrp_pct,
{GBP("sum(CASE WHEN store_type = 'Online' THEN net_revenue_pence ELSE 0 END)")} AS online_revenue_gbp, {GBP("sum(CASE WHEN store_type = 'Physical' THEN net_revenue_pence ELSE 0 END)")} AS instore_revenue_gbp,
rank() OVER (PARTITION BY order_year, order_iso_year, order_week, category ORDER BY sum(net_revenue_pence) DESC) AS rank_in_category
FROM sold GROUP BY product_id, product_name, category, subcategory, brand, rrp_pence, order_year, order_iso_year, order_week""")
cte("inventory_status", f"""
SELECT inventory_key, date_key, product_id, product_name, category, subcategory, supplier_id, store_id, store_name, store_type, s.region AS store_region, stock_on_hand, units_received, units_sold,
  reorder_point, reorder_quantity, stock_status, days_of_stock_remaining, stock_on_hand <= 0 AS is_out_of_stock, stock_on_hand <= reorder_point AS needs_reorder,
  stock_on_hand - reorder_point AS stock_above_reorder, {GBP('greatest(reorder_point - stock_on_hand, 0) * coalesce(rrp_pence, 0)')} AS potential_lost_revenue_gbp
FROM (SELECT *, row_number() OVER (PARTITION BY product_id, store_id ORDER BY date_key DESC, inventory_key DESC) AS rn FROM fact_inventory) i
JOIN dim_product p USING (product_id) JOIN dim_store s USING (store_id) WHERE rn = 1""")
oracle("mart_inventory_status", "SELECT * FROM inventory_status")
cte("marketing_months", f"""
SELECT year(m.date) AS year, month(m.date) AS month_num, monthname(m.date) AS month_name, campaign_id, campaign_name, c.channel AS marketing_channel, objective,
  {BIG('sum(spend_pence) AS spend', 'sum(impressions) AS total_impressions', 'sum(clicks) AS total_clicks', 'sum(attributed_revenue_pence) AS revenue', 'sum(attributed_orders) AS attributed_orders')}
FROM raw_marketing m JOIN campaigns c USING (campaign_id) GROUP BY 1, 2, 3, 4, 5, 6, 7""")
oracle("mart_marketing_attribution", f"""SELECT year, month_num, month_name, campaign_id, campaign_name, marketing_channel, objective, {GBP('spend')} AS total_spend_gbp, total_impressions, total_clicks,
{P('total_clicks', 'total_impressions', 3)} AS ctr_pct, {R('spend', 'total_clicks * 100', 4)} AS avg_cpc_gbp, {GBP('revenue')} AS attributed_revenue_gbp, attributed_orders, {R('revenue', 'spend', 2)} AS roas,
{R('spend', 'attributed_orders * 100', 2)} AS cost_per_order_gbp, {P('revenue', 'sum(revenue) OVER (PARTITION BY year, month_num)', 2)} AS revenue_share_pct FROM marketing_months""")

# --- analytical queries ---------------------------------------------------------------------

oracle("q1_daily_revenue", f"""SELECT order_date AS full_date, order_day_of_week AS day_of_week, is_weekend, count(DISTINCT order_id) AS total_orders, {BIG('sum(units_sold) AS total_units')},
{GBP('sum(net_revenue_pence)')} AS net_revenue_gbp, {GBP('sum(gross_profit_pence)')} AS gross_profit_gbp, {P('sum(gross_profit_pence)', 'sum(net_revenue_pence)', 1)} AS gross_margin_pct,
{R('sum(net_revenue_pence)', 'count(DISTINCT order_id) * 100', 2)} AS avg_order_value_gbp FROM sold WHERE order_date >= {AS_OF} - 30 GROUP BY 1, 2, 3""")
cte("this_month", f"""SELECT store_id, store_name, store_region AS region, store_city AS city, {BIG('sum(net_revenue_pence) AS revenue')}, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS unique_customers
FROM sold WHERE order_year = 2001 AND order_month = 8 AND store_id IS NOT NULL GROUP BY 1, 2, 3, 4""")
cte("last_month", f"SELECT store_id, {BIG('sum(net_revenue_pence) AS revenue')} FROM sold WHERE order_date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' GROUP BY 1")
oracle("q2_store_mtd", f"""SELECT c.store_id, store_name, region, city, {GBP('c.revenue')} AS revenue_gbp, orders, unique_customers, {GBP('p.revenue')} AS revenue_gbp_prior,
{P('c.revenue - p.revenue', 'p.revenue', 1)} AS mom_growth_pct FROM this_month c LEFT JOIN last_month p USING (store_id)""")
oracle("q3_top_products", f"""SELECT product_id, product_name, category, subcategory, {BIG('sum(units_sold) AS units_sold')}, {GBP('sum(net_revenue_pence)')} AS revenue_gbp, {GBP('sum(gross_profit_pence)')} AS profit_gbp,
{P('sum(gross_profit_pence)', 'sum(net_revenue_pence)', 1)} AS margin_pct FROM sold WHERE order_date >= {AS_OF} - 28 AND product_id IS NOT NULL GROUP BY 1, 2, 3, 4
ORDER BY sum(net_revenue_pence) DESC, product_id LIMIT 10""")
oracle("q6_channel_attribution", f"""SELECT c.channel AS marketing_channel, count(DISTINCT campaign_id) AS active_campaigns, {BIG('sum(impressions) AS impressions', 'sum(clicks) AS clicks')},
{P('sum(clicks)', 'sum(impressions)', 2)} AS ctr_pct, {GBP('sum(spend_pence)')} AS spend_gbp, {GBP('sum(attributed_revenue_pence)')} AS attributed_revenue_gbp, {BIG('sum(attributed_orders) AS attributed_orders')},
{R('sum(attributed_revenue_pence)', 'sum(spend_pence)', 2)} AS roas, {R('sum(spend_pence)', 'sum(attributed_orders) * 100', 2)} AS cost_per_order_gbp
FROM raw_marketing m JOIN campaigns c USING (campaign_id) WHERE date >= DATE '2024-01-31' - 30 GROUP BY 1""")
oracle("q7_new_vs_returning", f"""SELECT order_year AS year, order_month AS month_num, order_month_name AS month_name,
count(DISTINCT CASE WHEN acquisition_date >= date_trunc('month', order_date) AND acquisition_date < date_trunc('month', order_date) + INTERVAL 1 MONTH THEN customer_id END) AS new_customers,
count(DISTINCT CASE WHEN acquisition_date < date_trunc('month', order_date) THEN customer_id END) AS returning_customers, count(DISTINCT customer_id) AS total_customers
FROM sold WHERE order_date >= {AS_OF} - INTERVAL 12 MONTH AND customer_id IS NOT NULL GROUP BY 1, 2, 3""")

# --- forecasting ----------------------------------------------------------------------------

cte("weekly", f"""
SELECT CAST(date_trunc('week', order_date) AS DATE) AS ds, category, {BIG('sum(units_sold) AS units_sold')}, {GBP('sum(net_revenue_pence)')} AS revenue
FROM raw_lines JOIN raw_orders USING (order_id) JOIN raw_products USING (product_id) WHERE NOT is_returned GROUP BY 1, 2""")
LEVEL = """SELECT category, avg(units_sold) AS level, max(ds) AS last_ds FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY ds DESC) AS rn FROM {}) WHERE rn <= 4 GROUP BY 1""".format
cte("level", LEVEL("weekly"))
WHOLE = "CAST(round_even(level * {}::DOUBLE, 0) AS BIGINT)".format
cte("moving_average", f"""
SELECT ds, category, units_sold AS yhat, units_sold AS yhat_lower, units_sold AS yhat_upper, false AS is_forecast FROM weekly UNION ALL
SELECT last_ds + CAST(7 * w AS INTEGER), category, {WHOLE('1.0')}, {WHOLE('0.8')}, {WHOLE('1.2')}, true FROM level, range(1, 13) t(w)""")
cte("split", """
SELECT ds, category, units_sold, revenue, CASE WHEN ds > last - 56 THEN 'test' ELSE 'train' END AS part
FROM (SELECT *, max(ds) OVER (PARTITION BY category) AS last, count(*) OVER (PARTITION BY category) AS n FROM weekly) WHERE n >= 8""")
cte("train_level", LEVEL("(SELECT * FROM split WHERE part = 'train')"))
cte("errors", f"""
SELECT category, {R('sum(e)', 'count(e) * 1000000', 4)} AS mape_pct FROM (
SELECT category, CASE WHEN units_sold <> 0 THEN (abs({WHOLE('1.0')} - units_sold) * 200000000 + units_sold) // (units_sold * 2) END AS e
FROM split LEFT JOIN (SELECT category, level, last_ds + CAST(7 * w AS INTEGER) AS ds FROM train_level, range(1, 9) t(w)) USING (category, ds) WHERE part = 'test') GROUP BY 1""")
oracle("fc_weekly_sales", "SELECT * FROM weekly")
oracle("fc_moving_average", "SELECT * FROM moving_average")
oracle("fc_backtest_split", "SELECT * FROM split")
oracle("fc_mape", "SELECT * FROM errors")
oracle("fc_accuracy", """SELECT category, mape_pct, coalesce(mape_pct <= 15, false) AS on_target, (SELECT count(*) FROM errors WHERE mape_pct <= 15) AS categories_on_target,
(SELECT count(*) FROM errors) AS categories FROM errors""")
cte("recent_units", f"""
SELECT category, product_id, {BIG('sum(units_sold) AS units')} FROM raw_lines JOIN raw_orders USING (order_id) JOIN raw_products USING (product_id)
JOIN level USING (category) WHERE NOT is_returned AND date_trunc('week', order_date) > last_ds - 28 GROUP BY 1, 2""")
cte("product_daily", f"""
SELECT product_id, r.category, last_ds + CAST(7 * w + d AS INTEGER) AS forecast_date, CAST(({WHOLE('1.0')} * units * 2000 + a * 7) // (a * 14) AS BIGINT) AS milli
FROM recent_units r JOIN (SELECT category, {BIG('sum(units) AS a')} FROM recent_units GROUP BY 1) USING (category) JOIN level l USING (category), range(1, 13) t(w), range(0, 7) u(d)""")
cte("holiday_effect", "SELECT DISTINCT full_date + unnest([0, 1]) AS d FROM cal WHERE is_uk_public_holiday")
cte("week_flags", """
SELECT ds, CAST(sum(h) AS BIGINT) AS h, CAST(sum(p) AS BIGINT) AS p FROM (
SELECT CAST(date_trunc('week', d) AS DATE) AS ds, 1 AS h, 0 AS p FROM holiday_effect
UNION ALL SELECT CAST(date_trunc('week', full_date) AS DATE), 0, 1 FROM cal WHERE is_promotional) GROUP BY 1""")
MICRO = "CAST(floor(({}) * 1000000 + 0.5::DOUBLE) AS BIGINT)".format


def seasonal(name: str, source: str, horizon: int, min_weeks: int) -> None:
    """Blocks of a least-squares model over a weekly table; `name` has the rows of the forecast."""
    cte(f"{name}_series", f"SELECT category, min(ds) AS first_ds, max(ds) AS last_ds, count(*) AS n FROM {source} GROUP BY 1 HAVING count(*) >= {min_weeks}")
    cte(f"{name}_rows", f"""
SELECT *, (ds - first_ds) / 365.25::DOUBLE AS years, CASE WHEN n >= 104 THEN 6 WHEN n >= 26 THEN 2 ELSE 0 END AS waves FROM (
SELECT category, ds, units_sold AS y, first_ds, n FROM {source} JOIN {name}_series USING (category) UNION ALL
SELECT category, last_ds + CAST(7 * w AS INTEGER), NULL, first_ds, n FROM {name}_series, range(1, {horizon + 1}) t(w))""")
    waves = [f"CASE WHEN waves >= {k} THEN {MICRO(f'{f}(years * (2 * pi()) * {k})')} ELSE 0 END" for k in range(1, 7) for f in ("sin", "cos")]
    terms = f"1000000, {MICRO('years')}, {', '.join(waves)}, coalesce(h, 0) * 1000000, coalesce(p, 0) * 1000000"
    cte(f"{name}_x", f"SELECT category, ds, y, n, waves, [{terms}]::BIGINT[] AS x FROM {name}_rows LEFT JOIN week_flags USING (ds)")
    cte(f"{name}_sums", f"""
SELECT category, i, j, CASE WHEN j = 17 THEN CAST(sum(x[i]::HUGEINT * y) AS DOUBLE) / 1000000 ELSE
  CAST(sum(x[i]::HUGEINT * x[j]) AS DOUBLE) / 1000000000000 + CASE WHEN i = j AND i > 1 THEN 0.001::DOUBLE ELSE 0 END END AS v
FROM {name}_x, range(1, 17) a(i), range(1, 18) b(j) WHERE y IS NOT NULL GROUP BY 1, 2, 3""")
    cte(f"{name}_m0", f"SELECT category, list(r ORDER BY i) AS m FROM (SELECT category, i, list(v ORDER BY j) AS r FROM {name}_sums GROUP BY 1, 2) GROUP BY 1")
    for k in range(1, 17):
        cte(f"{name}_m{k}", f"""
SELECT category, list_transform(m, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda v: v / r[{k}])
  ELSE list_transform(r, lambda v, j: v - r[{k}] / m[{k}][{k}] * m[{k}][j]) END) AS m FROM {name}_m{k - 1}""")
    cte(f"{name}_fit", f"""
SELECT category, ds, y, n, waves, list_sum(list_transform(range(1, 17), lambda i: x[i] * m[i][17])) / 1000000 AS fit
FROM {name}_x JOIN {name}_m16 USING (category)""")
    whole = "CAST(round_even(greatest({}, 0::DOUBLE), 0) AS BIGINT)".format
    cte(name, f"""
SELECT ds, category, {whole('fit')} AS yhat, {whole('fit - s')} AS yhat_lower, {whole('fit + s')} AS yhat_upper, y IS NULL AS is_forecast
FROM (SELECT *, sqrt(sum((y - fit) * (y - fit)) OVER (PARTITION BY category) / greatest(1, n - 4 - 2 * waves)) * 1.2815515655446004::DOUBLE AS s FROM {name}_fit)""")


cte("train_weeks", "SELECT ds, category, units_sold FROM split WHERE part = 'train'")
seasonal("seasonal", "weekly", 12, 8)
seasonal("seasonal_test", "train_weeks", 8, 1)
cte("seasonal_errors", f"""
SELECT category, {R('sum(e)', 'count(e) * 1000000', 4)} AS mape_pct FROM (
SELECT category, CASE WHEN units_sold <> 0 THEN (abs(yhat - units_sold) * 200000000 + units_sold) // (units_sold * 2) END AS e
FROM split LEFT JOIN (SELECT ds, category, yhat FROM seasonal_test WHERE is_forecast) USING (category, ds) WHERE part = 'test') GROUP BY 1""")
oracle("fc_seasonal", "SELECT * FROM seasonal")
oracle("fc_all", "SELECT ds, category, yhat, yhat_lower, yhat_upper, is_forecast, mape_pct FROM seasonal LEFT JOIN seasonal_errors USING (category)")
oracle("fc_fallback", """
SELECT *, 'seasonal' AS model FROM seasonal WHERE category IN (SELECT category FROM seasonal_errors WHERE mape_pct <= 20) UNION ALL
SELECT *, 'moving_average' FROM moving_average WHERE category NOT IN (SELECT category FROM seasonal_errors WHERE mape_pct <= 20)""")
oracle("fc_product_daily", "SELECT product_id, category, forecast_date, CAST(milli AS DOUBLE) / 1000::DOUBLE AS forecast_units FROM product_daily")
cte("demand", f"SELECT product_id, CAST(CAST(sum(milli) AS BIGINT) AS DOUBLE) / 1000::DOUBLE AS forecast_units_7d FROM product_daily WHERE forecast_date BETWEEN {AS_OF} AND {AS_OF} + 7 GROUP BY 1")
oracle("q5_stockout_risk", f"""SELECT product_id, product_name, category, store_name, s.region, stock_on_hand, reorder_point, reorder_quantity, stock_status, days_of_stock_remaining, forecast_units_7d
FROM stock JOIN dim_product USING (product_id) JOIN dim_store s USING (store_id) LEFT JOIN demand USING (product_id) WHERE snapshot_date = {AS_OF} - 1 AND stock_status IN ('RED', 'AMBER')""")
oracle("inv_stock_alerts", """SELECT product_id, product_name, category, supplier_id, store_id, store_name, stock_on_hand, reorder_point, reorder_quantity, days_of_stock_remaining, forecast_units_7d
FROM inventory_status LEFT JOIN demand USING (product_id) WHERE stock_status = 'RED'""")
oracle("inv_rag_status", f"SELECT snapshot_date, product_id, store_id, stock_status, {RAG('stock_on_hand <= 0')} AS zero_stock_status, days_of_stock_remaining FROM stock")
oracle("inv_turnover", f"""SELECT product_id, {BIG('sum(units_sold) AS units_sold')}, {R('sum(stock_on_hand)', 'count(*)', 2)} AS avg_stock,
{R('sum(units_sold) * count(*)', 'sum(stock_on_hand)', 4)} AS turnover_rate FROM raw_inventory GROUP BY product_id""")

# --- data tests -----------------------------------------------------------------------------

oracle("test_not_null", " UNION ALL ".join(
    f"SELECT 'stg_sales' AS table_name, 'not_null:{c}' AS test, count(*) FILTER ({c} IS NULL) AS failures FROM stg_sales"
    for c in ("sale_key", "order_id", "net_revenue_gbp", "units_sold", "is_returned", "campaign_key")))
oracle("test_unique", """SELECT 'stg_sales' AS table_name, 'unique:order_line_id' AS test, count(*) AS failures FROM (SELECT 1 FROM raw_lines GROUP BY order_line_id HAVING count(*) > 1)
UNION ALL SELECT 'stg_customers', 'unique:customer_id', count(*) FROM (SELECT 1 FROM raw_customers GROUP BY customer_id HAVING count(*) > 1)""")
oracle("test_accepted_values", """SELECT 'stg_customers' AS table_name, 'accepted_values:loyalty_tier' AS test, count(*) FILTER (loyalty_tier NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum')) AS failures FROM dim_customer
UNION ALL SELECT 'stg_stores', 'accepted_values:store_type', count(*) FILTER (store_type NOT IN ('Physical', 'App')) FROM raw_stores
UNION ALL SELECT 'stg_inventory', 'accepted_values:stock_status', count(*) FILTER (stock_status NOT IN ('RED', 'AMBER', 'GREEN')) FROM stock""")
oracle("test_revenue_positive", f"""SELECT sale_key, order_id, {GBP('net_revenue_pence - 200000')} AS net_revenue_gbp FROM fact_sales WHERE net_revenue_pence < 200000 AND NOT is_returned""")
oracle("test_rfm_coverage", "SELECT DISTINCT customer_id FROM customer_orders WHERE total_orders > 0 AND loyalty_tier = 'Gold'")
oracle("fn_utc", "SELECT touch_id, strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS utc FROM raw_touches")
oracle("pii_mask", "SELECT customer_id, left(email, 1) || '***@' || split_part(email, '@', 2) AS email_masked, 'SW' || left(substr(customer_id, 5), 1) AS postcode_district FROM raw_customers")

# --- dashboards -----------------------------------------------------------------------------

SUMS = "(SELECT " + ", ".join(
    f"{BIG(f'sum({PENCE(c)}) FILTER (order_date BETWEEN {first} - {s} AND {last} - {s}) AS {n}_{s}')}"
    for first, last in [("DATE '2001-07-01'", "DATE '2001-07-28'")] for n, c in (("revenue", "revenue_gbp"), ("profit", "gross_profit_gbp")) for s in (0, 7, 364)
) + ", " + ", ".join(
    BIG(f"sum(total_orders) FILTER (order_date BETWEEN DATE '2001-07-01' - {s} AND DATE '2001-07-28' - {s}) AS orders_{s}") for s in (0, 7)) + " FROM daily)"
oracle("dash_kpi_cards", f"""SELECT {GBP('revenue_0')} AS revenue_gbp, orders_0 AS total_orders, {R('revenue_0', 'orders_0 * 100', 2)} AS avg_order_value_gbp, {P('profit_0', 'revenue_0', 2)} AS gross_margin_pct,
{P('revenue_0 - revenue_7', 'revenue_7', 1)} AS revenue_vs_last_week_pct, {P('orders_0 - orders_7', 'orders_7', 1)} AS orders_vs_last_week_pct, {P('revenue_0 - revenue_364', 'revenue_364', 1)} AS revenue_yoy_pct FROM {SUMS}""")
oracle("dash_revenue_region", f"""SELECT store_region, {GBP('sum(net_revenue_pence)')} AS revenue_gbp, count(DISTINCT order_id) AS orders FROM enriched GROUP BY 1""")
oracle("dash_store_table", f"""SELECT store_id, store_name, {GBP('now')} AS revenue_gbp, orders, {R('now', 'orders * 100', 2)} AS aov_gbp, {P('profit', 'now', 2)} AS margin_pct, {P('now - before', 'before', 1)} AS wow_pct FROM (
SELECT store_id, store_name, {BIG(f'sum(net_revenue_pence) FILTER (order_date > {AS_OF} - 7) AS now', f'sum(gross_profit_pence) FILTER (order_date > {AS_OF} - 7) AS profit', f'sum(net_revenue_pence) FILTER (order_date <= {AS_OF} - 7) AS before')},
count(DISTINCT order_id) FILTER (order_date > {AS_OF} - 7) AS orders FROM enriched WHERE order_date > {AS_OF} - 14 AND order_date <= {AS_OF} AND store_id IS NOT NULL GROUP BY 1, 2)""")
cte("product_totals", f"SELECT product_id, product_name, category, {BIG('sum(net_revenue_pence) AS revenue')} FROM sold WHERE product_id IS NOT NULL GROUP BY 1, 2, 3")
oracle("dash_top_bottom", " UNION ALL ".join(
    f"(SELECT '{side}' AS side, row_number() OVER (ORDER BY revenue {way}, product_id) AS place, product_id, product_name, category, {GBP('revenue')} AS revenue_gbp FROM product_totals ORDER BY place LIMIT 10)"
    for side, way in (("top", "DESC"), ("bottom", "ASC"))))
COUNT = "count(*) FILTER (stock_status = '{}')".format
oracle("dash_stock_status", "SELECT category, " + ", ".join(f"{COUNT(s)} AS {s.lower()}_items" for s in model.STOCK_STATUSES) + ", count(*) AS items, "
       + ", ".join(f"{P(COUNT(s), 'count(*)', 1)} AS {s.lower()}_pct" for s in model.STOCK_STATUSES) + " FROM inventory_status GROUP BY 1")
oracle("dash_days_hist", "SELECT CAST(floor(days_of_stock_remaining / 5) * 5 AS BIGINT) AS days_from, count(*) AS items FROM inventory_status WHERE days_of_stock_remaining IS NOT NULL GROUP BY 1")
oracle("dash_critical_stock", "SELECT product_id, product_name, category, store_id, store_name, stock_on_hand, reorder_point, days_of_stock_remaining FROM inventory_status WHERE stock_status = 'RED'")
oracle("dash_lost_revenue", f"SELECT {COUNT('RED')} AS red_items, {COUNT('AMBER')} AS amber_items, count(*) AS items, {GBP('sum(' + PENCE('potential_lost_revenue_gbp') + ')')} AS potential_lost_revenue_gbp FROM inventory_status")
oracle("dash_campaign_scatter", f"""SELECT campaign_id, marketing_channel, {GBP('sum(spend)')} AS spend_gbp, {GBP('sum(revenue)')} AS revenue_gbp, {BIG('sum(attributed_orders) AS orders')},
{R('sum(revenue)', 'sum(spend)', 2)} AS roas, {P('sum(total_clicks)', 'sum(total_impressions)', 2)} AS ctr_pct FROM marketing_months GROUP BY 1, 2""")
HEADLINE = (f"SELECT {GBP('sum(net_revenue_pence)')} AS revenue_gbp, count(DISTINCT order_id) AS total_orders, {BIG('sum(units_sold) AS total_units')}, "
            f"{R('sum(net_revenue_pence)', 'count(DISTINCT order_id) * 100', 2)} AS avg_order_value_gbp, {P('sum(gross_profit_pence)', 'sum(net_revenue_pence)', 2)} AS gross_margin_pct FROM enriched WHERE ")
oracle("dash_filtered_kpis", HEADLINE + "order_date BETWEEN DATE '2001-01-01' AND DATE '2001-07-31' AND category IN ('Large', 'Small') AND channel IN ('Online', 'In-Store')")
oracle("dash_default_kpis", HEADLINE + f"order_date BETWEEN DATE '2001-08-01' AND {AS_OF}")
oracle("dash_store_scope", f"SELECT order_date, {BIG('sum(units_sold) AS units')}, {GBP('sum(net_revenue_pence)')} AS revenue_gbp FROM enriched WHERE store_id = 'STR-14' GROUP BY 1")
oracle("store_wtd_mtd", f"""SELECT store_id, order_date, {GBP('revenue')} AS revenue_gbp, {GBP("sum(revenue) OVER (PARTITION BY store_id, date_trunc('week', order_date) ORDER BY order_date)")} AS wtd_gbp,
{GBP("sum(revenue) OVER (PARTITION BY store_id, date_trunc('month', order_date) ORDER BY order_date)")} AS mtd_gbp FROM (
SELECT store_id, order_date, {BIG('sum(net_revenue_pence) AS revenue')} FROM enriched WHERE store_id IS NOT NULL AND order_date IS NOT NULL GROUP BY 1, 2)""")

# --- attribution and streaming --------------------------------------------------------------

WEIGHTS = "[" + ", ".join(str(round(WEIGHT_UNIT * 0.5 ** (d / HALF_LIFE_DAYS))) for d in range(WINDOW_DAYS + 1)) + "]"
K = len(model.TOUCH_CHANNELS)
cte("paths", f"""
SELECT c.conversion_id, c.customer_id, c.revenue_pence, """ + ", ".join(
    [f"count(*) FILTER (t.channel = '{ch}') AS {n}" for n, ch in zip(N, model.TOUCH_CHANNELS)]
    + [f"CAST(coalesce(sum({WEIGHTS}[1 + (CAST(c.ts AS DATE) - CAST(t.ts AS DATE))]) FILTER (t.channel = '{ch}'), 0) AS BIGINT) AS {w}" for w, ch in zip(W, model.TOUCH_CHANNELS)]
) + f""", arg_min(t.channel, (t.ts, t.touch_id)) AS first_channel, arg_max(t.channel, (t.ts, t.touch_id)) AS last_channel
FROM raw_conversions c LEFT JOIN raw_touches t ON t.customer_id = c.customer_id AND t.ts <= c.ts AND CAST(t.ts AS DATE) >= CAST(c.ts AS DATE) - {WINDOW_DAYS} GROUP BY 1, 2, 3""")
oracle("attr_paths", "SELECT conversion_id, customer_id, revenue_pence, " + " + ".join(N[:K]) + " AS touches, " + ", ".join(
    f"{n} AS {ch.lower().replace(' ', '_')}_touches" for n, ch in zip(N, model.TOUCH_CHANNELS)) + ", 0::BIGINT AS other_touches, first_channel, last_channel FROM paths")
PAIRS = [(i, j) for i in range(K) for j in range(i + 1, K)]
GROUPS = [(f"{i}", f"s{i}") for i in range(K)] + [(f"{i}_{j}", f"s{i} AND s{j}") for i, j in PAIRS]
cte("channel_flags", "SELECT customer_id, " + ", ".join(f"bool_or(channel = '{ch}') AS s{i}" for i, ch in enumerate(model.TOUCH_CHANNELS))
    + ", customer_id IN (SELECT customer_id FROM raw_conversions) AS bought FROM raw_touches GROUP BY customer_id")
cte("channel_rates", "SELECT " + ", ".join(
    f"count(*) FILTER ({cond}) AS a{g}, coalesce(count(*) FILTER ({cond} AND bought) * {CREDIT_UNIT} // nullif(count(*) FILTER ({cond}), 0), 0) AS p{g}" for g, cond in GROUPS) + " FROM channel_flags")


def effect(i: int) -> str:
    mixed = " + ".join(
        f"CASE WHEN a{min(i, j)}_{max(i, j)} > 0 THEN p{min(i, j)}_{max(i, j)} - p{i} - p{j} ELSE 0 END" for j in range(K) if j != i)
    # // rounds toward zero, like Spark's div
    return f"greatest(p{i} + CAST(trunc(({mixed}) / {2 * (K - 1)}::DOUBLE) AS BIGINT), 0)"


cte("effects", "SELECT " + ", ".join(f"{effect(i)} AS e{i}" for i in range(K)) + " FROM channel_rates")
EFFECT_WEIGHTS = [f"CASE WHEN {' + '.join(f'(CASE WHEN {m} > 0 THEN e{k} ELSE 0 END)' for k, m in enumerate(N[:K]))} > 0 THEN CASE WHEN {n} > 0 THEN e{i} ELSE 0 END ELSE {n} END" for i, n in enumerate(N[:K])]


def attribution(weights: list[str], source: str = "paths") -> str:
    xs = ", ".join(f"CAST({w} AS HUGEINT) AS x{i}" for i, w in enumerate(weights))
    total = " + ".join(f"x{i}" for i in range(K))
    direct = model.TOUCH_CHANNELS.index("Direct")
    ys = ", ".join(f"CASE WHEN {total} = 0 THEN {1 if i == direct else 0} ELSE x{i} END AS y{i}" for i in range(K))
    all_y = " + ".join(f"y{i}" for i in range(K))

    def part(i: int, amount: str) -> str:
        floors = [f"({amount} * {CREDIT_UNIT} * y{j} // ({all_y}))" for j in range(K)]
        earlier = " AND ".join([f"y{j} = 0" for j in range(i)] + [f"y{i} > 0"])
        return f"{floors[i]} + CASE WHEN {earlier} THEN {amount} * {CREDIT_UNIT} - ({' + '.join(floors)}) ELSE 0 END"

    rows = " UNION ALL ".join(
        f"SELECT '{ch}' AS channel, sum({part(i, 'revenue_pence')}) AS revenue, sum({part(i, '1')}) AS orders FROM ws" for i, ch in enumerate(model.TOUCH_CHANNELS))
    return f"""SELECT channel, {R('revenue', str(CREDIT_UNIT * 100), 2)} AS attributed_revenue_gbp, {R('orders', str(CREDIT_UNIT), 4)} AS attributed_orders, {GBP('coalesce(spend, 0)')} AS spend_gbp,
{R(f'spend * {CREDIT_UNIT}', 'orders * 100', 2)} AS cost_per_order_gbp, {R('revenue', f'spend * {CREDIT_UNIT}', 2)} AS roas
FROM (WITH ws AS (SELECT revenue_pence, {ys} FROM (SELECT revenue_pence, {xs} FROM {source})) {rows}) a
LEFT JOIN (SELECT channel, CAST(sum(spend_pence) AS HUGEINT) AS spend FROM raw_marketing GROUP BY 1) USING (channel)"""


CLICK = [[f"coalesce(CAST({c} = '{ch}' AS INTEGER), 0)" for ch in model.TOUCH_CHANNELS] for c in ("last_channel", "first_channel")]
oracle("attr_last_click", attribution(CLICK[0]))
oracle("attr_first_click", attribution(CLICK[1]))
oracle("attr_linear", attribution(N[:K]))
oracle("attr_time_decay", attribution(W[:K]))
oracle("attr_data_driven", attribution(EFFECT_WEIGHTS, "paths, effects"))
oracle("attr_compare", f"""SELECT channel, l.attributed_revenue_gbp AS last_click_gbp, d.attributed_revenue_gbp AS data_driven_gbp
FROM ({attribution(CLICK[0])}) l FULL JOIN ({attribution(EFFECT_WEIGHTS, 'paths, effects')}) d USING (channel)""")
oracle("stream_hourly_sales", f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start, count(*) AS orders, {GBP(f"sum({PENCE('value')})")} AS revenue_gbp
FROM events WHERE event_type = 'purchase' GROUP BY 1""")
cte("newest_stock", """
SELECT l_partkey, l_suppkey, arg_max(stock, (l_shipdate, stock)) AS stock_on_hand, 10 + l_partkey % 31 AS reorder_point
FROM (SELECT *, (l_partkey * 7 + l_suppkey * 13 + l_linenumber * 29) % 201 AS stock FROM lineitem) GROUP BY l_partkey, l_suppkey""")
cte("shipped", """
SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS TIMESTAMP) AS line_ts, CAST(l_quantity AS BIGINT) AS units,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS pence FROM lineitem""")
cte("ordered", "SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_ts FROM orders")
oracle("stream_store_sales", f"""
SELECT strftime(date_trunc('hour', order_ts), '%Y-%m-%d %H:%M:%S') AS hour_start, 'STR-' || l.l_suppkey AS store_id, {RAG('stock_on_hand <= reorder_point')} AS stock_status,
  count(*) AS lines, {BIG('sum(units) AS units')}, {GBP('sum(pence)')} AS revenue_gbp
FROM shipped l JOIN ordered ON l_orderkey = o_orderkey AND line_ts BETWEEN order_ts AND order_ts + INTERVAL 130 DAY
JOIN newest_stock USING (l_partkey, l_suppkey) GROUP BY 1, 2, 3""")
JSON_LINE = "'{\"order_id\":\"' || order_id || '\",\"customer_id\":\"' || customer_id || '\",\"order_total_pence\":' || order_total_pence || ',\"channel\":\"' || channel || '\"}'"
oracle("src_landing_stream", f"""
SELECT channel, count(*) AS n, {BIG('sum(order_total_pence) AS total_pence')} FROM raw_orders WHERE length({JSON_LINE}) % 7 <> 0 GROUP BY 1
UNION ALL SELECT 'quarantined', count(*), NULL FROM raw_orders WHERE length({JSON_LINE}) % 7 = 0""")
oracle("dash_entitled_sales", f"""
SELECT user_name, store_id, {GBP('sum(net_revenue_pence)')} AS revenue_gbp FROM raw_lines JOIN (
SELECT 'north' AS user_name, store_id FROM raw_stores WHERE CAST(substr(store_id, 5) AS BIGINT) % 3 = 0 UNION ALL
SELECT 'kiosk', store_id FROM raw_stores WHERE store_id IN ('STR-1', 'STR-2')) USING (store_id) GROUP BY 1, 2""")
oracle("fc_product_units", f"""
SELECT product_id, category, forecast_date, CAST(whole + CASE WHEN row_number() OVER (PARTITION BY category, forecast_date ORDER BY part DESC, product_id)
  <= day_units - sum(whole) OVER (PARTITION BY category, forecast_date) THEN 1 ELSE 0 END AS BIGINT) AS forecast_units FROM (
SELECT product_id, r.category, forecast_date, day_units, day_units * units // a AS whole, day_units * units % a AS part
FROM recent_units r JOIN (SELECT category, {BIG('sum(units) AS a')} FROM recent_units GROUP BY 1) USING (category) JOIN (
SELECT category, last_ds + CAST(7 * w + k AS INTEGER) AS forecast_date, y * (k + 1) // 7 - y * k // 7 AS day_units
FROM (SELECT category, last_ds, {WHOLE('1.0')} AS y FROM level), range(1, 13) t(w), range(0, 7) u(k)) USING (category))""")

ORACLES = {name: sql(statement) for name, statement in ORACLES.items()}
