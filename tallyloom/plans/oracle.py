"""The registered queries again, as SQL for DuckDB, for cross-checking results.

Written independently of the Spark code: plain SQL with ordinary windows, joins
and percentile functions. Shared steps are common table expressions, and each
query pulls in the ones it names. Output columns are cast to text, bigint,
double or boolean.
"""

from __future__ import annotations

import math
import re
from statistics import NormalDist

from tallyloom.config import (
    FEED_CONFIG as CFG, KPI_CHOICES, RECENCY_BUCKETS, SEGMENT_BANDS, SEGMENT_STRATEGY,
)
from tallyloom.operators.checks import CLEAN_CHECKS, COVERAGE_MESSAGES, RAW_CHECKS


def div(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


def rnd(x: str, digits: int) -> str:
    return f"round(CAST({x} AS DECIMAL(38,8)), {digits})"


def rdiv(n: str, d: str, digits: int) -> str:
    return rnd(div(n, d), digits)


def trim(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(rows, columns: str) -> str:
    body = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else _quoted(v) for v in row) + ")" for row in rows
    )
    return f"(VALUES {body}) AS t({columns})"


def _when(value: str, bands, default: str) -> str:
    tests = " ".join(f"WHEN {value} >= {lo} AND {value} < {hi} THEN {text}" for lo, hi, text in bands)
    return f"CASE {tests} ELSE {default} END"


_O, _P = "o_totalprice", "l_extendedprice"
_NET = "round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)"
_UNIT = "CAST(round(CAST(CAST(l_extendedprice AS DOUBLE) / l_quantity AS DECIMAL(38,8)), 2) AS DECIMAL(12,2))"
_QTY = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"
_LO, _HI = CFG.cents_band

STEPS: dict[str, str] = {}

STEPS["k_raw_orders"] = f"""
SELECT
  {_when(_O, [(0, 3000, "''"), (3000, 4000, "'   '"), (4000, 6000, "NULL"), (25000, 30000, "'  ' || o_orderkey || chr(9)")], "CAST(o_orderkey AS VARCHAR)")} AS "OrderID",
  {_when(_O, [(6000, 9000, "NULL"), (9000, 10000, "' '"), (30000, 35000, "o_custkey || ' '")], "CAST(o_custkey AS VARCHAR)")} AS "CustomerID",
  {_when(_O, [(10000, 13000, "strftime(o_orderdate, '%d.%m.%Y')"), (13000, 15000, "strftime(o_orderdate, '%Y')"), (15000, 18000, "'2027-01-01'"), (18000, 20000, "'1970-01-01'"), (20000, 22000, "''"), (22000, 24000, "NULL"), (24000, 25000, "strftime(o_orderdate, '%Y-%-m-%-d')")], "strftime(o_orderdate, '%Y-%m-%d')")} AS "OrderDate",
  {_when(_O, [(35000, 38000, "'1.5'"), (38000, 41000, "'abc'"), (41000, 44000, "' '"), (44000, 47000, "NULL")], "CAST(CAST((CAST(floor(o_totalprice) AS BIGINT) % 56) / 100.0 AS DECIMAL(4,2)) AS VARCHAR)")} AS "OrderDiscountPct",
  {_when(_O, [(50000, 55000, "'0'"), (55000, 60000, "'two'"), (60000, 65000, "''")], "left(o_orderpriority, 1)")} AS "BasketItemCount",
  strftime(o_orderdate, '%Y%m') AS source_month
FROM orders"""

STEPS["k_raw_items"] = f"""
SELECT
  {_when(_P, [(10000, 11000, "' ' || l_orderkey"), (12000, 12500, "NULL"), (12500, 13000, "''")], "CAST(l_orderkey AS VARCHAR)")} AS "OrderID",
  CAST(l_linenumber AS VARCHAR) AS "LineNumber",
  {_when(_P, [(9000, 10000, "l_partkey || chr(9) || ' '"), (11000, 11500, "'  '"), (11500, 12000, "NULL"), (13000, 14000, "'X' || l_partkey")], "CAST(l_partkey AS VARCHAR)")} AS "ProductID",
  {_when(_P, [(6000, 6500, "'0'"), (6500, 7000, "'-1'"), (7000, 7500, _QTY + " || '.0'"), (7500, 7800, "''"), (7800, 8000, "NULL")], _QTY)} AS "Quantity",
  {_when(_P, [(8000, 8400, "'-1.50'"), (8400, 8600, "'n/a'"), (8600, 8800, "''"), (8800, 9000, "NULL")], f"CAST({_UNIT} AS VARCHAR)")} AS "UnitPrice",
  {_when(_P, [(1000, 2000, "CAST(-net AS VARCHAR)"), (2000, 3000, "'0'"), (3000, 4000, "''"), (4000, 5000, "NULL"), (5000, 6000, "'12,50'"), (20000, 25000, "CAST(CAST(net * 100 AS BIGINT) AS VARCHAR)"), (14000, 14500, "CAST(CAST(net * 100 AS BIGINT) AS VARCHAR)")], "CAST(net AS VARCHAR)")} AS "LineNetAmount",
  strftime(l_shipdate, '%Y%m') AS source_month
FROM (SELECT *, CAST({_NET} AS DECIMAL(14,2)) AS net FROM lineitem)"""

STEPS["k_customers"] = f"""
SELECT NULLIF({trim(_when("c_acctbal", [(-1000, -960, "NULL"), (-960, -920, "' '")], "CAST(c_custkey AS VARCHAR)"))}, '') AS customer_id,
  DATE '1994-01-01' + CAST(CAST(trunc(abs(c_acctbal)) AS BIGINT) % 365 AS INTEGER) AS signup_date,
  c_mktsegment AS customer_archetype,
  split_part(c_name, '#', 1) AS first_name,
  CASE WHEN c_acctbal >= 0 AND c_acctbal < 200 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
  split_part(c_name, '#', 1) || CASE WHEN c_acctbal >= 0 AND c_acctbal < 200 THEN '' ELSE ' ' || split_part(c_name, '#', 2) END AS full_name,
  lower(replace(c_name, '#', '.')) || '@example.org' AS email,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE '+00 ' || c_custkey END AS phone,
  CASE WHEN c_acctbal >= 0 AND c_acctbal < 50 THEN NULL ELSE r_name END AS country,
  n_name AS state, c_mktsegment AS city, n_name || ', ' || c_custkey AS address
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""

STEPS["k_products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS product_category,
  p_brand AS brand, CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price,
  CAST(round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6, 2) AS DECIMAL(18,4)) AS unit_cost, 0.4 AS margin_pct
FROM part"""

_WINDOW = f"source_month BETWEEN '{CFG.start_month}' AND '{CFG.end_month}'"
_DATE = r"CASE WHEN regexp_matches({0}, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}$') THEN TRY_CAST({0} AS DATE) END"
_INT = r"CASE WHEN regexp_matches({0}, '^[+-]?\d+$') THEN TRY_CAST({0} AS BIGINT) END"
_NUM = r"CASE WHEN regexp_matches({0}, '^[+-]?\d*\.?\d+$') THEN TRY_CAST({0} AS DECIMAL(38,9)) END"

STEPS["k_orders_in"] = f"""
SELECT *, {_DATE.format('td')} AS day, {_NUM.format('tp')} AS pct, {_INT.format('tb')} AS basket
FROM (SELECT md5(CAST(to_json({{'source_month': source_month, 'OrderID': "OrderID", 'CustomerID': "CustomerID", 'OrderDate': "OrderDate", 'OrderDiscountPct': "OrderDiscountPct", 'BasketItemCount': "BasketItemCount"}}) AS VARCHAR)) AS row_id,
  "OrderID" AS ro, "CustomerID" AS rc, "OrderDate" AS rd, "OrderDiscountPct" AS rp, "BasketItemCount" AS rb,
  {trim('"OrderID"')} AS t_o, {trim('"CustomerID"')} AS tc, {trim('"OrderDate"')} AS td,
  {trim('"OrderDiscountPct"')} AS tp, {trim('"BasketItemCount"')} AS tb, source_month
  FROM k_raw_orders WHERE {_WINDOW})"""

STEPS["k_items_in"] = f"""
SELECT *, {_INT.format('tq')} AS qty, {_NUM.format('tu')} AS price, {_NUM.format('ta')} AS amount
FROM (SELECT md5(CAST(to_json({{'source_month': source_month, 'OrderID': "OrderID", 'LineNumber': "LineNumber", 'ProductID': "ProductID", 'Quantity': "Quantity", 'UnitPrice': "UnitPrice", 'LineNetAmount': "LineNetAmount"}}) AS VARCHAR)) AS row_id,
  "OrderID" AS ro, "ProductID" AS rp, "Quantity" AS rq, "UnitPrice" AS ru, "LineNetAmount" AS ra,
  {trim('"OrderID"')} AS t_o, {trim('"ProductID"')} AS tp, {trim('"Quantity"')} AS tq,
  {trim('"UnitPrice"')} AS tu, {trim('"LineNetAmount"')} AS ta, source_month
  FROM k_raw_items WHERE {_WINDOW})"""


def _flag_text(rules: list[tuple[str, str]]) -> str:
    parts = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules)
    return f"concat_ws('|', {parts})"


_ORDER_FLAGS = _flag_text([
    ("BLANK_ORDER_ID", "t_o = ''"), ("BLANK_CUSTOMER_ID", "tc = ''"), ("BLANK_DATE", "td = ''"),
    ("TRIMMED_KEYS", "ro <> t_o OR rc <> tc"), ("NULL_ORDER_ID", "ro IS NULL"),
    ("NULL_CUSTOMER_ID", "rc IS NULL"), ("NULL_DATE", "rd IS NULL"),
    ("UNPARSEABLE_DATE", "td <> '' AND day IS NULL"), ("FUTURE_DATE", f"day > DATE '{CFG.as_of_date}'"),
    ("TOO_EARLY_DATE", f"day < DATE '{CFG.min_order_date}'"), ("BLANK_DISCOUNT_PCT", "tp = ''"),
    ("UNPARSEABLE_DISCOUNT_PCT", "tp <> '' AND pct IS NULL"), ("DISCOUNT_PCT_OUT_OF_RANGE", "pct < 0 OR pct > 1"),
    ("BLANK_BASKET_COUNT", "tb = ''"), ("UNPARSEABLE_BASKET_COUNT", "tb <> '' AND basket IS NULL"),
    ("NON_POSITIVE_BASKET_COUNT", "basket <= 0"),
])
_CENTS = (
    f"((amount > {CFG.cents_guard} AND amount / 100 BETWEEN {_LO} AND {_HI}) OR "
    f"(qty > 0 AND price > 0 AND amount >= CAST({CFG.cents_list_multiple} AS HUGEINT) * qty * CAST(price AS DECIMAL(18,2))))"
)
_ITEM_FLAGS = _flag_text([
    ("BLANK_ORDER_ID", "t_o = ''"), ("BLANK_PRODUCT_ID", "tp = ''"), ("TRIMMED_KEYS", "ro <> t_o OR rp <> tp"),
    ("NULL_ORDER_ID", "ro IS NULL"), ("NULL_PRODUCT_ID", "rp IS NULL"), ("NULL_QUANTITY", "rq IS NULL"),
    ("BLANK_QUANTITY", "tq = ''"), ("UNPARSEABLE_QUANTITY", "tq <> '' AND qty IS NULL"),
    ("NON_POSITIVE_QUANTITY", "qty <= 0"), ("NULL_UNIT_PRICE", "ru IS NULL"), ("BLANK_UNIT_PRICE", "tu = ''"),
    ("UNPARSEABLE_UNIT_PRICE", "tu <> '' AND price IS NULL"), ("NON_POSITIVE_UNIT_PRICE", "price <= 0"),
    ("NULL_AMOUNT", "ra IS NULL"), ("BLANK_AMOUNT", "ta = ''"), ("UNPARSEABLE_AMOUNT", "ta <> '' AND amount IS NULL"),
    ("NEGATIVE_AMOUNT", "amount < 0"), ("ZERO_AMOUNT", "amount = 0"), ("CENTS_CONVERTED", _CENTS),
])

STEPS["k_orders_clean"] = f"""
SELECT row_id, source_month, ro AS raw_order_id, rc AS raw_customer_id, rd AS raw_order_date,
  rp AS raw_order_discount_pct, rb AS raw_basket_item_count, NULLIF(t_o, '') AS order_id, NULLIF(tc, '') AS customer_id,
  CASE WHEN day BETWEEN DATE '{CFG.min_order_date}' AND DATE '{CFG.as_of_date}' THEN day END AS order_date,
  CASE WHEN pct BETWEEN 0 AND 1 THEN pct END AS order_discount_pct,
  CASE WHEN basket > 0 THEN basket END AS basket_item_count, {_ORDER_FLAGS} AS cleaning_flags
FROM k_orders_in"""

STEPS["k_items_clean"] = f"""
SELECT row_id, source_month, ro AS raw_order_id, rp AS raw_product_id, rq AS raw_quantity, ru AS raw_unit_price,
  ra AS raw_line_amount, NULLIF(t_o, '') AS order_id, NULLIF(tp, '') AS product_id,
  CASE WHEN qty > 0 THEN qty END AS quantity,
  CASE WHEN price > 0 THEN CAST(round(price, 2) AS DECIMAL(18,2)) END AS unit_price,
  CASE WHEN amount > 0 THEN CAST(round(CASE WHEN {_CENTS} THEN amount * 0.01 ELSE amount END, 2) AS DECIMAL(18,2)) END AS line_net_amount,
  {_ITEM_FLAGS} AS cleaning_flags
FROM k_items_in"""

STEPS["k_orders"] = """
SELECT order_id, customer_id, order_date, order_discount_pct, basket_item_count, source_month, cleaning_flags
FROM k_orders_clean WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY source_month DESC, row_id) = 1"""

STEPS["k_items"] = """
SELECT order_id, product_id, quantity, unit_price, line_net_amount, source_month, cleaning_flags
FROM k_items_clean
WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL AND line_net_amount IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY order_id, product_id ORDER BY source_month DESC, row_id) = 1"""

STEPS["k_values"] = """
SELECT o.order_id, o.customer_id, o.order_date, sum(i.line_net_amount) AS order_value
FROM k_orders o JOIN k_items i USING (order_id) GROUP BY ALL"""

# One row per order from its lines: the sums first, the best line by rank, then the dimensions.
STEPS["k_order_lines"] = """
SELECT order_id, product_id, quantity, line_net_amount, quantity * unit_cost AS cost, product_category, brand,
  row_number() OVER (PARTITION BY order_id ORDER BY line_net_amount DESC, product_id) AS place
FROM k_items JOIN k_products USING (product_id)"""
STEPS["k_curated"] = f"""
WITH sums AS (
  SELECT order_id, sum(line_net_amount) AS value, sum(cost) AS cost, sum(quantity) AS units, count(DISTINCT product_id) AS products
  FROM k_order_lines GROUP BY order_id
), lead AS (
  SELECT order_id, product_category, brand FROM k_order_lines WHERE place = 1
)
SELECT order_id, customer_id, order_date, country, state, city, order_discount_pct, basket_item_count, value AS order_value,
  round(cost, 2) AS order_cost, round(value - cost, 2) AS order_profit, {rdiv('value - cost', 'value', 4)} AS order_margin_pct,
  units AS total_units, products AS distinct_products, product_category AS dominant_category, brand AS dominant_brand, source_month
FROM sums JOIN lead USING (order_id) JOIN k_orders USING (order_id) LEFT JOIN k_customers USING (customer_id)"""

# One row per customer: the totals of the orders, and the place of the latest order.
STEPS["k_rfm"] = f"""
WITH latest AS (
  SELECT customer_id, country, state, city FROM k_curated
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1
), totals AS (
  SELECT customer_id, max(order_date) AS seen, count(*) AS orders, sum(order_value) AS spent, sum(order_profit) AS gained, sum(total_units) AS units, sum(distinct_products) AS kinds
  FROM k_curated GROUP BY customer_id
)
SELECT t.customer_id, upto AS data_as_of_date, seen AS last_order_date, upto - seen AS recency_days, orders AS frequency_orders, spent AS monetary_value,
  gained AS total_profit, {rdiv('gained', 'spent', 4)} AS avg_margin_pct, {rdiv('spent', 'orders', 2)} AS avg_order_value, units AS total_units,
  {rdiv('kinds', 'orders', 1)} AS avg_products_per_order, country AS primary_country, state AS primary_state, city AS primary_city
FROM totals t JOIN latest l ON t.customer_id IS NOT DISTINCT FROM l.customer_id, (SELECT max(order_date) AS upto FROM k_curated)"""

_BAND = lambda at: "CASE " + " ".join(
    f"WHEN r_score + f_score + m_score >= {b[0]} THEN {_quoted(b[at])}" for b in SEGMENT_BANDS
) + " END"

STEPS["k_segments"] = f"""
SELECT *, DATE '{CFG.as_of_date}' AS snapshot_date, format('R{{:02d}}F{{:02d}}M{{:02d}}', r_score, f_score, m_score) AS rfm_cell,
  r_score + f_score + m_score AS rfm_total_score, {_BAND(1)} AS rfm_segment, {_BAND(2)} AS recommended_action
FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS r_score,
  ntile(5) OVER (ORDER BY frequency_orders, customer_id) AS f_score,
  ntile(5) OVER (ORDER BY monetary_value, customer_id) AS m_score FROM k_rfm)"""

STEPS["k_dim"] = """
SELECT c.*, g.data_as_of_date AS analysis_date, g.last_order_date, g.recency_days, g.frequency_orders AS order_count,
  g.monetary_value AS total_spend, g.total_profit, g.avg_margin_pct AS margin_pct, g.avg_order_value, g.total_units,
  g.avg_products_per_order, g.r_score, g.f_score, g.m_score, g.rfm_cell, g.rfm_total_score AS health_score,
  g.rfm_segment AS segment, g.recommended_action AS action
FROM k_customers c LEFT JOIN k_segments g ON g.customer_id = c.customer_id"""

STEPS["k_lines"] = f"""
SELECT i.order_id, i.product_id, s.customer_id, s.order_date, i.quantity, i.line_net_amount,
  round(i.line_net_amount - i.quantity * p.unit_cost, 2) AS line_profit,
  {rdiv('i.line_net_amount - i.quantity * p.unit_cost', 'i.line_net_amount', 4)} AS line_margin_pct,
  p.product_category, p.brand
FROM k_items i JOIN k_curated s ON s.order_id = i.order_id JOIN k_products p ON p.product_id = i.product_id"""

STEPS["k_full"] = """
SELECT s.*, d.segment, d.country AS d_country, d.state AS d_state, d.city AS d_city, d.r_score, d.f_score, d.m_score
FROM k_curated s LEFT JOIN k_dim d ON d.customer_id = s.customer_id"""

STEPS["k_cutoff"] = """
SELECT CASE WHEN m = last_day(m) THEN date_trunc('month', m) ELSE date_trunc('month', m) - INTERVAL 1 MONTH END::DATE AS cutoff_month
FROM (SELECT max(order_date) AS m FROM k_curated)"""

STEPS["k_closed"] = "SELECT s.* FROM k_curated s, k_cutoff WHERE date_trunc('month', order_date) <= cutoff_month"

STEPS["k_first"] = "SELECT customer_id, date_trunc('month', min(order_date))::DATE AS cohort_month FROM k_curated GROUP BY 1"

STEPS["k_retention"] = f"""
SELECT cohort_month, mo AS months_since_acquisition, n AS active_customers, size AS cohort_customers, {div('n', 'size')} AS retention_rate
FROM (SELECT cohort_month, date_diff('month', cohort_month, date_trunc('month', order_date)::DATE) AS mo, count(DISTINCT customer_id) AS n
  FROM k_curated JOIN k_first USING (customer_id) GROUP BY 1, 2)
JOIN (SELECT cohort_month, count(*) AS size FROM k_first GROUP BY 1) USING (cohort_month)"""

STEPS["k_newret"] = """
SELECT date_trunc('month', order_date)::DATE AS revenue_month,
  CASE WHEN date_trunc('month', order_date) = cohort_month THEN 'New' ELSE 'Returning' END AS customer_type,
  sum(order_value) AS revenue, count(DISTINCT customer_id) AS active_customers
FROM k_curated JOIN k_first USING (customer_id) GROUP BY 1, 2"""

STEPS["k_days"] = f"""
SELECT d::DATE AS date FROM range(DATE '{CFG.start_year}-01-01', last_day(DATE '{CFG.as_of_date}') + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)"""

STEPS["k_strategy"] = "SELECT * FROM " + _values(
    SEGMENT_STRATEGY, "segment, email_cadence, loyalty_tier, discount_approach, budget_allocation, sort_order"
)
STEPS["k_playbook"] = r"""
SELECT segment, sort_order, CAST(regexp_extract(discount_approach, '(\d+)%', 1) AS INTEGER) / 100.0 AS discount_rate,
  budget_allocation, CAST(regexp_extract(budget_allocation, '(\d+)%', 1) AS INTEGER) AS budget_share_pct
FROM k_strategy WHERE discount_approach LIKE 'Win-back%'"""

STEPS["k_margins"] = f"""
SELECT g.rfm_segment AS segment, count(*) AS orders, count(DISTINCT s.customer_id) AS customers, sum(s.order_value) AS revenue,
  sum(s.order_cost) AS cost, sum(s.order_profit) AS profit, {div('sum(s.order_profit)', 'sum(s.order_value)')} AS gross_margin,
  {div('sum(s.order_discount_pct)', 'count(s.order_discount_pct)')} AS mean_pct
FROM k_curated s JOIN k_segments g ON g.customer_id = s.customer_id GROUP BY 1"""

STEPS["k_focus"] = f"""
SELECT *, {div('revenue', 'orders')} AS aov, {rnd('mean_pct', 4)} AS mean4, gross_margin - CAST(discount_rate AS DOUBLE) AS contribution
FROM k_margins JOIN k_playbook USING (segment)"""

STEPS["k_prod"] = f"""
SELECT p.*, a.orders_containing, a.units_sold, a.total_revenue, a.units_sold * p.unit_cost AS cost,
  rank() OVER (ORDER BY a.total_revenue DESC) AS revenue_rank, rank() OVER (ORDER BY a.units_sold DESC) AS units_rank,
  rank() OVER (PARTITION BY p.product_category ORDER BY a.total_revenue DESC) AS rank_within_category
FROM k_products p JOIN (SELECT product_id, count(DISTINCT order_id) AS orders_containing, sum(quantity) AS units_sold,
  sum(line_net_amount) AS total_revenue FROM k_items GROUP BY 1) a USING (product_id)"""

STEPS["k_brandm"] = f"""
SELECT brand, sum(line_net_amount) AS line_revenue, sum(line_profit) AS line_profit,
  {div('sum(line_profit)', 'sum(line_net_amount)')} AS line_margin_pct FROM k_lines GROUP BY 1"""

STEPS["k_decile"] = """
SELECT customer_id, state, total_spend,
  ((rank() OVER (ORDER BY coalesce(total_spend, 0) DESC) - 1) * 10) // count(*) OVER () + 1 AS customer_decile FROM k_dim"""

STEPS["k_best"] = "SELECT customer_id AS best FROM k_dim WHERE total_spend IS NOT NULL ORDER BY total_spend DESC, customer_id LIMIT 1"

STEPS["k_pareto"] = f"""
SELECT revenue_decile, count(*) AS customers_in_decile, sum(spend) AS decile_revenue,
  {rdiv('100 * sum(spend)', '(SELECT sum(order_value) FROM k_values)', 2)} AS pct_of_total_revenue
FROM (SELECT customer_id, spend, ntile(10) OVER (ORDER BY spend DESC, customer_id) AS revenue_decile
  FROM (SELECT customer_id, sum(order_value) AS spend FROM k_values GROUP BY 1)) GROUP BY 1"""

STEPS["k_p99"] = f"SELECT {rnd('quantile_cont(CAST(order_value AS DOUBLE), 0.99)', 2)} AS p99 FROM k_values"

STEPS["k_outliers"] = f"""
SELECT v.order_id, v.customer_id, v.order_date, c.country, v.order_value, p99 AS p99_threshold,
  {rdiv('v.order_value', 'p99', 2)} AS multiple_of_p99
FROM k_values v CROSS JOIN k_p99 LEFT JOIN k_customers c ON c.customer_id = v.customer_id WHERE v.order_value > p99"""

STEPS["k_kpi"] = """
SELECT sum(order_value) AS total_revenue, sum(order_profit) AS total_profit, count(DISTINCT customer_id) AS distinct_customers,
  count(DISTINCT order_id) AS distinct_orders,
  (SELECT count(*) FROM (SELECT DISTINCT order_id AS a FROM k_curated) x FULL JOIN (SELECT DISTINCT order_id AS b FROM k_lines) y ON a = b
   WHERE a IS NULL OR b IS NULL) AS grain_parity FROM k_curated"""


def _lookup(raw_key: str, table: str) -> str:
    return f"SELECT count(*) AS n, count(*) - count(k) AS nulls, count(k) - count(DISTINCT k) AS repeats, count(k) AS keys FROM (SELECT {raw_key} AS k FROM {table})"


_ORDER_NAMES = ("OrderID", "CustomerID", "OrderDate", "OrderDiscountPct", "BasketItemCount")
_ITEM_NAMES = ("OrderID", "LineNumber", "ProductID", "Quantity", "UnitPrice", "LineNetAmount")


def _shard_columns(kind: str, table: str, names: tuple[str, ...], gone=("", ""), other=("", ""), retyped="") -> str:
    """Month, column, place and counts of the value classes; ``gone`` is a month and the column it lacks,
    ``other`` a month and the column that ``retyped`` replaces there."""
    lost = names.index(gone[1]) + 1 if gone[1] else 99
    parts = []
    for at, name in enumerate(names, 1):
        text = f"""CASE WHEN source_month = '{other[0]}' THEN {retyped} ELSE "{name}" END""" if name == other[1] else f'"{name}"'
        place = f"CASE WHEN source_month = '{gone[0]}' THEN {at - 1} ELSE {at} END" if at > lost else str(at)
        parts.append(f"""SELECT '{kind}' AS kind, source_month, '{name}' AS column_name, min({place}) AS place, count(*) FILTER (t <> '') AS filled,
  count(*) FILTER (regexp_full_match(t, '[+-]?(0|[1-9]\\d{{0,17}})')) AS whole, count(*) FILTER (regexp_full_match(t, '[+-]?((0|[1-9]\\d*)(\\.\\d+)?|\\.\\d+)')) AS number,
  count(*) FILTER (regexp_full_match(t, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')) AS day
  FROM (SELECT source_month, {trim(text)} AS t FROM {table} WHERE {_WINDOW} AND NOT (source_month = '{gone[0] if name == gone[1] else ''}')) GROUP BY source_month""")
    return " UNION ALL ".join(parts)


def _inventory(counts: str) -> str:
    return f"""SELECT kind, kind || source_month AS table_name, column_name, CASE WHEN filled < 10 THEN NULL WHEN 2 * whole > filled THEN 'bigint'
  WHEN 2 * number > filled THEN 'decimal' WHEN 2 * day > filled THEN 'date' ELSE 'string' END AS data_type, place AS ordinal_position FROM ({counts})"""


def _contract(inventory: str) -> str:
    return f"""SELECT kind, count(*) AS shards, count(*) FILTER (have < 5) AS missing, any_value(drift) AS drift FROM
  (SELECT kind, table_name, count(*) FILTER (column_name <> 'LineNumber') AS have FROM {inventory} GROUP BY 1, 2) JOIN
  (SELECT kind, count(*) FILTER (types > 1) AS drift FROM (SELECT kind, column_name, count(DISTINCT data_type) AS types FROM {inventory}
   WHERE column_name <> 'LineNumber' GROUP BY 1, 2) GROUP BY 1) USING (kind) GROUP BY kind"""


def _contract_counts(orders: str, items: str = "") -> str:
    return ", ".join(
        f"(SELECT {c} FROM {source} WHERE kind = '{kind}') AS {c}_{kind}"
        for kind, source in (("orders", orders), ("items", items or orders)) for c in ("shards", "missing", "drift")
    )


STEPS["k_inventory"] = _inventory(_shard_columns("orders", "k_raw_orders", _ORDER_NAMES) + " UNION ALL " + _shard_columns("items", "k_raw_items", _ITEM_NAMES))
STEPS["k_faulty_inventory"] = _inventory(
    _shard_columns("orders", "k_raw_orders", _ORDER_NAMES, ("199703", "OrderDiscountPct"), ("199605", "OrderDate"), """replace("OrderDate", '-', '')""")
    + " UNION ALL " + _shard_columns("items", "k_raw_items", _ITEM_NAMES, ("199808", "UnitPrice"), ("199702", "Quantity"), """"Quantity" || ' pc'""")
)
STEPS["k_contract"] = _contract("k_inventory")
STEPS["k_faulty_contract"] = _contract("k_faulty_inventory")

STEPS["k_raw_counts"] = f"""
SELECT
  c.n AS n_c, c.nulls AS null_c, c.repeats AS rep_c, p.n AS n_p, p.nulls AS null_p, p.repeats AS rep_p, o.*, i.*, {_contract_counts('k_contract')}
FROM ({_lookup('customer_id', 'k_customers')}) c, ({_lookup('product_id', 'k_products')}) p,
(SELECT count(*) AS n_o, count(*) FILTER (coalesce(t_o, '') = '') AS o13, count(*) FILTER (coalesce(tc, '') = '') AS o14,
  count(*) FILTER (tc <> '' AND NOT EXISTS (SELECT 1 FROM k_customers k WHERE k.customer_id = x.tc)) AS o15,
  count(*) FILTER (coalesce(td, '') = '') AS o16, count(*) FILTER (td <> '' AND day IS NULL) AS o17,
  count(*) FILTER (day > DATE '{CFG.as_of_date}') AS o18, count(*) FILTER (ro <> t_o OR rc <> tc) AS o19 FROM k_orders_in x) o,
(SELECT count(*) AS n_i, count(*) FILTER (amount < 0) AS i20, count(*) FILTER (amount = 0) AS i21,
  count(*) FILTER (coalesce(ta, '') = '') AS i22, count(*) FILTER (ta <> '' AND amount IS NULL) AS i23, count(*) FILTER ({_CENTS}) AS i24,
  count(*) FILTER (tp <> '' AND NOT EXISTS (SELECT 1 FROM k_products k WHERE k.product_id = x.tp)) AS i25,
  count(*) FILTER (ro <> t_o OR rp <> tp) AS i26, count(ro) - count(DISTINCT ro || '|' || rp || '|' || source_month) AS i27 FROM k_items_in x) i"""

_RAW_COUNTS = {
    1: ("0", "11"), 2: ("0", "11"), 3: ("0", "7"), 4: ("0", "7"), 5: ("missing_orders", "shards_orders"), 6: ("drift_orders", "5"), 7: ("missing_items", "shards_items"), 8: ("drift_items", "5"),
    9: ("null_c", "n_c"), 10: ("rep_c", "n_c"), 11: ("null_p", "n_p"), 12: ("rep_p", "n_p"),
    **{c: (f"o{c}", "n_o") for c in range(13, 20)}, **{c: (f"i{c}", "n_i") for c in range(20, 28)},
    28: ("n_c", "n_c"), 29: ("n_p", "n_p"),
}


def _audit(counts: dict[int, tuple[str, str]], source: str, checks) -> str:
    rows = " UNION ALL ".join(f"SELECT {c} AS check_order, {a} AS issue_count, {b} AS table_rows FROM {source}" for c, (a, b) in counts.items())
    names = _values([(*c[:5], c[5] if len(c) > 5 else "") for c in checks], "check_order, check_name, source_column, severity, done, skipped")
    return f"SELECT check_order, check_name, source_column, severity, issue_count, table_rows, {rdiv('100 * issue_count', 'table_rows', 3)} AS pct_of_table, CASE WHEN issue_count IS NULL THEN skipped ELSE done END AS handling FROM ({rows}) JOIN (SELECT * FROM {names}) USING (check_order)"


STEPS["k_raw_audit"] = _audit(_RAW_COUNTS, "k_raw_counts", RAW_CHECKS)
_SKIPPED_ORDERS, _SKIPPED_ITEMS = {c: ("NULL", "0") for c in range(13, 20)}, {c: ("NULL", "0") for c in range(20, 28)}
STEPS["k_faulty_counts"] = f"SELECT * EXCLUDE (shards_orders, missing_orders, drift_orders, shards_items, missing_items, drift_items), {_contract_counts('k_faulty_contract')} FROM k_raw_counts"
STEPS["k_faulty_audit"] = _audit(_RAW_COUNTS | _SKIPPED_ORDERS | _SKIPPED_ITEMS, "k_faulty_counts", RAW_CHECKS)
STEPS["k_half_counts"] = f"SELECT * EXCLUDE (shards_orders, missing_orders, drift_orders, shards_items, missing_items, drift_items), {_contract_counts('k_faulty_contract', 'k_contract')} FROM k_raw_counts"

STEPS["k_clean_counts"] = """
SELECT c.n AS n_c, c.nulls AS null_c, c.repeats AS rep_c, c.keys AS key_c, p.n AS n_p, p.nulls AS null_p, p.repeats AS rep_p, p.keys AS key_p, o.*, i.*,
  (SELECT count(*) FROM k_products WHERE unit_cost IS NULL) AS no_cost
FROM (""" + _lookup("customer_id", "k_customers") + ") c, (" + _lookup("product_id", "k_products") + """) p,
(SELECT count(*) AS n_o, count(*) FILTER (order_id IS NULL) AS o1, count(*) FILTER (customer_id IS NULL) AS o2,
  count(*) FILTER (NOT EXISTS (SELECT 1 FROM k_customers k WHERE k.customer_id = x.customer_id)) AS o3,
  count(*) FILTER (order_date IS NULL) AS o4, count(*) FILTER (order_date > DATE '2001-06-30') AS o5, count(*) - count(DISTINCT order_id) AS o6,
  count(*) FILTER (NOT EXISTS (SELECT 1 FROM k_items k WHERE k.order_id = x.order_id)) AS o7,
  count(*) FILTER (basket_item_count <> (SELECT NULLIF(count(*), 0) FROM k_items k WHERE k.order_id = x.order_id)) AS o8,
  count(*) FILTER (order_discount_pct < 0 OR order_discount_pct > 1) AS o9 FROM k_orders x) o,
(SELECT count(*) AS n_i, count(*) FILTER (order_id IS NULL) AS i10, count(*) FILTER (product_id IS NULL) AS i11,
  count(*) FILTER (NOT EXISTS (SELECT 1 FROM k_products k WHERE k.product_id = x.product_id)) AS i12,
  count(*) FILTER (NOT EXISTS (SELECT 1 FROM k_orders k WHERE k.order_id = x.order_id)) AS i13,
  count(*) FILTER (quantity IS NULL) AS i14, count(*) FILTER (quantity <= 0) AS i15, count(*) FILTER (unit_price IS NULL) AS i16,
  count(*) FILTER (unit_price <= 0) AS i17, count(*) FILTER (line_net_amount IS NULL) AS i18, count(*) FILTER (line_net_amount <= 0) AS i19,
  count(*) - count(DISTINCT order_id || '|' || product_id) AS i20 FROM k_items x) i"""

STEPS["k_clean_audit"] = _audit({
    **{c: (f"o{c}", "n_o") for c in range(1, 10)}, **{c: (f"i{c}", "n_i") for c in range(10, 21)},
    21: ("null_c", "n_c"), 22: ("rep_c", "key_c"), 23: ("null_p", "n_p"), 24: ("rep_p", "key_p"), 25: ("no_cost", "n_p"),
    26: ("n_o", "n_o"), 27: ("n_i", "n_i"), 28: ("n_c", "n_c"), 29: ("n_p", "n_p"),
}, "k_clean_counts", CLEAN_CHECKS)


def _findings(audit: str) -> str:
    pct = "regexp_replace(regexp_replace(CAST(CAST(pct_of_table AS DECIMAL(28,3)) AS VARCHAR), '0+$', ''), '\\.$', '')"
    return f"""SELECT check_order, severity, CASE WHEN issue_count IS NULL THEN check_name || ' – Skipped. ' || handling WHEN severity = 'INFO' THEN check_name || ' – ' || issue_count || ' rows.'
  WHEN issue_count = 0 THEN check_name || ' – No issues found.'
  ELSE 'Found ' || issue_count || ' for ' || check_name || ' (' || {pct} || '%) – ' || handling END AS finding FROM {audit}"""


# name -> (body, output columns as "name:type"; s text, i bigint, d double, b boolean)
ORACLES: dict[str, tuple[str, str]] = {}


def add(name: str, body: str, columns: str) -> None:
    ORACLES[name] = (body, columns)


add("s1_shard_load", f"""SELECT source_month, count(*) AS rows, count("OrderID") AS order_ids, count(DISTINCT "CustomerID") AS customer_texts,
  count(*) FILTER ("CustomerID" <> trim("CustomerID")) AS padded_customers FROM k_raw_orders WHERE {_WINDOW} GROUP BY 1""",
    "source_month:s rows:i order_ids:i customer_texts:i padded_customers:i")
add("s1_shard_load_items", f"""SELECT source_month, count(*) AS rows, count("OrderID") AS order_ids, count(DISTINCT "ProductID") AS product_texts, count("LineNetAmount") AS amounts,
  count(*) FILTER ("ProductID" <> trim("ProductID", ' ')) AS padded_products FROM k_raw_items WHERE {_WINDOW} GROUP BY 1""",
    "source_month:s rows:i order_ids:i product_texts:i amounts:i padded_products:i")
_INV = "table_name:s column_name:s data_type:s ordinal_position:i"
add("s8_column_inventory", "SELECT * FROM k_inventory", _INV)
add("s8_faulty_inventory", "SELECT * FROM k_faulty_inventory", _INV)
_CONTRACT = "SELECT kind AS source, shards, missing AS shards_missing_columns, drift AS columns_with_type_drift, missing = 0 AND drift = 0 AS contract_ok FROM "
_CONTRACT_OUT = "source:s shards:i shards_missing_columns:i columns_with_type_drift:i contract_ok:b"
add("d1_schema_contract", _CONTRACT + "k_contract", _CONTRACT_OUT)
add("d1_faulty_contract", _CONTRACT + "k_faulty_contract", _CONTRACT_OUT)
add("s3_mixed_shapes", f"""SELECT 'orders' AS kind, source_month, count(*) AS rows, count("OrderID") AS order_ids,
  count("OrderDiscountPct") FILTER (source_month <> '199703') AS dropped_column_values, count("OrderDate") AS retyped_column_values,
  min(CASE WHEN source_month = '199605' THEN replace("OrderDate", '-', '') ELSE "OrderDate" END) AS least_retyped FROM k_raw_orders WHERE {_WINDOW} GROUP BY 2
  UNION ALL SELECT 'items', source_month, count(*), count("OrderID"), count("UnitPrice") FILTER (source_month <> '199808'), count("Quantity"),
  min(CASE WHEN source_month = '199702' THEN "Quantity" || ' pc' ELSE "Quantity" END) FROM k_raw_items WHERE {_WINDOW} GROUP BY 2""",
    "kind:s source_month:s rows:i order_ids:i dropped_column_values:i retyped_column_values:i least_retyped:s")
_AUDIT = "check_order:i check_name:s source_column:s severity:s issue_count:i table_rows:i pct_of_table:d handling:s"
add("d2_raw_audit", "SELECT * FROM k_raw_audit", _AUDIT)
add("s9_incremental_rebuild", """SELECT source_month, source_month = '199605' AND bool_or("OrderDate" LIKE '%7') AS rewritten,
  count(*) FILTER (NOT late) AS rows, count(*) FILTER (t_o <> '' AND NOT late) AS order_ids
  FROM (SELECT *, source_month = '199605' AND coalesce(rd LIKE '%7', false) AS late, rd AS "OrderDate" FROM k_orders_in) GROUP BY source_month""",
    "source_month:s rewritten:b rows:i order_ids:i")
add("s13_half_guarded_audit", _audit(_RAW_COUNTS | _SKIPPED_ORDERS, "k_half_counts", RAW_CHECKS), _AUDIT)
add("d2_faulty_audit", "SELECT * FROM k_faulty_audit", _AUDIT)
add("d2_faulty_audit_findings", _findings("k_faulty_audit"), "check_order:i severity:s finding:s")
add("d2_raw_audit_findings", _findings("k_raw_audit"), "check_order:i severity:s finding:s")
add("d3_standardize_customers", "SELECT * FROM k_customers", "customer_id:s signup_date:s customer_archetype:s first_name:s last_name:s full_name:s email:s phone:s country:s state:s city:s address:s")
add("d4_standardize_products", "SELECT * FROM k_products", "product_id:s product_name:s product_category:s brand:s retail_price:d unit_cost:d margin_pct:d")
add("d5_orders_intake", """SELECT row_id, ro AS raw_order_id, rc AS raw_customer_id, rd AS raw_order_date, rp AS raw_order_discount_pct, rb AS raw_basket_item_count,
  NULLIF(t_o, '') AS order_id, NULLIF(tc, '') AS customer_id, day AS order_date, pct AS order_discount_pct_raw, basket AS basket_item_count_raw, source_month FROM k_orders_in""",
    "row_id:s raw_order_id:s raw_customer_id:s raw_order_date:s raw_order_discount_pct:s raw_basket_item_count:s order_id:s customer_id:s order_date:s order_discount_pct_raw:d basket_item_count_raw:i source_month:s")
add("d5_items_intake", """SELECT row_id, ro AS raw_order_id, rp AS raw_product_id, rq AS raw_quantity, ru AS raw_unit_price, ra AS raw_line_amount,
  NULLIF(t_o, '') AS order_id, NULLIF(tp, '') AS product_id, qty AS quantity_raw, price AS unit_price_raw, amount AS line_net_amount_raw, source_month FROM k_items_in""",
    "row_id:s raw_order_id:s raw_product_id:s raw_quantity:s raw_unit_price:s raw_line_amount:s order_id:s product_id:s quantity_raw:i unit_price_raw:d line_net_amount_raw:d source_month:s")
add("d6_orders_cleaned", "SELECT * FROM k_orders_clean", "row_id:s source_month:s raw_order_id:s raw_customer_id:s raw_order_date:s raw_order_discount_pct:s raw_basket_item_count:s order_id:s customer_id:s order_date:s order_discount_pct:d basket_item_count:i cleaning_flags:s")
add("d7_items_cleaned", "SELECT * FROM k_items_clean", "row_id:s source_month:s raw_order_id:s raw_product_id:s raw_quantity:s raw_unit_price:s raw_line_amount:s order_id:s product_id:s quantity:i unit_price:d line_net_amount:d cleaning_flags:s")
add("d8_orders_validated", "SELECT * FROM k_orders", "order_id:s customer_id:s order_date:s order_discount_pct:d basket_item_count:i source_month:s cleaning_flags:s")
add("d9_items_validated", "SELECT * FROM k_items", "order_id:s product_id:s quantity:i unit_price:d line_net_amount:d source_month:s cleaning_flags:s")
_PCT2 = lambda a, b: f"regexp_replace(regexp_replace(CAST(CAST({rnd(div(a, b) + ' * 100', 2)} AS DECIMAL(28,2)) AS VARCHAR), '0+$', ''), '\\.$', '')"
add("d10_cleaning_log", f"""WITH n AS (SELECT (SELECT count(*) FROM k_orders_in) AS a, (SELECT count(*) FROM k_orders) AS b, (SELECT count(*) FROM k_items_in) AS c, (SELECT count(*) FROM k_items) AS d),
f AS (SELECT 'orders' AS st, unnest(string_split(cleaning_flags, '|')) AS flag FROM k_orders_clean UNION ALL SELECT 'items', unnest(string_split(cleaning_flags, '|')) FROM k_items_clean)
SELECT 0 AS entry_order, 'PIPELINE OVERVIEW' AS rule_name, 'Orders: ' || a || ' intake -> ' || b || ' validated (' || {_PCT2('b', 'a')} || '% retention). Items: ' || c || ' intake -> ' || d || ' validated (' || {_PCT2('d', 'c')} || '% retention).' AS finding FROM n
UNION ALL SELECT row_number() OVER (ORDER BY st, flag), st || ': ' || flag, count(*) || ' rows flagged in ' || st || ' stream.' FROM f WHERE flag <> '' GROUP BY st, flag""",
    "entry_order:i rule_name:s finding:s")
add("d11_stage_row_counts", """SELECT 'Orders intake' AS stage_name, count(*) AS rows_count FROM k_orders_in UNION ALL SELECT 'Orders validated', count(*) FROM k_orders
  UNION ALL SELECT 'Items intake', count(*) FROM k_items_in UNION ALL SELECT 'Items validated', count(*) FROM k_items""", "stage_name:s rows_count:i")
add("d12_clean_audit", "SELECT * FROM k_clean_audit", _AUDIT)
add("d13_audit_findings", _findings("k_clean_audit"), "check_order:i severity:s finding:s")
_COV = f"""SELECT 1 AS check_order, {_quoted(COVERAGE_MESSAGES[0])} AS message, CASE WHEN count(country) = 0 THEN 1 ELSE 0 END AS violations FROM k_curated
UNION ALL SELECT 2, {_quoted(COVERAGE_MESSAGES[1])}, count(*) FROM (SELECT country FROM k_curated WHERE country IS NOT NULL EXCEPT SELECT primary_country FROM k_segments)
UNION ALL SELECT 3, {_quoted(COVERAGE_MESSAGES[2])}, count(*) FROM (SELECT primary_country FROM k_segments WHERE primary_country IS NOT NULL EXCEPT SELECT country FROM k_customers)"""
add("d14_country_coverage", f"SELECT *, violations = 0 AS passed FROM ({_COV})", "check_order:i message:s violations:i passed:b")
add("d15_country_coverage_faults", f"""SELECT fault, CASE fault WHEN 'none' THEN (SELECT min(check_order) FROM ({_COV}) WHERE violations > 0)
  WHEN 'empty_curated' THEN 1 WHEN 'extra_curated_country' THEN CASE WHEN 'Atlantis' IN (SELECT primary_country FROM k_segments) THEN NULL ELSE 2 END
  ELSE CASE WHEN 'Atlantis' IN (SELECT country FROM k_customers) THEN NULL ELSE 3 END END AS first_failed_check
  FROM (VALUES ('none'), ('empty_curated'), ('extra_curated_country'), ('segment_country_missing_from_dimension')) t(fault)""", "fault:s first_failed_check:i")
# the master's columns, then the scores' columns without the four that both have
_DIM = (
    "customer_id:text signup_date:date customer_archetype:text first_name:text last_name:text full_name:text email:text phone:text country:text state:text city:text "
    "address:text analysis_date:date last_order_date:date recency_days:number order_count:number total_spend:number total_profit:number margin_pct:number "
    "avg_order_value:number total_units:number avg_products_per_order:number r_score:number f_score:number m_score:number rfm_cell:text health_score:number segment:text action:text"
).split()
add("d16_column_inventory", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS kind, {i} AS ordinal_position, count({c}) AS filled FROM k_dim" for i, (c, k) in enumerate((x.split(":") for x in _DIM), 1)),
    "column_name:s kind:s ordinal_position:i filled:i")
add("d16_customer_dim_validation", """SELECT count(*) AS bi_dim_rows, (SELECT count(*) FROM k_customers) AS std_dim_rows, count(*) - (SELECT count(*) FROM k_customers) AS row_delta,
  count(DISTINCT customer_id) AS distinct_customers, count(*) - count(DISTINCT customer_id) AS dup_delta, count(*) FILTER (segment IS NULL) AS null_segment_customers, count(segment) AS scored_customers FROM k_dim""",
    "bi_dim_rows:i std_dim_rows:i row_delta:i distinct_customers:i dup_delta:i null_segment_customers:i scored_customers:i")

_Q = lambda p: rnd(f"quantile_cont(CAST(order_value AS DOUBLE), {p})", 2)
add("e1_order_value_distribution", f"""SELECT {_Q(0.1)} AS p10, {_Q(0.25)} AS p25, {_Q(0.5)} AS median, {_Q(0.75)} AS p75, {_Q(0.9)} AS p90, {_Q(0.99)} AS p99,
  min(order_value) AS min_value, max(order_value) AS max_value, {rdiv('sum(order_value)', 'count(*)', 2)} AS mean_value, count(*) AS order_count FROM k_values""",
    "p10:d p25:d median:d p75:d p90:d p99:d min_value:d max_value:d mean_value:d order_count:i")
_OUT = "order_id:s customer_id:s order_date:s country:s order_value:d p99_threshold:d multiple_of_p99:d"
add("e2_order_value_outliers", "SELECT * FROM k_outliers", _OUT)
add("e2_largest_outliers", "SELECT * FROM k_outliers ORDER BY order_value DESC, order_id LIMIT 5", _OUT)
add("e3_country_breakdown", f"""SELECT c.country, count(*) AS order_count, count(DISTINCT v.customer_id) AS customer_count, {rdiv('sum(order_value)', 'count(*)', 2)} AS avg_order_value,
  sum(order_value) AS total_revenue, {rdiv('100 * sum(order_value)', '(SELECT sum(order_value) FROM k_values)', 2)} AS revenue_share_pct
  FROM k_values v LEFT JOIN k_customers c ON c.customer_id = v.customer_id GROUP BY 1""", "country:s order_count:i customer_count:i avg_order_value:d total_revenue:d revenue_share_pct:d")
add("e4_monthly_temporal_pattern", f"""SELECT strftime(order_date, '%Y-%m') AS year_month, count(*) AS order_count, count(DISTINCT customer_id) AS active_customers,
  sum(order_value) AS monthly_revenue, {rdiv('sum(order_value)', 'count(*)', 2)} AS avg_order_value FROM k_values GROUP BY 1""", "year_month:s order_count:i active_customers:i monthly_revenue:d avg_order_value:d")
add("e5_customer_frequency_distribution", f"""SELECT n AS order_count, count(*) AS customers_with_this_count, {rdiv('100 * count(*)', '(SELECT count(DISTINCT customer_id) FROM k_orders)', 2)} AS pct_of_customers
  FROM (SELECT customer_id, count(*) AS n FROM k_orders GROUP BY 1) GROUP BY 1""", "order_count:i customers_with_this_count:i pct_of_customers:d")
_BUCKET = "CASE " + " ".join(f"WHEN days < {e} THEN '{b}'" for e, b in RECENCY_BUCKETS[:-1]) + f" ELSE '{RECENCY_BUCKETS[-1][1]}' END"
add("e6_recency_distribution", f"""SELECT {_BUCKET} AS recency_bucket, count(*) AS customer_count, min(days) AS min_days, max(days) AS max_days
  FROM (SELECT customer_id, date_diff('day', max(order_date), (SELECT max(order_date) FROM k_orders)) AS days FROM k_orders GROUP BY 1) GROUP BY 1""", "recency_bucket:s customer_count:i min_days:i max_days:i")
add("e7_pareto_concentration", "SELECT * FROM k_pareto", "revenue_decile:i customers_in_decile:i decile_revenue:d pct_of_total_revenue:d")
add("e8_basket_composition", f"""SELECT c.country, count(*) AS order_count, sum(n) AS line_count, {rdiv('sum(n)', 'count(*)', 2)} AS avg_items_per_order,
  {rdiv('sum(basket_item_count)', 'count(basket_item_count)', 2)} AS avg_declared_items_per_order, count(*) FILTER (n <> basket_item_count) AS declared_actual_mismatch_count,
  {rdiv('100 * count(*) FILTER (n <> basket_item_count)', 'count(*)', 2)} AS declared_actual_mismatch_pct
  FROM (SELECT o.order_id, o.customer_id, o.basket_item_count, count(i.order_id) AS n FROM k_orders o LEFT JOIN k_items i ON i.order_id = o.order_id GROUP BY 1, 2, 3) b
  LEFT JOIN k_customers c ON c.customer_id = b.customer_id GROUP BY 1""",
    "country:s order_count:i line_count:i avg_items_per_order:d avg_declared_items_per_order:d declared_actual_mismatch_count:i declared_actual_mismatch_pct:d")
_DRIFT = "name:s baseline:d current:d kind:s drift:b"
add("e9_baseline_reconciliation", """SELECT name, baseline, current, kind, baseline <> current AS drift FROM (
  SELECT 'total_revenue' AS name, 'currency' AS kind, (SELECT sum(line_net_amount) FROM k_lines) AS baseline, (SELECT sum(order_value) FROM k_curated) AS current
  UNION ALL SELECT 'distinct_orders', 'count', (SELECT count(DISTINCT order_id) FROM k_lines), (SELECT count(*) FROM k_curated)
  UNION ALL SELECT 'distinct_customers', 'count', (SELECT count(*) FROM k_segments), (SELECT count(DISTINCT customer_id) FROM k_curated))""", _DRIFT)
add("e10_population_split", """SELECT 'Item-bearing orders' AS population, (SELECT count(*) FROM k_values) AS orders UNION ALL SELECT 'All validated orders', (SELECT count(*) FROM k_orders)
  UNION ALL SELECT 'Delta: itemless orders', (SELECT count(*) FROM k_orders) - (SELECT count(*) FROM k_values)""", "population:s orders:i")
add("e11_month_coverage", """SELECT strftime(m, '%Y-%m') AS year_month, day(last_day(m)) AS days_in_month,
  date_diff('day', greatest(m::DATE, a), least(last_day(m), b)) + 1 AS days_covered, date_diff('day', greatest(m::DATE, a), least(last_day(m), b)) + 1 < day(last_day(m)) AS is_partial,
  NOT EXISTS (SELECT 1 FROM k_values v WHERE date_trunc('month', v.order_date) = m) AS is_gap
  FROM (SELECT min(order_date) AS a, max(order_date) AS b FROM k_values), range(date_trunc('month', (SELECT min(order_date) FROM k_values))::TIMESTAMP, (SELECT max(order_date) FROM k_values)::TIMESTAMP + INTERVAL 1 SECOND, INTERVAL 1 MONTH) t(m)""",
    "year_month:s days_in_month:i days_covered:i is_partial:b is_gap:b")
add("e12_cumulative_concentration", "SELECT revenue_decile, sum(pct_of_total_revenue) OVER (ORDER BY revenue_decile) AS cumulative_pct FROM k_pareto", "revenue_decile:i cumulative_pct:d")

_CUR = "order_id:s customer_id:s order_date:s country:s state:s city:s order_discount_pct:d basket_item_count:i order_value:d order_cost:d order_profit:d order_margin_pct:d total_units:i distinct_products:i dominant_category:s dominant_brand:s source_month:s"
add("f1_sales_curated", "SELECT * FROM k_curated", _CUR)
_RFM = "customer_id:s data_as_of_date:s last_order_date:s recency_days:i frequency_orders:i monetary_value:d total_profit:d avg_margin_pct:d avg_order_value:d total_units:i avg_products_per_order:d primary_country:s primary_state:s primary_city:s"
add("f2_customer_rfm", "SELECT * FROM k_rfm", _RFM)
add("f3_rfm_customer_segments", "SELECT * FROM k_segments", _RFM + " snapshot_date:s r_score:i f_score:i m_score:i rfm_cell:s rfm_total_score:i rfm_segment:s recommended_action:s")
_BI = "analysis_date:s last_order_date:s recency_days:i order_count:i total_spend:d total_profit:d margin_pct:d avg_order_value:d total_units:i avg_products_per_order:d r_score:i f_score:i m_score:i rfm_cell:s health_score:i segment:s action:s"
add("f4_rfm_for_bi", """SELECT customer_id, data_as_of_date AS analysis_date, last_order_date, recency_days, frequency_orders AS order_count, monetary_value AS total_spend, total_profit,
  avg_margin_pct AS margin_pct, avg_order_value, total_units, avg_products_per_order, primary_country AS country, primary_state AS state, primary_city AS city, r_score, f_score, m_score, rfm_cell,
  rfm_total_score AS health_score, rfm_segment AS segment, recommended_action AS action FROM k_segments""", "customer_id:s country:s state:s city:s " + _BI)
add("f5_product_analytics", """SELECT s.*, i.product_id, p.product_name, p.product_category, p.brand, p.margin_pct AS product_margin_pct, i.quantity, i.unit_price, i.line_net_amount AS line_revenue,
  round(i.quantity * p.unit_cost, 2) AS line_cost, round(i.line_net_amount - i.quantity * p.unit_cost, 2) AS line_profit
  FROM k_curated s JOIN k_items i ON i.order_id = s.order_id JOIN k_products p ON p.product_id = i.product_id""",
    "order_id:s customer_id:s order_date:s country:s state:s city:s order_discount_pct:d order_value:d order_cost:d order_profit:d order_margin_pct:d product_id:s product_name:s product_category:s brand:s product_margin_pct:d quantity:i unit_price:d line_revenue:d line_cost:d line_profit:d")
add("f6_segment_summary", f"""SELECT rfm_segment, recommended_action, count(*) AS customer_count, {rdiv('100 * count(*)', '(SELECT count(*) FROM k_segments)', 1)} AS pct_of_total,
  {rdiv('sum(monetary_value)', 'count(*)', 2)} AS avg_monetary, {rdiv('sum(total_profit)', 'count(*)', 2)} AS avg_profit, {rnd(div('sum(avg_margin_pct)', 'count(*)') + ' * 100', 1)} AS avg_margin_pct,
  {rdiv('sum(recency_days)', 'count(*)', 0)} AS avg_recency_days, {rdiv('sum(frequency_orders)', 'count(*)', 1)} AS avg_frequency, min(rfm_total_score) AS min_score, max(rfm_total_score) AS max_score FROM k_segments GROUP BY 1, 2""",
    "rfm_segment:s recommended_action:s customer_count:i pct_of_total:d avg_monetary:d avg_profit:d avg_margin_pct:d avg_recency_days:d avg_frequency:d min_score:i max_score:i")
add("f7_items_for_bi", "SELECT * FROM k_lines", "order_id:s product_id:s customer_id:s order_date:s quantity:i line_net_amount:d line_profit:d line_margin_pct:d")
add("f8_line_fact_totals", "SELECT count(*) AS line_rows, sum(line_net_amount) AS total_revenue, sum(line_profit) AS total_profit FROM k_lines", "line_rows:i total_revenue:d total_profit:d")
add("f9_dim_customers_for_bi", "SELECT * FROM k_dim", "customer_id:s signup_date:s customer_archetype:s first_name:s last_name:s full_name:s email:s phone:s country:s state:s city:s address:s " + _BI)

add("m1_last_complete_month", "SELECT * FROM k_cutoff", "cutoff_month:s")
_M2 = f"""SELECT date_trunc('month', order_date)::DATE AS order_month, strftime(order_date, '%Y-%m') AS month_label, year(order_date) AS order_year, month(order_date) AS order_month_num,
  count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS active_customers, sum(order_value) AS total_revenue, sum(order_profit) AS total_profit,
  {rdiv('sum(order_profit)', 'sum(order_value)', 4)} AS margin_pct, {rdiv('sum(order_value)', 'count(*)', 2)} AS avg_order_value, sum(total_units) AS total_units FROM k_closed GROUP BY 1, 2, 3, 4"""
add("m2_monthly_revenue", _M2, "order_month:s month_label:s order_year:i order_month_num:i total_orders:i active_customers:i total_revenue:d total_profit:d margin_pct:d avg_order_value:d total_units:i")
_M3 = f"""SELECT *, margin_pct AS product_margin_pct, round(cost, 2) AS total_cost, round(total_revenue - cost, 2) AS total_profit, {rdiv('total_revenue - cost', 'total_revenue', 4)} AS realized_margin_pct,
  {rdiv('total_revenue', 'orders_containing', 2)} AS avg_line_revenue, {rdiv('total_revenue', 'units_sold', 2)} AS revenue_per_unit FROM k_prod"""
add("m3_product_performance", _M3, "product_id:s product_name:s product_category:s brand:s retail_price:d unit_cost:d product_margin_pct:d orders_containing:i units_sold:i total_revenue:d total_cost:d total_profit:d realized_margin_pct:d avg_line_revenue:d revenue_per_unit:d revenue_rank:i units_rank:i rank_within_category:i")
_M4 = f"""SELECT p.brand, count(DISTINCT i.product_id) AS product_count, count(DISTINCT i.order_id) AS orders_containing, sum(i.quantity) AS units_sold, sum(i.line_net_amount) AS total_revenue,
  round(sum(i.quantity * p.unit_cost), 2) AS total_cost, round(sum(i.line_net_amount) - sum(i.quantity * p.unit_cost), 2) AS total_profit,
  {rdiv('sum(i.line_net_amount) - sum(i.quantity * p.unit_cost)', 'sum(i.line_net_amount)', 4)} AS brand_margin_pct, {rdiv('sum(i.line_net_amount)', 'sum(i.quantity)', 2)} AS revenue_per_unit,
  {rdiv('sum(i.line_net_amount)', 'sum(sum(i.line_net_amount)) OVER ()', 4)} AS revenue_share FROM k_items i JOIN k_products p ON p.product_id = i.product_id GROUP BY 1"""
add("m4_brand_profitability", _M4, "brand:s product_count:i orders_containing:i units_sold:i total_revenue:d total_cost:d total_profit:d brand_margin_pct:d revenue_per_unit:d revenue_share:d")


def _place(place: str, customers: str, orders: str, revenue: str, profit: str) -> str:
    return f"""SELECT {place}, count(DISTINCT customer_id) AS {customers}, count(DISTINCT order_id) AS {orders}, sum(order_value) AS {revenue}, sum(order_profit) AS {profit},
  {rdiv('sum(order_profit)', 'sum(order_value)', 4)} AS margin_pct, {rdiv('sum(order_value)', 'count(DISTINCT customer_id)', 2)} AS arpu, {rdiv('sum(order_value)', 'count(*)', 2)} AS avg_order_value,
  {rdiv('sum(order_value)', 'sum(sum(order_value)) OVER ()', 4)} AS revenue_share FROM k_curated WHERE country IS NOT NULL GROUP BY {place}"""


_M5 = _place("country, state, city", "customer_count", "order_count", "total_revenue", "total_profit")
_M7 = _place("country", "customers", "orders", "revenue", "profit")
add("m5_regional_performance", _M5, "country:s state:s city:s customer_count:i order_count:i total_revenue:d total_profit:d margin_pct:d arpu:d avg_order_value:d revenue_share:d")
_M6 = f"""SELECT p.product_category, p.brand, date_trunc('month', s.order_date)::DATE AS order_month, strftime(s.order_date, '%Y-%m') AS month_label, count(DISTINCT s.order_id) AS order_count,
  sum(i.quantity) AS units_sold, sum(i.line_net_amount) AS category_revenue, round(sum(i.line_net_amount) - sum(i.quantity * p.unit_cost), 2) AS category_profit,
  {rdiv('sum(i.line_net_amount) - sum(i.quantity * p.unit_cost)', 'sum(i.line_net_amount)', 4)} AS category_margin_pct
  FROM k_closed s JOIN k_items i ON i.order_id = s.order_id JOIN k_products p ON p.product_id = i.product_id GROUP BY 1, 2, 3, 4"""
add("m6_category_monthly_trend", _M6, "product_category:s brand:s order_month:s month_label:s order_count:i units_sold:i category_revenue:d category_profit:d category_margin_pct:d")
add("m7_country_summary", _M7, "country:s customers:i orders:i revenue:d profit:d margin_pct:d arpu:d avg_order_value:d revenue_share:d")
add("m8_mart_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS view_name, count(*) AS rows_count FROM ({b})" for n, b in (
    ("v_monthly_revenue", _M2), ("v_product_performance", _M3), ("v_brand_profitability", _M4), ("v_regional_performance", _M5), ("v_category_monthly_trend", _M6), ("v_country_summary", _M7))), "view_name:s rows_count:i")
add("m8_last_month_check", f"SELECT 'v_monthly_revenue' AS view_name, max(order_month) AS last_complete_month FROM ({_M2}) UNION ALL SELECT 'v_category_monthly_trend', max(order_month) FROM ({_M6})", "view_name:s last_complete_month:s")
add("m9_cohort_retention", "SELECT * FROM k_retention", "cohort_month:s months_since_acquisition:i active_customers:i cohort_customers:i retention_rate:d")
add("m10_revenue_new_returning", "SELECT * FROM k_newret", "revenue_month:s customer_type:s revenue:d active_customers:i")

_AVG = lambda c: div(f"sum({c})", f"count({c})")
_Z = lambda a, b: f"coalesce({div(a, b)}, 0)"
_SCORED = "count(*) FILTER (order_count IS NOT NULL AND customer_id IS NOT NULL)"
_RISK = "segment IN ('At Risk', 'Hibernating')"
add("b1_revenue_profit_orders", "SELECT year(order_date) AS year, segment, sum(order_value) AS total_revenue, sum(order_profit) AS total_profit, count(*) AS distinct_orders, count(*) AS total_orders FROM k_full GROUP BY 1, 2",
    "year:i segment:s total_revenue:d total_profit:d distinct_orders:i total_orders:i")
add("b2_total_customers", f"SELECT state, {_SCORED} AS total_customers FROM k_dim GROUP BY 1", "state:s total_customers:i")
_BY_COUNTRY = f"""SELECT coalesce(a.country, b.country) AS country, rev, prof, n, cust, spend FROM
  (SELECT d_country AS country, sum(order_value) AS rev, sum(order_profit) AS prof, count(*) AS n FROM k_full GROUP BY 1) a
  FULL JOIN (SELECT country, {_SCORED} AS cust, sum(total_spend) AS spend FROM k_dim GROUP BY 1) b ON a.country IS NOT DISTINCT FROM b.country"""
add("b3_ratios", f"SELECT country, {_Z('rev', 'n')} AS avg_order_value, {_Z('rev', 'cust')} AS avg_customer_ltv, {_Z('prof', 'rev')} AS profit_margin_pct FROM ({_BY_COUNTRY})",
    "country:s avg_order_value:d avg_customer_ltv:d profit_margin_pct:d")
add("b4_rfm_averages", f"SELECT segment, {_AVG('recency_days')} AS avg_recency_days, {_AVG('order_count')} AS avg_frequency, {_AVG('total_spend')} AS avg_monetary FROM k_dim GROUP BY 1",
    "segment:s avg_recency_days:d avg_frequency:d avg_monetary:d")
add("b5_score_averages", f"SELECT city, {_AVG('r_score')} AS avg_r_score, {_AVG('f_score')} AS avg_f_score, {_AVG('m_score')} AS avg_m_score, {_AVG('health_score')} AS avg_health_score FROM k_dim GROUP BY 1",
    "city:s avg_r_score:d avg_f_score:d avg_m_score:d avg_health_score:d")
_MED = "SELECT CAST(CAST(median(CAST(recency_days AS DOUBLE)) AS DECIMAL(38,6)) AS DOUBLE) AS median_recency_days, CAST(CAST(median(CAST(total_spend AS DOUBLE)) AS DECIMAL(38,6)) AS DOUBLE) AS median_total_spend FROM k_dim"
add("b6_medians", f"{_MED} WHERE {_RISK}", "median_recency_days:d median_total_spend:d")
add("b6_medians_all", _MED, "median_recency_days:d median_total_spend:d")
_LEVELS = "GROUPING SETS ((segment, country), (segment), (country), ())"
add("b6_medians_by_axes", f"SELECT segment, country, grouping(segment, country) AS grouping, {_MED.removeprefix('SELECT ')} GROUP BY {_LEVELS}",
    "segment:s country:s grouping:i median_recency_days:d median_total_spend:d")
add("b3_ratios_with_subtotals", f"""SELECT coalesce(a.segment, b.segment) AS segment, coalesce(a.country, b.country) AS country, coalesce(a.g, b.g) AS grouping, rev AS total_revenue,
  {_Z('rev', 'n')} AS avg_order_value, {_Z('rev', 'cust')} AS avg_customer_ltv, {_Z('prof', 'rev')} AS profit_margin_pct
  FROM (SELECT segment, country, grouping(segment, country) AS g, sum(order_value) AS rev, sum(order_profit) AS prof, count(*) AS n FROM (SELECT segment, d_country AS country, order_value, order_profit FROM k_full) GROUP BY {_LEVELS}) a
  FULL JOIN (SELECT segment, country, grouping(segment, country) AS g, {_SCORED} AS cust FROM k_dim GROUP BY {_LEVELS}) b
  ON a.segment IS NOT DISTINCT FROM b.segment AND a.country IS NOT DISTINCT FROM b.country AND a.g = b.g""",
    "segment:s country:s grouping:i total_revenue:d avg_order_value:d avg_customer_ltv:d profit_margin_pct:d")
_LINE = f"sum(line_net_amount) AS line_revenue, sum(line_profit) AS line_profit, sum(quantity) AS line_quantity, {_Z('sum(line_profit)', 'sum(line_net_amount)')} AS line_margin_pct"
add("b7_line_measures", f"SELECT product_category, {_LINE} FROM k_lines GROUP BY 1", "product_category:s line_revenue:d line_profit:d line_quantity:i line_margin_pct:d")
add("b8_grain_reconciliation", "SELECT (SELECT sum(order_value) FROM k_curated) - (SELECT sum(line_net_amount) FROM k_lines) AS grain_reconciliation", "grain_reconciliation:d")
add("b9_product_counts", "SELECT count(DISTINCT product_id) AS total_products, count(DISTINCT brand) AS total_brands FROM k_products", "total_products:i total_brands:i")
# every brand of the product table counts; one without sales has margin 0
_HEAD = f"""SELECT count(line_revenue) AS sold_brands, first(brand ORDER BY line_revenue DESC NULLS LAST, brand) AS top_brand, max(line_revenue) AS top_brand_revenue, round(avg(coalesce(line_margin_pct, 0)), 10) AS avg_brand_margin_pct,
  min(coalesce(line_margin_pct, 0)) AS min_brand_margin_pct, max(coalesce(line_margin_pct, 0)) AS max_brand_margin_pct, {_Z('sum(line_profit)', 'sum(line_revenue)')} AS margin_baseline
  FROM (SELECT DISTINCT brand FROM k_products) p LEFT JOIN k_brandm USING (brand)"""
add("b10_brand_benchmarks", _HEAD, "top_brand_revenue:d avg_brand_margin_pct:d margin_baseline:d")
add("b23_brand_headline", _HEAD, "sold_brands:i top_brand:s top_brand_revenue:d avg_brand_margin_pct:d min_brand_margin_pct:d max_brand_margin_pct:d margin_baseline:d")


def _shares(axis: str, where: str = "") -> str:
    whole = f"(SELECT {_SCORED} FROM k_dim)"
    return f"SELECT {axis}, {_SCORED} AS total_customers, sum(total_spend) AS customer_spend, {_Z(_SCORED, whole)} AS customer_share, {_Z('sum(total_spend)', '(SELECT sum(total_spend) FROM k_dim)')} AS revenue_share FROM k_dim {where} GROUP BY 1"


_SHARE = "total_customers:i customer_spend:d customer_share:d revenue_share:d"
add("b11_shares_by_segment", _shares("segment"), "segment:s " + _SHARE)
add("b11_shares_by_country", _shares("country"), "country:s " + _SHARE)
add("q16_segment_mix", _shares("segment", "WHERE segment IS NOT NULL"), "segment:s " + _SHARE)
_B12 = f"SELECT sum(total_spend) FILTER ({_RISK}) AS revenue_at_risk, count(*) FILTER ({_RISK}) AS customers_at_risk, {_Z(f'sum(total_spend) FILTER ({_RISK})', '(SELECT sum(total_spend) FROM k_dim)')} AS pct_revenue_at_risk FROM k_dim"
add("b12_revenue_at_risk", _B12, "revenue_at_risk:d customers_at_risk:i pct_revenue_at_risk:d")
add("b12_revenue_at_risk_segment", _B12, "revenue_at_risk:d customers_at_risk:i pct_revenue_at_risk:d")  # a filter on the segment is replaced
add("b12_risk_by_segment", f"SELECT DISTINCT segment, r AS revenue_at_risk, c AS customers_at_risk, s AS customer_spend FROM (SELECT segment, sum(total_spend) AS s FROM k_dim GROUP BY 1), (SELECT sum(total_spend) FILTER ({_RISK}) AS r, count(*) FILTER ({_RISK}) AS c FROM k_dim)",
    "segment:s revenue_at_risk:d customers_at_risk:i customer_spend:d")
add("b12_revenue_at_risk_filtered", _B12 + " WHERE country = 'EUROPE'", "revenue_at_risk:d customers_at_risk:i pct_revenue_at_risk:d")
_STAGE = "sum(total_spend) FILTER (recency_days <= 90) AS revenue_active, sum(total_spend) FILTER (recency_days BETWEEN 91 AND 180) AS revenue_cooling, sum(total_spend) FILTER (recency_days > 180) AS revenue_dormant"
add("b13_recency_revenue", f"SELECT country, {_STAGE} FROM k_dim GROUP BY 1", "country:s revenue_active:d revenue_cooling:d revenue_dormant:d")
add("b14_customer_decile", "SELECT * FROM k_decile", "customer_id:s state:s total_spend:d customer_decile:i")
add("b15_what_if", f"SELECT r AS reactivation_rate, CAST((SELECT sum(total_spend) FROM k_dim WHERE {_RISK}) AS DOUBLE) * r / 100 AS revenue_impact, r = 10 AS is_default FROM range(0, 51, 5) t(r)",
    "reactivation_rate:i revenue_impact:d is_default:b")
_KPI5 = (
    "(SELECT sum(order_value) FROM k_curated)", f"(SELECT {_SCORED} FROM k_dim)", f"(SELECT {_Z('sum(order_value)', 'count(*)')} FROM k_curated)",
    f"(SELECT {_AVG('recency_days')} FROM k_dim)", f"(SELECT sum(total_spend) FROM k_dim WHERE {_RISK})",
)
add("b16_kpi_selector", " UNION ALL ".join(f"SELECT {i} AS sort_order, '{n}' AS kpi, CAST({e} AS DOUBLE) AS value" for i, (n, e) in enumerate(zip(KPI_CHOICES, _KPI5), 1)), "sort_order:i kpi:s value:d")
add("b17_arpu_by_country", f"SELECT country, {_Z('spend', 'cust')} AS arpu, rev AS total_revenue FROM ({_BY_COUNTRY})", "country:s arpu:d total_revenue:d")
_RET = div("sum(revenue) FILTER (customer_type = 'Returning')", "sum(revenue)")
add("b18_lifecycle_share", f"SELECT sum(revenue) AS lifecycle_revenue, sum(revenue) FILTER (customer_type = 'Returning') AS returning_revenue, {_RET} AS returning_share, round({_RET} * 100 / 5) * 5 AS returning_pct_nearest_5 FROM k_newret",
    "lifecycle_revenue:d returning_revenue:d returning_share:d returning_pct_nearest_5:i")
_EU_STATES = "country = 'EUROPE' AND state IN ('NATION_3', 'NATION_8', 'NATION_13')"
add("b19_filter_flags", f"""SELECT v AS visible_countries, a AS all_countries, 1 AS region_filter_active, CASE WHEN v < a THEN 1 ELSE 0 END AS country_filter_active
  FROM (SELECT count(DISTINCT country) FILTER ({_EU_STATES}) AS v, count(DISTINCT country) AS a FROM k_dim)""", "visible_countries:i all_countries:i region_filter_active:i country_filter_active:i")
_HEALTH = lambda c: f"CASE WHEN {c} >= 11 THEN '● Healthy' WHEN {c} >= 7 THEN '◐ Monitor' ELSE '○ Critical' END"
add("b20_customer_readout", f"""SELECT customer_id, segment, city, country, recency_days, health_score, 'R' || r_score || ' · F' || f_score || ' · M' || m_score AS rfm_label, {_HEALTH('health_score')} AS health_indicator
  FROM k_dim JOIN k_best ON best = customer_id""", "customer_id:s segment:s city:s country:s recency_days:i health_score:i rfm_label:s health_indicator:s")
add("b21_health_indicator", f"SELECT segment, {_AVG('health_score')} AS avg_health_score, {_HEALTH(_AVG('health_score'))} AS health_indicator FROM k_dim GROUP BY 1", "segment:s avg_health_score:d health_indicator:s")


def _map(country: str, state: str) -> str:
    """The core countries replace a country filter; the parent keeps the countries that the selection shows."""
    return f"""SELECT s AS selected_revenue, c AS country_total_revenue, {div('k', 's')} AS core_share, {div('s', 'a')} AS share_of_total, {div('s', 'c')} AS share_of_country FROM (SELECT
  sum(order_value) FILTER (({country}) AND ({state})) AS s, sum(order_value) FILTER (d_country IN (SELECT d_country FROM k_full WHERE ({country}) AND ({state}))) AS c,
  sum(order_value) FILTER (({state}) AND d_country IN ('EUROPE', 'ASIA')) AS k, sum(order_value) AS a FROM k_full)"""


_MAP = "selected_revenue:d country_total_revenue:d core_share:d share_of_total:d share_of_country:d"
_STATES = "d_state IN ('NATION_3', 'NATION_8', 'NATION_13')"
add("b22_map_shares", _map("true", "true"), _MAP)
add("b22_map_shares_filtered", _map("d_country = 'EUROPE'", _STATES), _MAP)
add("b22_map_shares_state", _map("true", _STATES), _MAP)
_CONTEXTS = (("all", "true"), ("core", "d_country IN ('EUROPE', 'ASIA')"), ("states", f"d_country = 'EUROPE' AND {_STATES}"), ("at_risk", "segment = 'At Risk'"))
add("b22_contexts_by_year", "SELECT year(order_date) AS year, " + ", ".join(
    f"sum(order_value) FILTER ({f}) AS {c}_total_revenue, CASE WHEN count(*) FILTER ({f}) > 0 THEN count(*) FILTER ({f}) END AS {c}_distinct_orders, count(*) FILTER ({f}) > 0 AS {c}_seen" for c, f in _CONTEXTS) +
    " FROM k_full GROUP BY 1", "year:i " + " ".join(f"{c}_total_revenue:d {c}_distinct_orders:i {c}_seen:b" for c, _ in _CONTEXTS))
add("a2_category_customers", """SELECT product_category, y AS year, grouping(product_category, y) AS grouping, count(DISTINCT customer_id) AS customers
  FROM (SELECT product_category, year(order_date) AS y, customer_id FROM k_lines) GROUP BY GROUPING SETS ((product_category, y), (product_category), (y), ())""",
    "product_category:s year:i grouping:i customers:i")
add("b24_context_counts", """SELECT (SELECT count(DISTINCT source_month) FROM k_curated) AS source_months, count(DISTINCT country) AS countries, count(DISTINCT state) AS states, count(DISTINCT city) AS cities, count(DISTINCT segment) AS segments,
  (SELECT count(DISTINCT cohort_month) FROM k_retention) AS cohorts, (SELECT min(cohort_month) FROM k_retention) AS first_cohort, (SELECT max(cohort_month) FROM k_retention) AS last_cohort, (SELECT max(months_since_acquisition) FROM k_retention) AS tenure_months FROM k_dim""",
    "source_months:i countries:i states:i cities:i segments:i cohorts:i first_cohort:s last_cohort:s tenure_months:i")


def _period(unit: str, where: str = "true") -> str:
    """Each calendar period with sales of its own or of the same dates a year earlier: a sale counts for the date twelve months on, if the calendar has it."""
    side = lambda shift, v: f"""SELECT date_trunc('{unit}', k.date)::DATE AS p, sum(order_value) AS r{v}, sum(order_profit) AS f{v} FROM k_full
      JOIN k_days k ON k.date = {shift} WHERE {where} GROUP BY 1"""  # noqa: E731
    return f"""SELECT coalesce(a.p, b.p) AS p, r, f, r0, f0, {_Z('f', 'r')} AS g, {_Z('f0', 'r0')} AS g0
      FROM ({side('order_date', '')}) a FULL JOIN ({side('(order_date + INTERVAL 12 MONTH)::DATE', '0')}) b ON a.p = b.p"""


add("t1_prior_year_month", f"SELECT p AS start_of_month, r AS total_revenue, r0 AS revenue_py, f AS total_profit, f0 AS profit_py, g AS profit_margin_pct, g0 AS profit_margin_py FROM ({_period('month')})",
    "start_of_month:s total_revenue:d revenue_py:d total_profit:d profit_py:d profit_margin_pct:d profit_margin_py:d")
add("t2_yoy_quarter", f"SELECT p AS start_of_quarter, {div('coalesce(r, 0) - coalesce(r0, 0)', 'r0')} AS revenue_yoy_pct, {div('coalesce(f, 0) - coalesce(f0, 0)', 'f0')} AS profit_yoy_pct FROM ({_period('quarter')})", "start_of_quarter:s revenue_yoy_pct:d profit_yoy_pct:d")
add("t3_margin_yoy_year", f"SELECT p AS start_of_year, g AS profit_margin_pct, g - g0 AS profit_margin_yoy_pp FROM ({_period('year')})", "start_of_year:s profit_margin_pct:d profit_margin_yoy_pp:d")
_WHERE_EU = "d_country = 'EUROPE'"
add("t5_prior_year_filtered", f"SELECT p AS start_of_month, r AS total_revenue, r0 AS revenue_py FROM ({_period('month', _WHERE_EU)})", "start_of_month:s total_revenue:d revenue_py:d")


def _rolling(unit: str, name: str) -> str:
    return f"""SELECT p AS {name}, (SELECT sum(order_value) FROM k_curated WHERE date_trunc('{unit}', order_date) = p) AS total_revenue,
  CASE WHEN lo <= (SELECT max(order_date) FROM k_curated) AND (hi - INTERVAL 12 MONTH)::DATE + 1 >= (SELECT min(order_date) FROM k_curated)
    THEN (SELECT coalesce(sum(order_value), 0) FROM k_curated WHERE order_date > (hi - INTERVAL 12 MONTH)::DATE AND order_date <= hi) END AS revenue_rolling_12m
  FROM (SELECT date_trunc('{unit}', date)::DATE AS p, min(date) AS lo, max(date) AS hi FROM k_days GROUP BY 1)"""


def _period_by(unit: str, axis: str, where: str = "true") -> str:
    """As ``_period``, per value of a customer column."""
    side = lambda shift, v: f"""SELECT {axis} AS x, date_trunc('{unit}', k.date)::DATE AS p, sum(order_value) AS r{v}, sum(order_profit) AS f{v} FROM k_full
      JOIN k_days k ON k.date = {shift} WHERE {where} GROUP BY 1, 2"""  # noqa: E731
    return f"""SELECT coalesce(a.x, b.x) AS x, coalesce(a.p, b.p) AS p, r, f, r0, f0, {_Z('f', 'r')} AS g, {_Z('f0', 'r0')} AS g0
      FROM ({side('order_date', '')}) a FULL JOIN ({side('(order_date + INTERVAL 12 MONTH)::DATE', '0')}) b ON a.p = b.p AND a.x IS NOT DISTINCT FROM b.x"""


def _rolling_by(unit: str, name: str, axes: dict[str, str]) -> str:
    """Sums over the orders of each window, per value of customer columns."""
    picked, names = ", ".join(f"{c} AS {a}" for a, c in axes.items()), ", ".join(axes)
    return f"""SELECT {names}, {name}, total_revenue, revenue_rolling_12m FROM (
  SELECT {names}, p AS {name}, sum(order_value) FILTER (order_date >= lo) AS total_revenue,
    CASE WHEN lo <= (SELECT max(order_date) FROM k_curated) AND (hi - INTERVAL 12 MONTH)::DATE + 1 >= (SELECT min(order_date) FROM k_curated) THEN sum(order_value) END AS revenue_rolling_12m
  FROM (SELECT order_date, order_value, {picked} FROM k_full) o
  JOIN (SELECT date_trunc('{unit}', date)::DATE AS p, min(date) AS lo, max(date) AS hi FROM k_days GROUP BY 1) w
    ON order_date > (hi - INTERVAL 12 MONTH)::DATE AND order_date <= hi GROUP BY {names}, p, lo, hi
) WHERE total_revenue IS NOT NULL OR revenue_rolling_12m IS NOT NULL"""


add("t1_prior_year_country_month", f"SELECT x AS country, p AS start_of_month, r AS total_revenue, r0 AS revenue_py, f AS total_profit, f0 AS profit_py, g AS profit_margin_pct, g0 AS profit_margin_py FROM ({_period_by('month', 'd_country')})",
    "country:s start_of_month:s total_revenue:d revenue_py:d total_profit:d profit_py:d profit_margin_pct:d profit_margin_py:d")
add("t2_yoy_segment_quarter", f"SELECT x AS segment, p AS start_of_quarter, {div('coalesce(r, 0) - coalesce(r0, 0)', 'r0')} AS revenue_yoy_pct, {div('coalesce(f, 0) - coalesce(f0, 0)', 'f0')} AS profit_yoy_pct FROM ({_period_by('quarter', 'segment', _WHERE_EU)})",
    "segment:s start_of_quarter:s revenue_yoy_pct:d profit_yoy_pct:d")
add("t4_rolling_12m_segment_week", _rolling_by("week", "start_of_week", {"segment": "segment"}), "segment:s start_of_week:s total_revenue:d revenue_rolling_12m:d")
add("t4_rolling_12m_country_state_month", _rolling_by("month", "start_of_month", {"country": "d_country", "state": "d_state"}),
    "country:s state:s start_of_month:s total_revenue:d revenue_rolling_12m:d")
add("t4_rolling_12m_month", _rolling("month", "start_of_month"), "start_of_month:s total_revenue:d revenue_rolling_12m:d")
add("q1_weekly_revenue", _rolling("week", "start_of_week"), "start_of_week:s total_revenue:d revenue_rolling_12m:d")
add("p15_calendar", """SELECT date, year(date) AS year, month(date) AS month, monthname(date) AS month_name, strftime(date, '%Y-%m') AS year_month, 'Q' || quarter(date) AS quarter,
  (dayofyear(date) + dayofweek(date_trunc('year', date)) - 1) // 7 + 1 AS week_of_year, day(date) AS day, dayname(date) AS day_name, year(date) * 100 + month(date) AS year_month_number, isodow(date) AS day_number,
  date_trunc('week', date)::DATE AS start_of_week, date_trunc('month', date)::DATE AS start_of_month, date_trunc('quarter', date)::DATE AS start_of_quarter, date_trunc('year', date)::DATE AS start_of_year,
  last_day(date) <= (SELECT max(order_date) FROM k_curated) AS is_closed_month FROM k_days""",
    "date:s year:i month:i month_name:s year_month:s quarter:s week_of_year:i day:i day_name:s year_month_number:i day_number:i start_of_week:s start_of_month:s start_of_quarter:s start_of_year:s is_closed_month:b")

_SEG = f"""SELECT coalesce(a.segment, b.segment) AS segment, rev, cust FROM (SELECT segment, sum(order_value) AS rev FROM k_full GROUP BY 1) a
  FULL JOIN (SELECT segment, {_SCORED} AS cust FROM k_dim GROUP BY 1) b ON a.segment IS NOT DISTINCT FROM b.segment"""
add("q2_segment_bars", f"SELECT segment, rev AS total_revenue, cust AS total_customers FROM ({_SEG})", "segment:s total_revenue:d total_customers:i")
_SCORES = f"{_SCORED} AS cust, {_AVG('r_score')} AS r, {_AVG('f_score')} AS f, {_AVG('m_score')} AS m"
add("q3_segment_profile", f"""SELECT coalesce(a.segment, b.segment) AS segment, cust AS total_customers, r AS avg_r_score, f AS avg_f_score, m AS avg_m_score, rev AS total_revenue, 0 AS is_total
  FROM (SELECT segment, sum(order_value) AS rev FROM k_full GROUP BY 1) a FULL JOIN (SELECT segment, {_SCORES} FROM k_dim GROUP BY 1) b ON a.segment IS NOT DISTINCT FROM b.segment
  UNION ALL SELECT NULL, cust, r, f, m, (SELECT sum(order_value) FROM k_curated), 1 FROM (SELECT {_SCORES} FROM k_dim)""",
    "segment:s total_customers:i avg_r_score:d avg_f_score:d avg_m_score:d total_revenue:d is_total:i")
add("k2_top_products_by_line_revenue", """SELECT product_name, sum(line_net_amount) AS line_revenue FROM k_lines JOIN (SELECT product_id, product_name FROM k_products) USING (product_id)
  GROUP BY 1 QUALIFY rank() OVER (ORDER BY sum(line_net_amount) DESC) <= 15""", "product_name:s line_revenue:d")
add("q4_recency_histogram", f"SELECT recency_days // 30 * 30 AS recency_bin, {_SCORED} AS total_customers FROM k_dim WHERE recency_days IS NOT NULL GROUP BY 1", "recency_bin:i total_customers:i")
add("q5_revenue_by_score", " UNION ALL ".join(f"SELECT '{c.upper()} Score' AS axis, {c}_score AS score, sum(order_value) AS total_revenue FROM k_full WHERE {c}_score IS NOT NULL GROUP BY 2" for c in "rfm"), "axis:s score:i total_revenue:d")
add("q6_revenue_by_brand", f"SELECT *, (SELECT {_Z('sum(line_profit)', 'sum(line_revenue)')} FROM k_brandm) AS margin_baseline FROM k_brandm", "brand:s line_revenue:d line_profit:d line_margin_pct:d margin_baseline:d")
add("q7_revenue_by_decile", f"""SELECT customer_decile, count(*) AS customers, sum(total_spend) AS total_revenue, {div('sum(sum(total_spend)) OVER (ORDER BY customer_decile)', '(SELECT sum(total_spend) FROM k_dim)')} AS cumulative_revenue_pct, 0.8 AS pareto_threshold
  FROM k_decile GROUP BY 1""", "customer_decile:i customers:i total_revenue:d cumulative_revenue_pct:d pareto_threshold:d")
add("q8_recency_stages", f"""WITH s AS (SELECT {_STAGE} FROM k_dim), u AS (SELECT 1 AS stage_order, 'Active' AS stage, revenue_active AS revenue FROM s UNION ALL SELECT 2, 'Cooling', revenue_cooling FROM s UNION ALL SELECT 3, 'Dormant', revenue_dormant FROM s)
  SELECT stage_order, stage, revenue, {div('revenue', '(SELECT sum(revenue) FROM u)')} AS share FROM u""", "stage_order:i stage:s revenue:d share:d")
add("q9_customer_kpis", f"""SELECT sum(order_value) AS total_revenue, count(*) AS total_orders, {_Z('sum(order_value)', 'count(*)')} AS avg_order_value, {_Z('sum(order_profit)', 'sum(order_value)')} AS profit_margin_pct, any_value(d.recency_days) AS recency_days,
  any_value(d.health_score) AS health_score, any_value('R' || d.r_score || ' · F' || d.f_score || ' · M' || d.m_score) AS rfm_label FROM k_curated s JOIN k_best ON best = s.customer_id JOIN k_dim d ON d.customer_id = best""",
    "total_revenue:d total_orders:i avg_order_value:d profit_margin_pct:d recency_days:i health_score:i rfm_label:s")
add("q9_customer_orders", "SELECT s.* FROM k_curated s JOIN k_best ON best = customer_id", "order_id:s order_date:s order_value:d order_profit:d order_margin_pct:d total_units:i dominant_category:s")
add("q9_customer_months", "SELECT date_trunc('month', order_date)::DATE AS order_month, sum(order_value) AS total_revenue FROM k_curated JOIN k_best ON best = customer_id GROUP BY 1", "order_month:s total_revenue:d")
add("q9_customer_categories", "SELECT product_category, sum(line_net_amount) AS line_revenue FROM k_lines JOIN k_best ON best = customer_id GROUP BY 1 QUALIFY rank() OVER (ORDER BY sum(line_net_amount) DESC) <= 5", "product_category:s line_revenue:d")
add("q10_rf_heatmap", f"SELECT r_score, f_score, {_SCORED} AS total_customers FROM k_dim WHERE r_score IS NOT NULL GROUP BY 1, 2", "r_score:i f_score:i total_customers:i")
add("q11_cohort_matrix", """SELECT c.cohort_month, m.i AS months_since_acquisition, r.retention_rate FROM (SELECT DISTINCT cohort_month FROM k_retention) c,
  (SELECT unnest(range(0, max(months_since_acquisition) + 1)) AS i FROM k_retention) m LEFT JOIN k_retention r ON r.cohort_month = c.cohort_month AND r.months_since_acquisition = m.i""",
    "cohort_month:s months_since_acquisition:i retention_rate:d")
add("q12_category_trend", "SELECT product_category, date_trunc('month', order_date)::DATE AS start_of_month, sum(line_net_amount) AS line_revenue FROM k_lines WHERE last_day(order_date) <= (SELECT max(order_date) FROM k_curated) GROUP BY 1, 2", "product_category:s start_of_month:s line_revenue:d")
add("q13_profitability_matrix", f"SELECT product_category, brand, product_id, {_LINE} FROM k_lines GROUP BY 1, 2, 3", "product_category:s brand:s product_id:s line_revenue:d line_profit:d line_margin_pct:d line_quantity:i")
add("q13_matrix_with_totals", f"SELECT product_category, brand, product_id, grouping(product_category, brand, product_id) AS grouping, {_LINE} FROM k_lines GROUP BY ROLLUP (product_category, brand, product_id)",
    "product_category:s brand:s product_id:s grouping:i line_revenue:d line_profit:d line_margin_pct:d line_quantity:i")
add("q14_frequency_monetary", f"SELECT segment, {_AVG('order_count')} AS avg_frequency, {_AVG('total_spend')} AS avg_monetary, {_SCORED} AS total_customers FROM k_dim WHERE segment IS NOT NULL GROUP BY 1", "segment:s avg_frequency:d avg_monetary:d total_customers:i")
add("q14_win_back_customers", f"SELECT customer_id, segment, recency_days, total_spend, order_count, m.* FROM k_dim, ({_MED} WHERE {_RISK}) m WHERE {_RISK}", "customer_id:s segment:s recency_days:i total_spend:d order_count:i median_recency_days:d median_total_spend:d")
add("q15_risk_table", f"""SELECT d.segment, count(*) AS customers_at_risk, sum(total_spend) AS revenue_at_risk, {_AVG('total_spend')} AS avg_monetary, any_value(discount_approach) AS discount_approach, CAST(sum(total_spend) AS DOUBLE) * 10 / 100 AS gross_recoverable
  FROM k_dim d JOIN k_strategy s ON s.segment = d.segment WHERE d.segment IN ('At Risk', 'Hibernating') GROUP BY 1""", "segment:s customers_at_risk:i revenue_at_risk:d avg_monetary:d discount_approach:s gross_recoverable:d")
add("q17_market_ranking", f"SELECT country, rev AS total_revenue, cust AS total_customers, {_Z('rev', 'cust')} AS avg_customer_ltv FROM ({_BY_COUNTRY}) WHERE country IS NOT NULL", "country:s total_revenue:d total_customers:i avg_customer_ltv:d")
add("q18_kpi_snapshot", f"""SELECT sum(order_value) AS total_revenue, sum(order_profit) AS total_profit, (SELECT {_SCORED} FROM k_dim) AS total_customers, count(*) AS total_orders, {_Z('sum(order_value)', 'count(*)')} AS avg_order_value,
  {_Z('sum(order_profit)', 'sum(order_value)')} AS profit_margin_pct, (SELECT sum(line_net_amount) FROM k_lines) AS line_revenue, sum(order_value) - (SELECT sum(line_net_amount) FROM k_lines) AS grain_reconciliation FROM k_curated""",
    "total_revenue:d total_profit:d total_customers:i total_orders:i avg_order_value:d profit_margin_pct:d line_revenue:d grain_reconciliation:d")
add("q18_segment_reconciliation", f"""SELECT s.segment, rev AS total_revenue, line AS line_revenue, cust AS total_customers, rev - line AS grain_reconciliation FROM ({_SEG}) s
  LEFT JOIN (SELECT d.segment, sum(line_net_amount) AS line FROM k_lines l LEFT JOIN k_dim d ON d.customer_id = l.customer_id GROUP BY 1) x ON x.segment IS NOT DISTINCT FROM s.segment""",
    "segment:s total_revenue:d line_revenue:d total_customers:i grain_reconciliation:d")
add("q19_segment_strategy", f"SELECT s.*, rev AS total_revenue, cust AS total_customers FROM ({_SEG}) f JOIN k_strategy s ON s.segment = f.segment",
    "segment:s total_revenue:d total_customers:i email_cadence:s loyalty_tier:s discount_approach:s budget_allocation:s sort_order:i")
add("k2_top_products", "SELECT product_id, brand, total_revenue, revenue_rank FROM k_prod WHERE revenue_rank <= 15", "product_id:s brand:s total_revenue:d revenue_rank:i")

add("v1_segment_shares", f"""SELECT rfm_segment AS segment, count(*) AS customers, sum(frequency_orders) AS orders, sum(monetary_value) AS revenue, sum(total_profit) AS profit,
  {div('count(*)', '(SELECT count(*) FROM k_segments)')} * 100 AS customer_share_pct, {div('sum(monetary_value)', '(SELECT sum(monetary_value) FROM k_segments)')} * 100 AS revenue_share_pct FROM k_segments GROUP BY 1""",
    "segment:s customers:i orders:i revenue:d profit:d customer_share_pct:d revenue_share_pct:d")
add("v2_focus_margin", "SELECT *, mean4 AS mean_order_discount_pct, discount_rate AS discount FROM k_focus", "segment:s customers:i orders:i revenue:d cost:d profit:d mean_order_discount_pct:d discount:d aov:d gross_margin:d contribution:d")
_KEPT = "((gross_margin - CAST(discount_rate AS DOUBLE)) / CAST(discount_rate AS DOUBLE))"
add("v3_contribution_per_euro", f"SELECT segment, discount_rate, gross_margin, {_KEPT} AS contribution_per_eur, {_KEPT} * 1000 AS contribution_per_1000 FROM k_focus", "segment:s discount_rate:d gross_margin:d contribution_per_eur:d contribution_per_1000:d")
STEPS["k_grid"] = f"""SELECT g.segment, g.gross_margin, p.discount_rate, {_KEPT} AS contribution_per_eur FROM (SELECT segment, gross_margin FROM k_margins WHERE {_RISK}) g CROSS JOIN (SELECT discount_rate FROM k_playbook) p"""
add("v4_rate_grid", "SELECT g.*, a.contribution_per_eur / h.contribution_per_eur AS common_ratio FROM k_grid g JOIN k_grid a ON a.discount_rate = g.discount_rate AND a.segment = 'At Risk' JOIN k_grid h ON h.discount_rate = g.discount_rate AND h.segment = 'Hibernating'",
    "segment:s gross_margin:d discount_rate:d contribution_per_eur:d common_ratio:d")
add("v5_segment_margin_all", """SELECT segment, revenue, profit, mean_pct AS mean_order_discount_pct, gross_margin, sort_order, coalesce(lag(gross_margin) OVER (ORDER BY sort_order) > gross_margin, false) AS falls_from_above,
  t.* FROM k_margins JOIN k_strategy USING (segment), (SELECT count(*) AS all_orders, sum(order_value) AS all_revenue, sum(order_profit) AS all_profit, max(order_discount_pct) AS max_order_discount_pct FROM k_curated) t""",
    "segment:s revenue:d profit:d mean_order_discount_pct:d gross_margin:d sort_order:i falls_from_above:b all_orders:i all_revenue:d all_profit:d max_order_discount_pct:d")
add("v6_compound_discount", "SELECT segment, 1 - (1 - CAST(mean4 AS DOUBLE)) * (1 - CAST(discount_rate AS DOUBLE)) AS off_list_with_offer, aov * contribution AS contribution_per_order, aov * contribution / 10.0::DOUBLE AS break_even_contact_cost FROM k_focus",
    "segment:s off_list_with_offer:d contribution_per_order:d break_even_contact_cost:d")
add("v7_playbook", "SELECT segment, discount_rate, budget_allocation, budget_share_pct, (SELECT count(*) FROM k_segments g WHERE g.rfm_segment = p.segment) AS customers FROM k_playbook p", "segment:s discount_rate:d budget_allocation:s budget_share_pct:i customers:i")



_GAP = f"abs({div('v', 'l')} - (1 - CAST(order_discount_pct AS DOUBLE)))"


def _figure(prefix: str, frame: str, items: list[tuple[str, str, str, str | None]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {prefix} || '{n}' AS name, "
        + (f"NULL::DOUBLE AS value, {e} AS text, " if u == "text" else f"CAST({e} AS DOUBLE) AS value, NULL::VARCHAR AS text, ")
        + f"'{u}' AS unit, " + (f"'derived' AS class, {f if f.startswith('(') and '||' in f else _quoted(f)} AS formula" if f else "'live' AS class, NULL AS formula")
        + f" FROM {frame}"
        for n, e, u, f in items
    )


_SLUG = "lower(replace(segment, ' ', '_')) || '.'"
_ALL = "(SELECT count(*) AS n, sum(monetary_value) AS r FROM k_segments)"
_SOLD = "(SELECT count(*) AS n, sum(order_value) AS r, sum(order_profit) AS f, max(order_discount_pct) AS x FROM k_curated)"
_PER_SEG = f"(SELECT rfm_segment AS segment, count(*) AS n, sum(monetary_value) AS r, {div('count(*)', '(SELECT count(*) FROM k_segments)')} * 100 AS a, {div('sum(monetary_value)', '(SELECT sum(monetary_value) FROM k_segments)')} * 100 AS b FROM k_segments GROUP BY 1)"
_POOL = f"(SELECT sum(n) AS n, sum(r) AS r, sum(a) AS a, sum(b) AS b FROM {_PER_SEG} WHERE {_RISK})"
_OF_ALL, _OF_BASE = "customers / totals.scored_customers x 100", "lifetime_spend_eur / totals.revenue_base_eur x 100"
add("v8_figures", " UNION ALL ".join([
    _figure("'totals.'", _ALL, [("scored_customers", "n", "count", None), ("revenue_base_eur", "r", "eur", None)]),
    _figure("'totals.'", _SOLD, [("orders", "n", "count", None), ("profit_margin_pct", "100 * CAST(f AS DOUBLE) / CAST(r AS DOUBLE)", "pct", None)]),
    _figure("'segments.' || " + _SLUG, _PER_SEG, [("customers", "n", "count", None), ("customer_share_pct", "a", "pct", _OF_ALL), ("lifetime_spend_eur", "r", "eur", None), ("revenue_share_pct", "b", "pct", _OF_BASE)]),
    _figure("'segments.' || " + _SLUG, "k_margins", [("gross_margin_pct", "100 * gross_margin", "pct", None)]),
    _figure("'win_back.'", _POOL, [("customers", "n", "count", "segments.at_risk.customers + segments.hibernating.customers"), ("customer_share_pct", "a", "pct", _OF_ALL), ("lifetime_spend_eur", "r", "eur", "segments.at_risk.lifetime_spend_eur + segments.hibernating.lifetime_spend_eur"), ("revenue_share_pct", "b", "pct", _OF_BASE)]),
    _figure("'focus.' || " + _SLUG, "k_focus", [
        ("orders", "orders", "count", None), ("revenue_eur", "revenue", "eur", None), ("profit_eur", "profit", "eur", None), ("aov_eur", "aov", "eur", "revenue_eur / orders"),
        ("gross_margin_pct", "100 * gross_margin", "pct", None), ("discount_pct", "100 * CAST(discount_rate AS DOUBLE)", "pct", None), ("kept_pts", "100 * contribution", "pts", "gross_margin_pct - discount_pct"),
        ("mean_realised_discount_pct", "100 * mean4", "pct", None), ("per_euro", _KEPT, "ratio", "kept_pts / discount_pct"), ("per_1000_eur", f"{_KEPT} * 1000", "eur", "per_euro x 1,000"),
        ("per_order_eur", "aov * contribution", "eur", "aov_eur x kept_pts / 100"),
        ("off_list_with_offer_pct", "100 * (1 - (1 - CAST(mean4 AS DOUBLE)) * (1 - CAST(discount_rate AS DOUBLE)))", "pct", "100 x (1 - (1 - mean_realised_discount_pct / 100) x (1 - discount_pct / 100))"),
        ("contact_cost_eur", "aov * contribution / 10.0::DOUBLE", "eur", "per_order_eur / (100 / other.planning_reactivation_rate_pct)"), ("budget_allocation", "budget_allocation", "text", None),
        ("budget_share_pct", "budget_share_pct", "pct", "('the percentage in focus.' || " + _SLUG + " || 'budget_allocation')")]),
    *(_figure(f"'rates.{g}.' || " + _SLUG + " || 'r' || CAST(round(100 * discount_rate) AS INTEGER)", "k_grid", [
        ("", f"contribution_per_eur * {n}", u, f"('(focus.' || {_SLUG} || 'gross_margin_pct - ' || CAST(round(100 * discount_rate) AS INTEGER) || ') / ' || CAST(round(100 * discount_rate) AS INTEGER) || '{x}')"),
    ]) for g, n, u, x in (("per_euro", 1, "ratio", ""), ("per_1000_eur", 1000, "eur", " x 1,000"))),
    _figure("'totals.'", f"(SELECT count(*) FILTER ({_GAP} > 0.001) AS x FROM (SELECT o.order_id, o.order_discount_pct, sum(line_net_amount) AS v, sum(quantity * unit_price) AS l FROM k_orders o JOIN k_items i USING (order_id) GROUP BY 1, 2))",
        [("orders_outside_tolerance", "x", "count", None), ("order_value_tolerance", "0.001", "number", None)]),
    _figure("'ratios.'", f"(SELECT max({_KEPT}) FILTER (segment = 'At Risk') / max({_KEPT}) FILTER (segment = 'Hibernating') AS v FROM k_focus)", [("playbook", "v", "ratio", "focus.at_risk.per_euro / focus.hibernating.per_euro")]),
    _figure("'ratios.'", "(SELECT max(contribution_per_eur) FILTER (segment = 'At Risk') / max(contribution_per_eur) FILTER (segment = 'Hibernating') AS v FROM k_grid WHERE discount_rate = (SELECT min(discount_rate) FROM k_playbook))", [("common", "v", "ratio", "('rates.per_euro.at_risk.r' || (SELECT CAST(round(100 * min(discount_rate)) AS INTEGER) FROM k_playbook) || ' / rates.per_euro.hibernating.r' || (SELECT CAST(round(100 * min(discount_rate)) AS INTEGER) FROM k_playbook) || '; the other playbook rate gives the same ratio at 1 dp')")]),
    _figure("'other.'", _SOLD, [("observed_max_discount_pct", "100 * x", "pct", None), ("planning_reactivation_rate_pct", "10", "pct", None)]),
]), "name:s value:d text:s unit:s class:s formula:s")

add("h1_kpi_primitives", "SELECT * FROM k_kpi", "total_revenue:d total_profit:d distinct_customers:i distinct_orders:i grain_parity:i")
add("h2_kpi_derived", f"SELECT {rdiv('total_revenue', 'distinct_orders', 2)} AS aov, {rdiv('100 * total_profit', 'total_revenue', 2)} AS margin_pct FROM k_kpi", "aov:d margin_pct:d")
_SNAP = lambda f: f"SELECT sum(order_value) AS r, sum(order_profit) AS p, count(DISTINCT customer_id) AS c, count(*) AS o FROM k_curated, k_cutoff WHERE {f}"
_KPIS = (("total_revenue", "currency", "r"), ("total_profit", "currency", "p"), ("distinct_customers", "count", "c"), ("distinct_orders", "count", "o"), ("grain_parity", "grain", "0"),
         ("aov", "currency", rdiv("r", "o", 2)), ("margin_pct", "currency", rdiv("100 * p", "r", 2)))
add("h3_kpi_drift", "SELECT *, baseline <> current AS drift FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS name, '{k}' AS kind, CAST((SELECT {e} FROM ({_SNAP('order_date <= last_day(cutoff_month)')})) AS DOUBLE) AS baseline, CAST((SELECT {e} FROM ({_SNAP('true')})) AS DOUBLE) AS current" for n, k, e in _KPIS) + ")", _DRIFT)

add("h3_baseline_history", "WITH v AS (" + " UNION ALL ".join(
    f"SELECT {i} AS version, '{n}' AS name, '{k}' AS kind, CAST((SELECT {e} FROM ({_SNAP(f)})) AS DOUBLE) AS value"
    for n, k, e in _KPIS for i, f in ((1, "order_date <= last_day(cutoff_month)"), (2, "true"))) +
    ") SELECT v.*, p.value AS previous, coalesce(v.value <> p.value, false) AS drift FROM v LEFT JOIN v p ON p.name = v.name AND p.version = v.version - 1",
    "version:i name:s kind:s previous:d value:d drift:b")

add("x1_order_reconciliation", f"SELECT count(*) AS orders, count(*) FILTER ({_GAP} <= 0.001) AS within_tolerance, count(*) FILTER ({_GAP} > 0.001) AS outside_tolerance FROM (SELECT o.order_id, o.order_discount_pct, sum(line_net_amount) AS v, sum(quantity * unit_price) AS l FROM k_orders o JOIN k_items i USING (order_id) GROUP BY 1, 2)",
    "orders:i within_tolerance:i outside_tolerance:i")
add("x2_shared_order_counts", "SELECT count(*) AS scored_customers, count(*) FILTER (EXISTS (SELECT 1 FROM k_segments b WHERE b.frequency_orders = a.frequency_orders AND b.f_score <> a.f_score)) AS customers_split_across_quintiles FROM k_segments a",
    "scored_customers:i customers_split_across_quintiles:i")
_HASH = "CAST(('0x' || left(md5('42|' || customer_id), 8)) AS BIGINT) / 4294967296.0::DOUBLE"
STEPS["k_pilot"] = f"""
SELECT customer_id, segment, CASE WHEN segment = 'At Risk' THEN CASE WHEN h < 0.5 THEN 'offer_15' ELSE 'holdout' END
    WHEN h < 1.0::DOUBLE / 3 THEN 'offer_20' WHEN h < 2.0::DOUBLE / 3 THEN 'offer_15' ELSE 'holdout' END AS grp
FROM (SELECT customer_id, rfm_segment AS segment, {_HASH} AS h FROM k_segments WHERE rfm_segment IN ('At Risk', 'Hibernating'))"""
STEPS["k_pilot_sums"] = "SELECT segment, grp, count(*) AS n, sum(x) AS x, sum(d) AS d FROM k_pilot_customers GROUP BY 1, 2"
STEPS["k_pilot_customers"] = """
SELECT customer_id, segment, grp, coalesce(p, 0) - rate * coalesce(v, 0) AS x, rate * coalesce(v, 0) AS d
FROM (SELECT *, CASE grp WHEN 'offer_15' THEN 0.15 WHEN 'offer_20' THEN 0.20 ELSE 0 END AS rate FROM k_pilot) g
LEFT JOIN (SELECT customer_id, sum(order_value) AS v, sum(order_profit) AS p FROM k_curated WHERE order_date BETWEEN DATE '2000-08-01' AND DATE '2001-07-31' GROUP BY 1) USING (customer_id)"""
add("x4_pilot_readout", f"""SELECT o.segment, o.grp AS "group", o.n, round({div('o.x', 'o.n')}, 4) AS offer_mean, round({div('h.x', 'h.n')}, 4) AS holdout_mean,
  round({div('o.x', 'o.n')} - {div('h.x', 'h.n')}, 4) AS per_customer, round(CAST(o.d AS DOUBLE), 4) AS discount_spend, round(({div('o.x', 'o.n')} - {div('h.x', 'h.n')}) * o.n / NULLIF(CAST(o.d AS DOUBLE), 0), 8) AS per_euro
  FROM k_pilot_sums o JOIN k_pilot_sums h ON h.segment = o.segment AND h.grp = 'holdout' WHERE o.grp <> 'holdout'""",
    "segment:s group:s n:i offer_mean:d holdout_mean:d per_customer:d discount_spend:d per_euro:d")
_STEPS_AT = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(18)]
_DRAWN = "CAST('0x' || left(md5('42|' || draw || '|' || customer_id), 13) AS BIGINT) / 4503599627370496.0::DOUBLE"
_DRAWS = lambda n: f"""
SELECT draw, segment, grp, sum(w) AS n, sum(w * x) AS x, sum(w * d) AS d FROM (
  SELECT draw, segment, grp, x, d, {' + '.join(f'(u >= {t!r}::DOUBLE)::INTEGER' for t in _STEPS_AT)} AS w
  FROM (SELECT draw, segment, grp, x, d, {_DRAWN} AS u FROM k_pilot_customers, range(1, {n + 1}) r(draw))
) GROUP BY 1, 2, 3"""  # noqa: E731
STEPS["k_drawn"] = _DRAWS(50)
add("x4_pilot_replicates", f"""SELECT o.draw, o.segment, o.grp AS "group", round({div('o.x', 'o.n')} - {div('h.x', 'h.n')}, 6) AS per_customer,
  round(({div('o.x', 'o.n')} - {div('h.x', 'h.n')}) * o.n / NULLIF(CAST(o.d AS DOUBLE), 0), 6) AS per_euro
  FROM k_drawn o JOIN k_drawn h ON h.draw = o.draw AND h.segment = o.segment AND h.grp = 'holdout' WHERE o.grp <> 'holdout'""",
    "draw:i segment:s group:s per_customer:d per_euro:d")
_EFFECT = f"""(SELECT o.segment, o.grp, {div('o.x', 'o.n')} - {div('h.x', 'h.n')} AS c, ({div('o.x', 'o.n')} - {div('h.x', 'h.n')}) * o.n / NULLIF(CAST(o.d AS DOUBLE), 0) AS e
  FROM k_pilot_sums o JOIN k_pilot_sums h ON h.segment = o.segment AND h.grp = 'holdout' WHERE o.grp <> 'holdout')"""
_SIDE = lambda v, s, g: f"max({v}) FILTER (segment = '{s}' AND grp = '{g}')"
_CONTRASTS = (
    ("rate_per_euro", "e", ("Hibernating", "offer_15"), ("Hibernating", "offer_20")), ("rate_per_customer", "c", ("Hibernating", "offer_15"), ("Hibernating", "offer_20")),
    ("priority_at_15", "e", ("At Risk", "offer_15"), ("Hibernating", "offer_15")), ("priority_at_20", "e", ("At Risk", "offer_15"), ("Hibernating", "offer_20")),
)
add("x4_pilot_contrasts", " UNION ALL ".join(
    f"SELECT '{n}' AS contrast, round({_SIDE(v, *a)} - {_SIDE(v, *b)}, 6) AS value FROM {_EFFECT}" for n, v, a, b in _CONTRASTS), "contrast:s value:d")

# Bootstrap intervals: a key is "segment/group" or the name of a contrast.
_MEMBER = lambda a, b: f"bool_or(member) FILTER ((segment, grp) IN (('{a[0]}', '{a[1]}'), ('{b[0]}', '{b[1]}')))"
STEPS["k_thousand"] = _DRAWS(1000)
STEPS["k_effects"] = f"""SELECT o.draw, o.segment, o.grp, {div('o.x', 'o.n')} - {div('h.x', 'h.n')} AS c, ({div('o.x', 'o.n')} - {div('h.x', 'h.n')}) * o.n / NULLIF(CAST(o.d AS DOUBLE), 0) AS e
  FROM k_thousand o JOIN k_thousand h ON h.draw = o.draw AND h.segment = o.segment AND h.grp = 'holdout' WHERE o.grp <> 'holdout'"""
STEPS["k_boot"] = "SELECT segment || '/' || grp AS key, e AS v FROM k_effects" + "".join(
    f" UNION ALL SELECT '{n}', {_SIDE(v, *a)} - {_SIDE(v, *b)} FROM k_effects GROUP BY draw" for n, v, a, b in _CONTRASTS)
STEPS["k_points"] = f"SELECT segment || '/' || grp AS key, round(e, 8) AS p FROM {_EFFECT}" + "".join(
    f" UNION ALL SELECT '{n}', round({_SIDE(v, *a)} - {_SIDE(v, *b)}, 6) FROM {_EFFECT}" for n, v, a, b in _CONTRASTS)
# every customer left out once: the effects of the rest
STEPS["k_left"] = f"""SELECT *, c * n / NULLIF(d, 0) AS e FROM (SELECT *, x / NULLIF(n, 0) - xh / NULLIF(nh, 0) AS c FROM (
  SELECT customer_id, o.segment, o.grp, u.segment = o.segment AND u.grp IN (o.grp, 'holdout') AS member,
    CAST(o.n - (u.segment = o.segment AND u.grp = o.grp)::INTEGER AS DOUBLE) AS n, CAST(o.x - CASE WHEN u.segment = o.segment AND u.grp = o.grp THEN u.x ELSE 0 END AS DOUBLE) AS x,
    CAST(o.d - CASE WHEN u.segment = o.segment AND u.grp = o.grp THEN u.d ELSE 0 END AS DOUBLE) AS d,
    CAST(h.n - (u.segment = o.segment AND u.grp = 'holdout')::INTEGER AS DOUBLE) AS nh, CAST(h.x - CASE WHEN u.segment = o.segment AND u.grp = 'holdout' THEN u.x ELSE 0 END AS DOUBLE) AS xh
  FROM k_pilot_customers u, k_pilot_sums o JOIN k_pilot_sums h ON h.segment = o.segment AND h.grp = 'holdout' WHERE o.grp <> 'holdout'))"""
STEPS["k_jack"] = "SELECT segment || '/' || grp AS key, e AS t FROM k_left WHERE member" + "".join(
    f" UNION ALL SELECT '{n}', {_SIDE(v, *a)} - {_SIDE(v, *b)} FROM k_left GROUP BY customer_id HAVING {_MEMBER(a, b)}" for n, v, a, b in _CONTRASTS)
STEPS["k_skews"] = """SELECT key, sum((m - t) ** 3) / NULLIF(6 * sum((m - t) ** 2) ** 1.5, 0) AS a FROM (SELECT key, t, avg(t) OVER (PARTITION BY key) AS m FROM k_jack WHERE t IS NOT NULL) GROUP BY 1"""


def _cdf(x: str) -> str:
    """The series of the normal distribution, double factorials by the gamma function."""
    term = f"exp((2 * k + 1) * ln(greatest(abs({x}), 1e-300)) - (k + 1) * ln(2) - lgamma(k + 1.5) + 0.5 * ln(pi()))"
    return f"(0.5 + sign({x}) * exp(-({x}) * ({x}) / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 120), lambda k: {term})))"


STEPS["k_bias"] = f"""SELECT key, n, a, list_reduce(list_transform(range(0, 40), lambda i: 0.0::DOUBLE), lambda z, i: z - ({_cdf('z')} - share) * sqrt(2 * pi()) * exp(z * z / 2)) AS z0
  FROM (SELECT key, n, a, least(greatest(below / n, 0.5 / n), 1 - 0.5 / n) AS share FROM (
    SELECT b.key, count(*) AS n, any_value(coalesce(s.a, 0)) AS a, count(*) FILTER (v < p) + count(*) FILTER (v = p) / 2 AS below
    FROM k_boot b JOIN k_points q ON q.key = b.key LEFT JOIN k_skews s ON s.key = b.key WHERE v IS NOT NULL AND p IS NOT NULL GROUP BY 1))"""
_Z975 = NormalDist().inv_cdf(0.975)
STEPS["k_ends"] = "SELECT key, n, " + ", ".join(
    f"{_cdf(f'(z0 + (z0 + {z!r}::DOUBLE) / (1 - a * (z0 + {z!r}::DOUBLE)))')} * (n - 1) AS {name}" for name, z in (("low_at", -_Z975), ("high_at", _Z975))) + " FROM k_bias"
_BETWEEN = lambda at: f"max(v) FILTER (place = floor({at}) + 1) + (max(v) FILTER (place = least(floor({at}) + 2, n)) - max(v) FILTER (place = floor({at}) + 1)) * (any_value({at}) - floor(any_value({at})))"
STEPS["k_intervals"] = f"""SELECT key, {_BETWEEN('low_at')} AS lower, {_BETWEEN('high_at')} AS upper
  FROM (SELECT key, v, row_number() OVER (PARTITION BY key ORDER BY v) AS place FROM k_boot WHERE v IS NOT NULL) JOIN k_ends USING (key) GROUP BY 1"""
add("x4_pilot_intervals", f"""SELECT r.*, round(lower, 6) AS lower, round(upper, 6) AS upper, CASE WHEN upper < 0 THEN 'stop' WHEN lower > 0 THEN 'above break-even' ELSE 'unresolved' END AS verdict
  FROM ({ORACLES['x4_pilot_readout'][0]}) r LEFT JOIN k_intervals i ON i.key = r.segment || '/' || r."group\"""",
    "segment:s group:s n:i offer_mean:d holdout_mean:d per_customer:d discount_spend:d per_euro:d lower:d upper:d verdict:s")
add("x4_pilot_decisions", f"""SELECT r.contrast, r.value, round(lower, 6) AS lower, round(upper, 6) AS upper, coalesce(lower > 0, false) AS decided
  FROM ({ORACLES['x4_pilot_contrasts'][0]}) r LEFT JOIN k_intervals i ON i.key = r.contrast""", "contrast:s value:d lower:d upper:d decided:b")
add("p10_items_display", """SELECT order_id AS "Order ID", product_id AS "Product ID", customer_id AS "Customer ID", order_date AS "Order Date", quantity AS "Quantity", line_net_amount AS "Line Net Amount",
  line_profit AS "Line Profit", line_margin_pct AS "Line Margin %" FROM k_lines""",
    "Order_ID:s Product_ID:s Customer_ID:s Order_Date:s Quantity:i Line_Net_Amount:d Line_Profit:d Line_Margin_%:d")
add("x3_cohort_rebound", "SELECT y AS cohort_year, o AS october_rate, n AS november_rate, (n - o) * 100 AS rebound_points FROM (SELECT year(cohort_month) AS y, max(retention_rate) FILTER (month(cohort_month) = 10) AS o, max(retention_rate) FILTER (month(cohort_month) = 11) AS n FROM k_retention WHERE months_since_acquisition = 1 AND month(cohort_month) IN (10, 11) GROUP BY 1)",
    "cohort_year:i october_rate:d november_rate:d rebound_points:d")
add("x3_dilution_correlation", f"""SELECT count(*) AS cohorts, round(corr(retention_rate, b), 6) AS pearson_r FROM (SELECT r.retention_rate, {div('rep', 'base')} AS b FROM k_retention r,
  LATERAL (SELECT count(*) AS rep FROM k_curated s JOIN k_first f USING (customer_id) WHERE date_trunc('month', s.order_date)::DATE = (r.cohort_month + INTERVAL 1 MONTH)::DATE AND f.cohort_month < date_trunc('month', s.order_date)) x,
  LATERAL (SELECT count(*) AS base FROM k_first f WHERE f.cohort_month < (r.cohort_month + INTERVAL 1 MONTH)::DATE) y WHERE r.months_since_acquisition = 1)""", "cohorts:i pearson_r:d")


_TYPES = {"s": "VARCHAR", "i": "BIGINT", "d": "DOUBLE", "b": "BOOLEAN"}


def _needed(text: str, seen: list[str]) -> None:
    for name in STEPS:
        if name not in seen and re.search(rf"\b{name}\b", text):
            _needed(STEPS[name], seen)
            seen.append(name)


def sql_of(name: str) -> str:
    body, columns = ORACLES[name]
    steps: list[str] = []
    _needed(body, steps)
    spaced = name == "p10_items_display"  # its names contain spaces
    pairs = [x.split(":") for x in columns.split()]
    out = ", ".join(
        f'CAST("{c}" AS {_TYPES[t]}) AS "{c}"'
        for c, t in ((c.replace("_", " ") if spaced else c, t) for c, t in pairs)
    )
    head = "WITH " + ", ".join(f"{s} AS MATERIALIZED ({STEPS[s]})" for s in steps) if steps else ""
    return f"{head}\nSELECT {out} FROM ({body}) AS answer"


def all_oracles() -> dict[str, str]:
    return {name: sql_of(name) for name in ORACLES}
