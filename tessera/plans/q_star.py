"""Registered queries: star schema (T-1..T-8)."""

from __future__ import annotations

from tessera.plans import warehouse as W
from tessera.plans.registry import query
from tessera.sources.fixtures import commerce_sources

YMD = "'%Y%m%d'"


def raw(spark, sf_dir):
    return commerce_sources(spark, sf_dir)


def _day_key(expr: str) -> str:
    return f"strftime(CAST({expr} AS DATE), {YMD})"


def _money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DOUBLE)"


# The date keys of text columns are set only for orders that reached the customer.
_REACHED_KEYS = ",\n  ".join(
    f"CASE WHEN reached AND {c} <> '' THEN {_day_key(f'CAST({c} AS TIMESTAMP)')} END AS fk_{k}_date_sid"
    for c, k in (("order_approved_at", "order_approved_at"), ("order_delivered_carrier_date", "order_delivered_carrier"), ("order_delivered_customer_date", "order_delivered_customer")))
_TEXT_TIMES = ",\n  ".join(f"try_strptime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"))

# Order header from named facts: what was paid, what was ordered, what is
# still due; the payment status is looked up from these in a rule table in
# which an empty field fits anything.
DIM_ORDERS_SQL = f"""
WITH paid_by_order AS (FROM x_payments SELECT order_id, sum(payment_value) AS paid GROUP BY ALL),
ordered AS (FROM x_items SELECT order_id, sum(price) AS goods, sum(freight_value) AS freight GROUP BY ALL),
facts AS (
  SELECT *, goods + freight AS bill, goods + freight - paid AS due,
    coalesce(paid > 0, FALSE) AS has_payment,
    CASE WHEN goods IS NULL THEN 'none' WHEN goods > 0 THEN 'some' END AS goods_found,
    goods + freight > paid AS is_due,
    order_delivered_customer_date IS NOT NULL AS reached
  FROM x_orders LEFT JOIN paid_by_order USING (order_id) LEFT JOIN ordered USING (order_id)),
rules(needs_payment, needs_goods, needs_due, needs_status, payment_status) AS (VALUES
  (TRUE, 'some', FALSE, NULL, 'completed'),
  (TRUE, 'some', TRUE, NULL, 'in progress'),
  (TRUE, 'none', NULL, NULL, 'order items not found'),
  (FALSE, NULL, NULL, 'delivered', 'payments not found'),
  (FALSE, NULL, NULL, 'shipped', 'payments not found'),
  (FALSE, NULL, NULL, 'canceled', 'canceled'),
  (FALSE, NULL, NULL, 'unavailable', 'canceled'))
SELECT order_id AS pk_order_sid, customer_id AS fk_customer_sid, order_status, payment_status,
  {_day_key('order_purchase_timestamp')} AS fk_order_purchased_date_sid,
  {_day_key('order_estimated_delivery_date')} AS fk_order_estimated_delivery_date_sid,
  {_REACHED_KEYS},
  {_money('paid')} AS total_payment, {_money('goods')} AS order_amt, {_money('freight')} AS freight_amt,
  {_money('bill')} AS total_order_amt_wf_freight, {_money('due')} AS balance_amt,
  order_purchase_timestamp, order_estimated_delivery_date,
  {_TEXT_TIMES}
FROM facts LEFT JOIN rules
  ON has_payment = needs_payment AND coalesce(goods_found = needs_goods, needs_goods IS NULL)
  AND coalesce(is_due = needs_due, needs_due IS NULL) AND coalesce(order_status = needs_status, needs_status IS NULL)"""

CUSTOMERS_SQL = """
SELECT customer_id AS pk_customer_sid, customer_unique_id,
  lpad(CAST(customer_zip_code_prefix AS VARCHAR), 5, '0') AS customer_zip_code_prefix, customer_city, customer_state
FROM x_customers"""

GEOLOCATION_SQL = """
SELECT DISTINCT lpad(CAST(geolocation_zip_code_prefix AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
  geolocation_lat, geolocation_lng, geolocation_city, geolocation_state
FROM x_geo"""

ITEMS_SQL = f"""
SELECT i.order_id AS fk_order_sid, i.order_id AS pk_order_id, CAST(i.order_item_id AS VARCHAR) AS pk_order_item_id,
  strftime(i.shipping_limit_date, {YMD}) AS fk_shipping_limit_date_sid, i.product_id, i.seller_id,
  i.shipping_limit_date, CAST(i.price AS DOUBLE) AS price, CAST(i.freight_value AS DOUBLE) AS freight_value,
  p.product_category_name, c.product_category_name_english,
  p.product_name_lenght AS product_name_length, p.product_description_lenght AS product_description_length,
  p.product_photos_qty, p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
  lpad(CAST(s.seller_zip_code_prefix AS VARCHAR), 5, '0') AS seller_zip_code_prefix, s.seller_city, s.seller_state
FROM x_items i
LEFT JOIN x_products p ON i.product_id = p.product_id
LEFT JOIN x_translation c ON p.product_category_name = c.product_category_name
LEFT JOIN x_sellers s ON i.seller_id = s.seller_id"""


@query("dim_orders", DIM_ORDERS_SQL)
def q_dim_orders(spark, sf_dir):
    r = raw(spark, sf_dir)
    return W.dim_orders(r.orders, r.order_payments, r.order_items, with_load_date=False)


@query("dim_customers", CUSTOMERS_SQL)
def q_dim_customers(spark, sf_dir):
    return W.dim_customers(raw(spark, sf_dir).customers, with_load_date=False)


DIM_DATE_SQL = f"""
SELECT strftime(d, {YMD}) AS pk_date_sid, d AS full_date, CAST(year(d) AS INTEGER) AS year,
  CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name, CAST(day(d) AS INTEGER) AS day_of_month,
  strftime(d, '%A') AS day_name, CASE WHEN strftime(d, '%A') IN ('Sunday', 'Saturday') THEN 0 ELSE 1 END AS is_weekday
FROM (SELECT CAST(unnest(generate_series(make_date(year(MIN(x)), 1, 1), make_date(year(MAX(x)), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT unnest([TRY_CAST(order_purchase_timestamp AS DATE), TRY_CAST(order_approved_at AS DATE), TRY_CAST(order_delivered_carrier_date AS DATE),
                           TRY_CAST(order_delivered_customer_date AS DATE), TRY_CAST(order_estimated_delivery_date AS DATE)]) AS x FROM x_orders
            UNION ALL SELECT CAST(shipping_limit_date AS DATE) FROM x_items
            UNION ALL SELECT CAST(review_creation_date AS DATE) FROM x_reviews) r) g"""


@query("dim_date", DIM_DATE_SQL)
def q_dim_date(spark, sf_dir):
    return star(spark, sf_dir)["dim_date"]


@query("dim_geolocation", GEOLOCATION_SQL)
def q_dim_geolocation(spark, sf_dir):
    return W.dim_geolocation(raw(spark, sf_dir).geolocation, with_load_date=False)


@query("fct_order_items", ITEMS_SQL)
def q_fct_order_items(spark, sf_dir):
    r = raw(spark, sf_dir)
    return W.fct_order_items(r.order_items, r.products, r.product_category_name_translation, r.sellers,
                             with_load_date=False)


@query("fct_payments", """
SELECT order_id AS fk_order_sid, order_id AS pk_order_id, payment_sequential AS pk_payment_sequential,
  payment_type, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value
FROM x_payments""")
def q_fct_payments(spark, sf_dir):
    return W.fct_payments(raw(spark, sf_dir).order_payments, with_load_date=False)


@query("fct_reviews", f"""
SELECT order_id AS fk_order_sid, order_id AS pk_order_id, review_id AS pk_review_id,
  strftime(review_creation_date, {YMD}) AS fk_review_creation_date_sid, review_score,
  review_comment_title, review_comment_message, review_creation_date, review_answer_timestamp
FROM x_reviews""")
def q_fct_reviews(spark, sf_dir):
    return W.fct_reviews(raw(spark, sf_dir).order_reviews, with_load_date=False)


def _seed_values_sql() -> str:
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    rows = ",\n  ".join("(" + ", ".join(q(v) for v in r) + ")" for r in W.STATUS_SEED)
    return f"(VALUES\n  {rows}) AS s({', '.join(W.STATUS_SEED_COLUMNS)})"


def initcap_sql(col: str) -> str:
    return (f"array_to_string(list_transform(string_split({col}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


STATUS_SUMMARY_SQL = f"""
WITH dorders AS ({DIM_ORDERS_SQL}),
counts AS (SELECT order_status, payment_status, COUNT(*) AS n_orders FROM dorders GROUP BY order_status, payment_status),
seed AS (SELECT * FROM {_seed_values_sql()})
SELECT c.order_status, c.payment_status, c.n_orders, s.profit_lost, s.status_description
FROM counts c LEFT JOIN seed s
  ON {initcap_sql('c.order_status')} = s.order_status AND {initcap_sql('c.payment_status')} = s.payment_status"""


@query("status_summary", STATUS_SUMMARY_SQL)
def q_status_summary(spark, sf_dir):
    r = raw(spark, sf_dir)
    orders = W.dim_orders(r.orders, r.order_payments, r.order_items, with_load_date=False)
    return W.status_summary(orders, W.status_seed(spark))


def star(spark, sf_dir):
    """The star-schema tables over the fixtures, without ``load_date``."""
    return W.build_star(raw(spark, sf_dir), with_load_date=False)


# Star-schema tables as oracle CTEs (referenced by name from other queries).
STAR_SQL = {
    "s_dim_orders": DIM_ORDERS_SQL,
    "s_dim_customers": CUSTOMERS_SQL,
    "s_dim_geo": GEOLOCATION_SQL,
    "s_land": """
SELECT * FROM s_dim_geo WHERE geolocation_lat BETWEEN -34.0 AND 5.0 AND geolocation_lng BETWEEN -74.0 AND -34.0""",
    "s_fct_items": ITEMS_SQL,
    "s_full_profits": """
SELECT o.*, a.fk_order_sid, m.product_category_name_english, CAST(a._price AS DOUBLE) AS price,
  CAST(CAST(o.total_payment AS DECIMAL(18,2)) - a._price AS DOUBLE) AS profit
FROM s_dim_orders o
LEFT JOIN (SELECT fk_order_sid, SUM(CAST(price AS DECIMAL(18,2))) AS _price FROM s_fct_items GROUP BY fk_order_sid) a
  ON o.pk_order_sid = a.fk_order_sid
LEFT JOIN (SELECT fk_order_sid, product_category_name_english FROM (
    SELECT fk_order_sid, product_category_name_english,
      row_number() OVER (PARTITION BY fk_order_sid ORDER BY COUNT(*) DESC, product_category_name_english) AS rn
    FROM s_fct_items WHERE product_category_name_english IS NOT NULL
    GROUP BY fk_order_sid, product_category_name_english) z WHERE rn = 1) m
  ON o.pk_order_sid = m.fk_order_sid""",
}


def pct_sql(u: str, n: str) -> str:
    """100·u/n as DOUBLE (0 when n = 0), evaluated like the Spark side."""
    return f"CASE WHEN {n} > 0 THEN CAST(100.0 AS DOUBLE) * {u} / {n} ELSE CAST(0.0 AS DOUBLE) END"
