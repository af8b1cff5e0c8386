"""Registered queries: feature tables and commerce analyses (T-9..T-15)."""

from __future__ import annotations

from tessera.plans import features as FE
from tessera.plans.q_star import STAR_SQL, star
from tessera.plans.registry import query

PERIOD = ("1997-10-01", "1998-01-31")

MINUTES = "(epoch_us(CAST({a} AS TIMESTAMP)) - epoch_us(CAST({b} AS TIMESTAMP))) / CAST(60000000 AS DOUBLE)"


@query("ds_orders_delivery", f"""
SELECT *, {MINUTES.format(a='order_delivered_customer_date', b='order_purchase_timestamp')} AS actual_delivery_time_minutes,
  {MINUTES.format(a='order_estimated_delivery_date', b='order_purchase_timestamp')} AS estimated_delivery_time_minutes
FROM s_dim_orders WHERE order_status = 'delivered'""", extra=STAR_SQL)
def q_ds_orders_delivery(spark, sf_dir):
    return FE.ds_orders_delivery(star(spark, sf_dir)["dim_orders"])


_TARGETS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]


@query("delivered_missing_dates", " UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", CAST(SUM(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS null_count, 100.0::DOUBLE * SUM(CASE WHEN {c} THEN 1 ELSE 0 END) / COUNT(*) AS null_percent "
    "FROM s_dim_orders WHERE order_status = 'delivered'" for n, c in [*[(t, f"{t} IS NULL") for t in _TARGETS], ("any of these", " OR ".join(f"{t} IS NULL" for t in _TARGETS))]),
    extra=STAR_SQL)
def q_delivered_missing_dates(spark, sf_dir):
    """V-11: dates that delivered orders lack."""
    return FE.missing_target_dates(FE.ds_orders_delivery(star(spark, sf_dir)["dim_orders"]))


@query("delivered_without_date", f"""
SELECT *, {MINUTES.format(a='order_delivered_customer_date', b='order_purchase_timestamp')} AS actual_delivery_time_minutes,
  {MINUTES.format(a='order_estimated_delivery_date', b='order_purchase_timestamp')} AS estimated_delivery_time_minutes
FROM s_dim_orders WHERE order_status = 'delivered' AND order_approved_at IS NULL""", extra=STAR_SQL)
def q_delivered_without_date(spark, sf_dir):
    return FE.delivered_without_date(FE.ds_orders_delivery(star(spark, sf_dir)["dim_orders"]), "order_approved_at")


def _full_profits(spark, sf_dir):
    s = star(spark, sf_dir)
    return FE.ds_orders_full_profits(s["dim_orders"], s["fct_order_items"])


@query("ds_orders_full_profits", "SELECT * FROM s_full_profits", extra=STAR_SQL)
def q_ds_orders_full_profits(spark, sf_dir):
    return _full_profits(spark, sf_dir)


@query("ds_land_geolocation", "SELECT * FROM s_land", extra=STAR_SQL)
def q_ds_land_geolocation(spark, sf_dir):
    return FE.ds_land_geolocation(star(spark, sf_dir)["dim_geolocation"])


MONTHLY_SQL = """
SELECT c.customer_city, strftime(o.order_purchase_timestamp, '%Y-%m') AS year_month,
  CAST(COALESCE(SUM(CAST(o.total_payment AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_payment
FROM s_dim_orders o LEFT JOIN s_dim_customers c ON o.fk_customer_sid = c.pk_customer_sid
WHERE c.customer_city IS NOT NULL
GROUP BY c.customer_city, strftime(o.order_purchase_timestamp, '%Y-%m')"""

EXTRA = dict(STAR_SQL, s_monthly=MONTHLY_SQL, s_top_cities="""
SELECT customer_city, CAST(t AS DOUBLE) AS total_payment,
  CAST(row_number() OVER (ORDER BY t DESC, customer_city) AS INTEGER) AS rank
FROM (SELECT customer_city, SUM(CAST(total_payment AS DECIMAL(18,2))) AS t FROM s_monthly GROUP BY customer_city) g
QUALIFY rank <= 5""")


def _monthly(spark, sf_dir):
    s = star(spark, sf_dir)
    return FE.monthly_city_sales(s["dim_orders"], s["dim_customers"])


@query("monthly_city_sales", "SELECT * FROM s_monthly", extra=EXTRA)
def q_monthly_city_sales(spark, sf_dir):
    return _monthly(spark, sf_dir)


@query("top_cities", "SELECT * FROM s_top_cities", extra=EXTRA)
def q_top_cities(spark, sf_dir):
    return FE.top_cities(_monthly(spark, sf_dir), 5)


@query("city_month_pivot", "SELECT m.year_month, " + ", ".join(
    f"MAX(CASE WHEN t.rank = {i} THEN m.total_payment END) AS top{i}" for i in range(1, 6))
    + " FROM s_monthly m JOIN s_top_cities t ON m.customer_city = t.customer_city GROUP BY m.year_month",
    extra=EXTRA)
def q_city_month_pivot(spark, sf_dir):
    return FE.city_month_pivot(_monthly(spark, sf_dir), 5)


DAILY_SQL = f"""
SELECT CAST(order_purchase_timestamp AS DATE) AS order_purchase_date,
  CAST(COALESCE(SUM(CAST(total_payment AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_payment
FROM s_dim_orders
WHERE order_status = 'delivered' AND order_purchase_timestamp >= TIMESTAMP '{PERIOD[0]}'
  AND order_purchase_timestamp < TIMESTAMP '{PERIOD[1]}' + INTERVAL 1 DAY
GROUP BY CAST(order_purchase_timestamp AS DATE)"""


@query("daily_sales", DAILY_SQL, extra=STAR_SQL)
def q_daily_sales(spark, sf_dir):
    return FE.daily_sales(star(spark, sf_dir)["dim_orders"], *PERIOD)


@query("mean_daily_sales", f"""
SELECT CAST(SUM(CAST(total_payment AS DECIMAL(18,2))) AS DOUBLE) / (datediff('day', DATE '{PERIOD[0]}', DATE '{PERIOD[1]}') + 1)
    AS mean_daily_sales,
  arg_max(order_purchase_date, (total_payment, -datediff('day', DATE '{PERIOD[0]}', order_purchase_date))) AS peak_day,
  MAX(total_payment) AS peak_sales,
  CAST(datediff('day', DATE '{PERIOD[0]}', DATE '{PERIOD[1]}') + 1 AS INTEGER) AS n_days
FROM ({DAILY_SQL}) d""", extra=STAR_SQL)
def q_mean_daily_sales(spark, sf_dir):
    return FE.mean_daily_sales(star(spark, sf_dir)["dim_orders"], *PERIOD)


@query("geo_sales", """
WITH cent AS (
  SELECT geolocation_zip_code_prefix, ROUND(AVG(geolocation_lat) + 1e-9, 6) AS geolocation_lat,
    ROUND(AVG(geolocation_lng) + 1e-9, 6) AS geolocation_lng
  FROM s_land GROUP BY geolocation_zip_code_prefix),
wz AS (
  SELECT o.total_payment, c.customer_zip_code_prefix
  FROM (SELECT fk_customer_sid, total_payment FROM s_dim_orders WHERE order_status = 'delivered') o
  LEFT JOIN s_dim_customers c ON o.fk_customer_sid = c.pk_customer_sid)
SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, total_payment, ROUND(ln(1 + total_payment) + 1e-9, 9) AS log_total_payment
FROM (SELECT cent.geolocation_zip_code_prefix, ANY_VALUE(cent.geolocation_lat) AS geolocation_lat, ANY_VALUE(cent.geolocation_lng) AS geolocation_lng,
        CAST(COALESCE(SUM(CAST(wz.total_payment AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_payment
      FROM wz JOIN cent ON wz.customer_zip_code_prefix = cent.geolocation_zip_code_prefix
      GROUP BY cent.geolocation_zip_code_prefix) g""", extra=STAR_SQL)
def q_geo_sales(spark, sf_dir):
    s = star(spark, sf_dir)
    return FE.geo_sales(s["dim_orders"], s["dim_customers"], FE.ds_land_geolocation(s["dim_geolocation"]))


@query("category_profit_top10", """
SELECT product_category_name_english, CAST(p AS DOUBLE) AS profit,
  CAST(row_number() OVER (ORDER BY p DESC, product_category_name_english) AS INTEGER) AS rank
FROM (SELECT product_category_name_english, COALESCE(SUM(CAST(profit AS DECIMAL(18,2))), 0) AS p
      FROM s_full_profits WHERE product_category_name_english IS NOT NULL GROUP BY product_category_name_english) g
QUALIFY rank <= 10""", extra=STAR_SQL)
def q_category_profit_top10(spark, sf_dir):
    return FE.category_profit_top(_full_profits(spark, sf_dir), 10)


# ---- projections / filters / ordering registered on their own (P-1, P-9, P-11, P-15, P-18, O-4, A-6)

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import filters as FL  # noqa: E402
from tessera.operators import joins as J  # noqa: E402
from tessera.operators import stats as ST  # noqa: E402
from tessera.sources.catalog import Sources  # noqa: E402


@query("select_as", """
SELECT order_id AS fk_order_sid, order_id AS pk_order_id, payment_sequential AS pk_payment_sequential FROM x_payments""")
def q_select_as(spark, sf_dir):
    from tessera.plans.q_star import raw
    return FL.select_as(raw(spark, sf_dir).order_payments,
                        [("fk_order_sid", "order_id"), ("pk_order_id", "order_id"),
                         ("pk_payment_sequential", "payment_sequential")])


@query("contains_ci", "SELECT p_partkey, p_name FROM part WHERE COALESCE(lower(p_name) LIKE '%ring%', FALSE)")
def q_contains_ci(spark, sf_dir):
    return FL.contains_ci(Sources.parquet_dir(spark, sf_dir).part.select("p_partkey", "p_name"), "p_name", "RING")


@query("last_n_days", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) >= (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 730 DAY""")
def q_last_n_days(spark, sf_dir):
    o = Sources.parquet_dir(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    return FL.last_n_days(o, "o_orderdate", 730)


@query("slice_rows", """
SELECT o_orderkey, o_orderpriority, o_orderdate FROM (
  SELECT o_orderkey, o_orderpriority, o_orderdate,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS i,
    COUNT(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) z
WHERE i >= n - 30""")
def q_slice_rows(spark, sf_dir):
    o = Sources.parquet_dir(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    return FL.slice_rows(o, ["o_orderdate", "o_orderkey"], -30, None, by=["o_orderpriority"])


@query("semi_join", """
SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_semi_join(spark, sf_dir):
    t = Sources.parquet_dir(spark, sf_dir)
    return J.semi(t.orders, t.customer.filter(F.col("c_mktsegment") == "BUILDING")
                  .select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@query("top_k_rows", "SELECT m.* FROM s_monthly m JOIN s_top_cities t ON m.customer_city = t.customer_city",
       extra=EXTRA)
def q_top_k_rows(spark, sf_dir):
    m = _monthly(spark, sf_dir)
    return FE.top_k_rows(m.withColumn("_m", F.col("total_payment").cast("decimal(18,2)")), "customer_city", "_m", 5) \
        .drop("_m")


@query("modal_category", """
SELECT product_category_name_english FROM s_fct_items WHERE product_category_name_english IS NOT NULL
GROUP BY product_category_name_english ORDER BY COUNT(*) DESC, product_category_name_english LIMIT 1""",
       extra=STAR_SQL)
def q_modal_category(spark, sf_dir):
    return ST.mode_min(star(spark, sf_dir)["fct_order_items"], "product_category_name_english")
