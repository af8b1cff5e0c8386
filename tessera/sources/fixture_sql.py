"""The raw tables of ``tessera.sources.fixtures`` written in DuckDB SQL.

Used only by the SQL oracle: ``with_fixtures(sql)`` prepends the CTEs a
query mentions (and their dependencies) to an oracle query.
"""

from __future__ import annotations

import re

from tessera.sources.fixtures import CALENDAR_EVENTS, CALENDAR_EVENTS_2, ORDER_STATUS_BY_MOD8, PAYMENT_TYPES, SURVEY_FLAGS


def _status_sql(k: str) -> str:
    arms = " ".join(f"WHEN {k} % 8 = {m} THEN '{s}'" for m, s in ORDER_STATUS_BY_MOD8.items())
    return f"CASE {arms} ELSE 'delivered' END"


def _events_sql(d: str, events) -> str:
    arms = " ".join(
        f"WHEN month({d}) = {m} AND day({d}) = {day} THEN '{name.replace(chr(39), chr(39) * 2)}'"
        for m, day, name in events)
    return f"CASE {arms} END"


def _ptype_sql(k: str) -> str:
    arms = " ".join(f"WHEN {k} % 4 = {i} THEN '{n}'" for i, n in enumerate(PAYMENT_TYPES))
    return f"CASE {arms} END"


def _flag_sql() -> str:
    out = []
    for i, (a, b, thr) in enumerate(SURVEY_FLAGS, start=1):
        v = f"((l_partkey * {a} + l_suppkey * {b}) % 100)"
        out.append(f"CAST(CASE WHEN l_partkey % 200 = 0 THEN 99 WHEN {v} < {thr} THEN 1 "
                   f"WHEN {v} < 97 THEN 2 ELSE {v} END AS BIGINT) AS f{i}")
    return ",\n  ".join(out)


TS = "'%Y-%m-%d %H:%M:%S'"

FIXTURES: dict[str, str] = {
    "x_customers": """
SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_custkey % 500 AS customer_zip_code_prefix,
       n_name AS customer_city, c_mktsegment AS customer_state
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "x_orders": f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, {_status_sql('o_orderkey')} AS order_status,
  o_orderdate AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE strftime(o_orderdate + INTERVAL 1 DAY, {TS}) END AS order_approved_at,
  CASE WHEN o_orderkey % 45 = 0 THEN '' ELSE strftime(o_orderdate + INTERVAL 3 DAY, {TS}) END AS order_delivered_carrier_date,
  CASE WHEN {_status_sql('o_orderkey')} = 'delivered' AND o_orderkey % 40 <> 0
       THEN strftime(o_orderdate + to_days(CAST(5 + o_orderkey % 20 AS INTEGER)), {TS}) END AS order_delivered_customer_date,
  o_orderdate + INTERVAL 15 DAY AS order_estimated_delivery_date
FROM orders""",
    "x_items": """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price,
       CAST(ROUND(price * _tax, 2) AS DECIMAL(18,2)) AS freight_value
FROM (
  SELECT l_orderkey AS order_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         l_quantity, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) AS BIGINT) AS order_item_id,
    l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(18,2)) AS price,
    CAST(l_tax AS DECIMAL(5,2)) AS _tax
  FROM lineitem) li""",
    "x_payments": f"""
SELECT order_id, CAST(seq AS BIGINT) AS payment_sequential, {_ptype_sql('order_id')} AS payment_type,
  CAST(1 + order_id % 6 AS BIGINT) AS payment_installments,
  CAST(CASE WHEN order_id % 10 <> 0 THEN amount
            WHEN seq = 1 THEN CAST(((CAST(amount * 100 AS BIGINT) - CAST(amount * 100 AS BIGINT) % 2) // 2) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
            ELSE amount - CAST(((CAST(amount * 100 AS BIGINT) - CAST(amount * 100 AS BIGINT) % 2) // 2) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))
       END AS DECIMAL(18,2)) AS payment_value
FROM (
  SELECT o.o_orderkey AS order_id,
    CAST(CASE WHEN o.o_orderkey % 5 = 0 THEN COALESCE(t.items_total, CAST(o.o_totalprice AS DECIMAL(18,2))) - 10
              WHEN o.o_orderkey % 7 = 0 THEN COALESCE(t.items_total, CAST(o.o_totalprice AS DECIMAL(18,2))) + 5
              ELSE COALESCE(t.items_total, CAST(o.o_totalprice AS DECIMAL(18,2))) END AS DECIMAL(18,2)) AS amount
  FROM orders o
  LEFT JOIN (SELECT order_id, SUM(price) + SUM(freight_value) AS items_total FROM x_items GROUP BY order_id) t
    ON o.o_orderkey = t.order_id
  WHERE o.o_orderkey % 97 <> 0) a,
  (SELECT unnest([1, 2]) AS seq) s
WHERE seq = 1 OR order_id % 10 = 0""",
    "x_products": """
SELECT p_partkey AS product_id,
  CASE WHEN p_partkey % 30 = 0 THEN NULL ELSE lower(p_type) END AS product_category_name,
  CAST(length(p_name) AS BIGINT) AS product_name_lenght,
  CAST(length(p_brand) * 10 AS BIGINT) AS product_description_lenght,
  CAST(1 + p_size % 5 AS BIGINT) AS product_photos_qty,
  CAST(p_size * 100 AS BIGINT) AS product_weight_g,
  CAST(10 + p_partkey % 40 AS BIGINT) AS product_length_cm,
  CAST(5 + p_partkey % 25 AS BIGINT) AS product_height_cm,
  CAST(8 + p_partkey % 30 AS BIGINT) AS product_width_cm
FROM part""",
    "x_translation": """
SELECT product_category_name, upper(product_category_name) AS product_category_name_english
FROM (SELECT DISTINCT lower(p_type) AS product_category_name FROM part) c
WHERE product_category_name <> 'promo'""",
    "x_sellers": """
SELECT s_suppkey AS seller_id, s_suppkey * 37 AS seller_zip_code_prefix, n_name AS seller_city,
       'S' || CAST(s_nationkey % 5 AS VARCHAR) AS seller_state
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "x_reviews": """
SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS review_id, o_orderkey AS order_id,
  CAST(1 + o_orderkey % 5 AS BIGINT) AS review_score,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'title ' || CAST(o_orderkey % 5 AS VARCHAR) END AS review_comment_title,
  CASE WHEN o_orderkey % 11 = 0 THEN 'line one' || chr(10) || 'line two' || chr(13) || chr(10) || 'end'
       ELSE 'fine ' || CAST(o_orderkey AS VARCHAR) END AS review_comment_message,
  o_orderdate + INTERVAL 10 DAY AS review_creation_date,
  o_orderdate + INTERVAL 12 DAY AS review_answer_timestamp
FROM orders""",
    "x_geo": """
SELECT c_custkey % 500 AS geolocation_zip_code_prefix,
  -40.0 + CAST((c_custkey * 37) % 5000 AS DOUBLE) / CAST(100 AS DOUBLE) AS geolocation_lat,
  -80.0 + CAST((c_custkey * 53) % 5000 AS DOUBLE) / CAST(100 AS DOUBLE) AS geolocation_lng,
  lower(c_mktsegment) AS geolocation_city, 'S' || CAST(c_nationkey % 5 AS VARCHAR) AS geolocation_state
FROM (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
      UNION ALL SELECT c_custkey, c_mktsegment, c_nationkey FROM customer) c""",
    "x_calendar": f"""
SELECT 'd_' || CAST(datediff('day', s, date) + 1 AS VARCHAR) AS d, date,
  CASE WHEN day(date) <= 10 THEN 1 ELSE 0 END AS snap_A,
  CASE WHEN day(date) BETWEEN 5 AND 14 THEN 1 ELSE 0 END AS snap_B,
  {_events_sql('date', CALENDAR_EVENTS)} AS event_name_1,
  {_events_sql('date', CALENDAR_EVENTS_2)} AS event_name_2
FROM (SELECT s, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT make_date(year(MIN(o_orderdate)), 1, 1) AS s, make_date(year(MAX(o_orderdate)), 12, 31) AS e
            FROM orders) r) g""",
    "x_survey": f"""
SELECT CAST(l_quantity AS BIGINT) AS age, CAST(l_linenumber AS BIGINT) AS clasiffication_final,
  CAST(1 + l_suppkey % 2 AS BIGINT) AS sex,
  CASE WHEN l_returnflag = 'R' THEN strftime(l_shipdate, '%d/%m/%Y')
       WHEN l_returnflag = 'A' AND l_partkey % 50 = 0 THEN NULL ELSE '9999-99-99' END AS date_died,
  {_flag_sql()}
FROM lineitem""",
    "x_scores": """
SELECT l_discount AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem""",
    "x_fraud": "SELECT vec_id AS id, " + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS v{i}" for i in range(64))
    + ", CASE WHEN label = 0 THEN 1 ELSE 0 END AS Class FROM embeddings",
    "x_nulls": """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CAST(NULL AS DOUBLE) AS c_empty, 1.0::DOUBLE AS c_const
FROM orders""",
    "x_orphans": """
SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS o_custkey,
  o_orderstatus, o_totalprice, o_orderdate
FROM orders""",
}


def with_fixtures(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prepend the fixture (and ``extra``) CTEs referenced by ``sql``.

    Extra CTEs may reference fixtures and each other; order of ``extra`` is
    kept, fixtures come first in dependency order.
    """
    defs = dict(FIXTURES)
    extra = dict(extra or {})
    defs.update(extra)
    needed: list[str] = []

    def visit(text: str):
        for name in defs:
            if name in needed:
                continue
            if re.search(rf"\b{name}\b", text):
                visit(defs[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({defs[n]}\n)" for n in needed)
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
