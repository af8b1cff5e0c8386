"""Registered queries: data-quality checks (V-1..V-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.plans.features import LAND_CHECK, ds_land_geolocation
from tessera.plans.q_star import STAR_SQL, pct_sql, raw, star
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.sources.catalog import Sources

RES = '"check", "column", element_count, missing_count, unexpected_count, unexpected_percent, success'


def _labelled(df, label):
    return df.select(F.lit(label).alias("table_name"), *Q.RESULT_COLUMNS)


def _union(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_sql(table: str, label: str, cols: list[str]) -> str:
    keys = ", ".join(cols)
    knull = " OR ".join(f"{c} IS NULL" for c in cols)
    name = "unique" if len(cols) == 1 else "compound_unique"
    return f"""
SELECT '{label}' AS table_name, '{name}' AS "check", '{",".join(cols)}' AS "column",
  CAST(SUM(c) AS BIGINT) AS element_count,
  CAST(SUM(CASE WHEN kn THEN c ELSE 0 END) AS BIGINT) AS missing_count,
  CAST(SUM(CASE WHEN NOT kn THEN c - 1 ELSE 0 END) AS BIGINT) AS unexpected_count,
  {pct_sql('SUM(CASE WHEN NOT kn THEN c - 1 ELSE 0 END)', 'SUM(c)')} AS unexpected_percent,
  SUM(CASE WHEN NOT kn THEN c - 1 ELSE 0 END) = 0 AS success
FROM (SELECT {keys}, COUNT(*) AS c, ({knull}) AS kn FROM {table} GROUP BY {keys}) g"""


def rel_sql(table: str, label: str, col: str, ref: str, ref_col: str) -> str:
    u = f"SUM(CASE WHEN k IS NOT NULL AND hit IS NULL THEN 1 ELSE 0 END)"
    return f"""
SELECT '{label}' AS table_name, 'relationships' AS "check", '{col}->{ref_col}' AS "column",
  CAST(COUNT(*) AS BIGINT) AS element_count,
  CAST(SUM(CASE WHEN k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_count,
  CAST({u} AS BIGINT) AS unexpected_count, {pct_sql(u, 'COUNT(*)')} AS unexpected_percent, {u} = 0 AS success
FROM (SELECT t.{col} AS k, r.hit FROM {table} t
      LEFT JOIN (SELECT DISTINCT {ref_col} AS k2, 1 AS hit FROM {ref}) r ON t.{col} = r.k2) j"""


def fused_sql(table: str, label: str, checks: list[tuple]) -> str:
    """Row-level checks: ('not_null', col) or ('values_between', col, lo, hi)."""
    parts = []
    for c in checks:
        col = c[1]
        miss = f"SUM(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END)"
        if c[0] == "not_null":
            bad, denom = miss, "COUNT(*)"
        else:
            lo, hi = c[2], c[3]
            bad = f"SUM(CASE WHEN {col} IS NOT NULL AND ({col} < {lo} OR {col} > {hi}) THEN 1 ELSE 0 END)"
            denom = f"(COUNT(*) - {miss})"
        parts.append(f"""
SELECT '{label}' AS table_name, '{c[0]}' AS "check", '{col}' AS "column", CAST(COUNT(*) AS BIGINT) AS element_count,
  CAST({miss} AS BIGINT) AS missing_count, CAST({bad} AS BIGINT) AS unexpected_count,
  {pct_sql(bad, denom)} AS unexpected_percent, {bad} = 0 AS success FROM {table}""")
    return "\nUNION ALL ".join(parts)


@query("dq_unique", "\nUNION ALL ".join([
    unique_sql("s_dim_orders", "dim_orders", ["pk_order_sid"]),
    unique_sql("s_dim_customers", "dim_customers", ["pk_customer_sid"]),
    unique_sql("lineitem", "lineitem", ["l_orderkey"]),
]), extra=STAR_SQL)
def q_dq_unique(spark, sf_dir):
    s = star(spark, sf_dir)
    t = Sources.parquet_dir(spark, sf_dir)
    return _union([
        _labelled(Q.unique_check(s["dim_orders"], ["pk_order_sid"]), "dim_orders"),
        _labelled(Q.unique_check(s["dim_customers"], ["pk_customer_sid"]), "dim_customers"),
        _labelled(Q.unique_check(t.lineitem, ["l_orderkey"]), "lineitem"),
    ])


@query("dq_compound_unique", "\nUNION ALL ".join([
    unique_sql("x_items", "order_items", ["order_id", "order_item_id"]),
    unique_sql("x_payments", "order_payments", ["order_id", "payment_sequential"]),
    unique_sql("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
]))
def q_dq_compound_unique(spark, sf_dir):
    r = raw(spark, sf_dir)
    t = r.base
    return _union([
        _labelled(Q.unique_check(r.order_items, ["order_id", "order_item_id"]), "order_items"),
        _labelled(Q.unique_check(r.order_payments, ["order_id", "payment_sequential"]), "order_payments"),
        _labelled(Q.unique_check(t.lineitem, ["l_orderkey", "l_linenumber"]), "lineitem"),
    ])


@query("dq_not_null", fused_sql("x_nulls", "orders_nulls", [
    ("not_null", "o_orderkey"), ("not_null", "o_totalprice"), ("not_null", "o_orderpriority"),
    ("not_null", "c_empty")]))
def q_dq_not_null(spark, sf_dir):
    t = Sources.parquet_dir(spark, sf_dir)
    res = Q.run_suite(X.x_nulls(t), [Q.NotNull("o_orderkey"), Q.NotNull("o_totalprice"),
                                     Q.NotNull("o_orderpriority"), Q.NotNull("c_empty")])
    return _labelled(res, "orders_nulls")


@query("dq_relationships", "\nUNION ALL ".join([
    rel_sql("x_orders", "orders", "customer_id", "x_customers", "customer_id"),
    rel_sql("x_orphans", "orders_orphans", "o_custkey", "customer", "c_custkey"),
    rel_sql("x_items", "order_items", "order_id", "x_orders", "order_id"),
    rel_sql("s_dim_orders", "dim_orders", "fk_customer_sid", "s_dim_customers", "pk_customer_sid"),
]), extra=STAR_SQL)
def q_dq_relationships(spark, sf_dir):
    r = raw(spark, sf_dir)
    t = r.base
    s = star(spark, sf_dir)
    return _union([
        _labelled(Q.relationship_check(r.orders, "customer_id", r.customers, "customer_id"), "orders"),
        _labelled(Q.relationship_check(X.x_orphans(t), "o_custkey", t.customer, "c_custkey"), "orders_orphans"),
        _labelled(Q.relationship_check(r.order_items, "order_id", r.orders, "order_id"), "order_items"),
        _labelled(Q.relationship_check(s["dim_orders"], "fk_customer_sid", s["dim_customers"], "pk_customer_sid"),
                  "dim_orders"),
    ])


def _land(spark, sf_dir):
    return ds_land_geolocation(star(spark, sf_dir)["dim_geolocation"])


GEO_SUITE_SQL = fused_sql("s_land", "land_geolocation", [
    ("values_between", "geolocation_lat", "-35.0", "5.0"),
    ("values_between", "geolocation_lng", "-75.0", "-35.0")])


@query("dq_between", GEO_SUITE_SQL, extra=STAR_SQL)
def q_dq_between(spark, sf_dir):
    land = _land(spark, sf_dir)
    checks = [Q.Between(c, lo, hi) for c, (lo, hi) in LAND_CHECK.items()]
    return _labelled(Q.run_suite(land, checks), "land_geolocation")


def _details_sql(col: str, lo: str, hi: str) -> str:
    bad = f"{col} IS NOT NULL AND ({col} < {lo} OR {col} > {hi})"
    return f"""
SELECT '{col}' AS "column", s.element_count, s.missing_count, s.unexpected_count,
  {pct_sql('s.unexpected_count', 's.element_count')} AS unexpected_percent,
  {pct_sql('s.unexpected_count', '(s.element_count - s.missing_count)')} AS unexpected_percent_nonmissing,
  COALESCE(t.vals, CAST([] AS DOUBLE[])) AS partial_unexpected_list,
  COALESCE(t.cnts, CAST([] AS BIGINT[])) AS partial_unexpected_counts, s.unexpected_count = 0 AS success
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS element_count,
        CAST(SUM(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_count,
        CAST(SUM(CASE WHEN {bad} THEN 1 ELSE 0 END) AS BIGINT) AS unexpected_count FROM s_land) s
LEFT JOIN (SELECT list(value ORDER BY cnt DESC, value) AS vals, list(cnt ORDER BY cnt DESC, value) AS cnts FROM (
    SELECT {col} AS value, CAST(COUNT(*) AS BIGINT) AS cnt FROM s_land WHERE {bad}
    GROUP BY {col} ORDER BY cnt DESC, value LIMIT 20) z) t ON TRUE"""


@query("dq_between_details", _details_sql("geolocation_lng", "-75.0", "-35.0")
       + "\nUNION ALL" + _details_sql("geolocation_lat", "-35.0", "5.0"), extra=STAR_SQL)
def q_dq_between_details(spark, sf_dir):
    land = _land(spark, sf_dir)
    return _union([Q.between_details(land, c, lo, hi) for c, (lo, hi) in
                   [("geolocation_lng", LAND_CHECK["geolocation_lng"]), ("geolocation_lat", LAND_CHECK["geolocation_lat"])]])


@query("dq_suite", f"""
SELECT CAST(COUNT(*) AS BIGINT) AS evaluated_expectations,
  CAST(SUM(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS successful_expectations,
  CAST(SUM(CASE WHEN success THEN 0 ELSE 1 END) AS BIGINT) AS unsuccessful_expectations,
  CAST(100.0 AS DOUBLE) * SUM(CASE WHEN success THEN 1 ELSE 0 END) / COUNT(*) AS success_percent,
  CAST(MIN(CASE WHEN success THEN 1 ELSE 0 END) AS BOOLEAN) AS success
FROM ({GEO_SUITE_SQL}
  UNION ALL SELECT 'land_geolocation', 'column_exists', 'geolocation_zip_code_prefix', NULL, NULL, 0, 0.0, TRUE) r""",
       extra=STAR_SQL)
def q_dq_suite(spark, sf_dir):
    land = _land(spark, sf_dir)
    checks = [Q.Between(c, lo, hi) for c, (lo, hi) in LAND_CHECK.items()]
    checks.append(Q.ColumnExists("geolocation_zip_code_prefix", 0))
    return Q.suite_statistics(Q.run_suite(land, checks))


@query("dq_one_to_one", """
SELECT l.* FROM s_land l
WHERE l.geolocation_zip_code_prefix IN (
  SELECT geolocation_zip_code_prefix FROM s_land GROUP BY geolocation_zip_code_prefix
  HAVING COUNT(DISTINCT geolocation_lat) > 1 OR COUNT(DISTINCT geolocation_lng) > 1)""", extra=STAR_SQL)
def q_dq_one_to_one(spark, sf_dir):
    return Q.one_to_one(_land(spark, sf_dir), "geolocation_zip_code_prefix", ["geolocation_lat", "geolocation_lng"])


def _many_sql(label, table, key, col, n=1):
    return f"""
SELECT '{label}' AS "check", CAST(COUNT(*) AS BIGINT) AS n_keys FROM (
  SELECT {key} FROM {table} GROUP BY {key} HAVING COUNT(DISTINCT {col}) > {n}) g"""


@query("dq_keys_with_many", "\nUNION ALL ".join([
    _many_sql("orders_with_many_items", "s_fct_items", "fk_order_sid", "pk_order_item_id"),
    _many_sql("orders_with_many_categories", "s_fct_items", "fk_order_sid", "product_category_name_english"),
    _many_sql("orders_with_many_sellers", "s_fct_items", "fk_order_sid", "seller_id", 3),
    _many_sql("orders_with_many_customers", "s_dim_orders", "pk_order_sid", "fk_customer_sid"),
]), extra=STAR_SQL)
def q_dq_keys_with_many(spark, sf_dir):
    s = star(spark, sf_dir)
    it, o = s["fct_order_items"], s["dim_orders"]

    def c(label, df, key, col, n=1):
        return Q.count_keys_with_many(df, key, col, n).select(F.lit(label).alias("check"), "n_keys")
    return _union([
        c("orders_with_many_items", it, "fk_order_sid", "pk_order_item_id"),
        c("orders_with_many_categories", it, "fk_order_sid", "product_category_name_english"),
        c("orders_with_many_sellers", it, "fk_order_sid", "seller_id", 3),
        c("orders_with_many_customers", o, "pk_order_sid", "fk_customer_sid"),
    ])
