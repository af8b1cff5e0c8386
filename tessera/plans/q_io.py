"""Registered queries: sources/sinks (S2, S6, S14) and the model data tests (T-20 stage 3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.plans.pipeline import REFERENCES, data_tests
from tessera.plans.q_quality import fused_sql, rel_sql, unique_sql
from tessera.plans.q_star import DIM_DATE_SQL, STAR_SQL, raw, star
from tessera.plans.registry import query
from tessera.sources import io
from tessera.sources.catalog import Sources
from tessera.session import ensure_checkpoint_dir


@query("preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_preview(spark, sf_dir):
    return io.preview(Sources.parquet_dir(spark, sf_dir).orders, 5, "o_orderkey")


@query("clean_newlines", """
SELECT review_id, order_id, review_score, translate(review_comment_title, chr(13) || chr(10), '  ') AS review_comment_title,
  translate(review_comment_message, chr(13) || chr(10), '  ') AS review_comment_message,
  review_creation_date, review_answer_timestamp FROM x_reviews""")
def q_clean_newlines(spark, sf_dir):
    return io.clean_newlines(raw(spark, sf_dir).order_reviews)


@query("flatten_structs", """
SELECT n.n_nationkey, n.n_name, r.r_regionkey AS region_r_regionkey, r.r_name AS region_r_name
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_flatten_structs(spark, sf_dir):
    t = Sources.parquet_dir(spark, sf_dir)
    nested = t.nation.join(t.region, t.nation.n_regionkey == t.region.r_regionkey, "left").select(
        "n_nationkey", "n_name", F.when(F.col("r_regionkey").isNotNull(),
                                        F.struct("r_regionkey", "r_name")).alias("region"))
    return io.land_raw(nested, "public-nation")


FCT_EXTRA = dict(STAR_SQL, s_fct_payments="""
SELECT order_id AS fk_order_sid, order_id AS pk_order_id, payment_sequential AS pk_payment_sequential,
  payment_type, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value FROM x_payments""",
                 s_fct_reviews="""
SELECT order_id AS fk_order_sid, order_id AS pk_order_id, review_id AS pk_review_id,
  strftime(review_creation_date, '%Y%m%d') AS fk_review_creation_date_sid FROM x_reviews""",
                 s_dim_date=DIM_DATE_SQL)
ORACLE_TABLES = {"dim_customers": "s_dim_customers", "dim_orders": "s_dim_orders", "dim_date": "s_dim_date",
                 "fct_order_items": "s_fct_items", "fct_payments": "s_fct_payments", "fct_reviews": "s_fct_reviews"}


@query("model_tests", "\nUNION ALL ".join([
    fused_sql("s_dim_customers", "dim_customers", [("not_null", "pk_customer_sid")]),
    unique_sql("s_dim_customers", "dim_customers", ["pk_customer_sid"]),
    fused_sql("s_fct_items", "fct_order_items", [("not_null", "pk_order_id"), ("not_null", "pk_order_item_id")]),
    unique_sql("s_fct_items", "fct_order_items", ["pk_order_id", "pk_order_item_id"]),
    fused_sql("s_fct_reviews", "fct_reviews", [("not_null", "pk_order_id"), ("not_null", "pk_review_id")]),
    unique_sql("s_fct_reviews", "fct_reviews", ["pk_order_id", "pk_review_id"]),
    fused_sql("s_fct_payments", "fct_payments", [("not_null", "pk_order_id"), ("not_null", "pk_payment_sequential")]),
    unique_sql("s_fct_payments", "fct_payments", ["pk_order_id", "pk_payment_sequential"]),
    fused_sql("s_dim_orders", "dim_orders", [("not_null", "pk_order_sid")]),
    unique_sql("s_dim_orders", "dim_orders", ["pk_order_sid"]),
    *[rel_sql(ORACLE_TABLES[t], t, c, ORACLE_TABLES[ref], ref_c) for t, c, ref, ref_c in REFERENCES],
]), extra=FCT_EXTRA)
def q_model_tests(spark, sf_dir):
    return data_tests(star(spark, sf_dir))


def _scratch(spark, name: str) -> str:
    """A new path in the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("csv_round_trip", """
SELECT review_id, order_id, review_score, coalesce(review_comment_title, '') AS review_comment_title,
  coalesce(review_comment_message, '') AS review_comment_message FROM x_reviews""")
def q_csv_round_trip(spark, sf_dir):
    """Written as quoted CSV, line ends inside fields included, and read back."""
    path = _scratch(spark, "reviews-csv")
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("review_comment_title", "review_comment_message")]
    out = raw(spark, sf_dir).order_reviews.select("review_id", "order_id", "review_score", *texts)
    io.write_csv(out, path)
    back = io.read_csv(spark, path, schema=out.schema, multiline=True)
    return back.select("review_id", "order_id", "review_score", *[F.coalesce(c, F.lit("")).alias(c) for c in ("review_comment_title", "review_comment_message")])


@query("table_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def q_table_round_trip(spark, sf_dir):
    """Materialised as a written table; the frame reads the table."""
    orders = Sources.parquet_dir(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return io.materialize(orders, "orders_copy", "table", _scratch(spark, "orders-table"))


@query("results_round_trip", """
SELECT o_orderstatus AS table_name, COUNT(*) AS n_rows, SUM(CASE WHEN o_totalprice IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_null
FROM orders GROUP BY o_orderstatus""")
def q_results_round_trip(spark, sf_dir):
    """A result report written as JSON and read back."""
    path = _scratch(spark, "results-json")
    report = Sources.parquet_dir(spark, sf_dir).orders.groupBy(F.col("o_orderstatus").alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.when(F.col("o_totalprice").isNull(), 1).otherwise(0)).cast("bigint").alias("n_null"))
    io.write_results(report, path)
    return spark.read.schema(report.schema).json(path)
