"""The daily ELT job: ingest → models → data tests →
features → validation, fail-fast.

Every stage writes its tables to ``target`` (a shared folder on a
cluster) and the next stage reads them back, so each stage starts from
materialised data rather than re-running the lineage of the previous
ones, and a lost executor only costs the current stage.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.plans import features as FE
from tessera.plans import warehouse as W
from tessera.sources import io
from tessera.sources.catalog import Sources

RAW_TABLES = ["customers", "orders", "order_items", "order_payments", "order_reviews", "products", "sellers",
              "product_category_name_translation", "geolocation"]


#: Declared references of the star schema: (table, column, referenced table, its column).
REFERENCES = [
    ("dim_orders", "fk_customer_sid", "dim_customers", "pk_customer_sid"),
    ("fct_order_items", "fk_order_sid", "dim_orders", "pk_order_sid"),
    ("fct_payments", "fk_order_sid", "dim_orders", "pk_order_sid"),
    ("fct_reviews", "fk_order_sid", "dim_orders", "pk_order_sid"),
    ("dim_orders", "fk_order_purchased_date_sid", "dim_date", "pk_date_sid"),
    ("dim_orders", "fk_order_approved_at_date_sid", "dim_date", "pk_date_sid"),
    ("dim_orders", "fk_order_delivered_carrier_date_sid", "dim_date", "pk_date_sid"),
    ("dim_orders", "fk_order_delivered_customer_date_sid", "dim_date", "pk_date_sid"),
    ("dim_orders", "fk_order_estimated_delivery_date_sid", "dim_date", "pk_date_sid"),
    ("fct_order_items", "fk_shipping_limit_date_sid", "dim_date", "pk_date_sid"),
    ("fct_reviews", "fk_review_creation_date_sid", "dim_date", "pk_date_sid"),
]


def reference_tests(star: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared reference as a relationship test, fused by dimension."""
    return Q.reference_checks([(table, star[table], column, star[ref], ref_column) for table, column, ref, ref_column in REFERENCES]).select("table_name", *Q.RESULT_COLUMNS)


def data_tests(star: Mapping[str, DataFrame]) -> DataFrame:
    """The model tests: 2 unique, 8 not-null, 3 compound-unique, plus the
    relationship tests of all declared references (P20: intended names).

    One grouped pass per table answers its key's uniqueness and the
    not-null checks of the key columns (``key_checks``); one per dimension
    answers all references to it (``reference_checks``).
    """
    def lab(df, t):
        return df.select(F.lit(t).alias("table_name"), *Q.RESULT_COLUMNS)
    parts = [
        lab(Q.key_checks(star["dim_customers"], ["pk_customer_sid"], ["pk_customer_sid"]), "dim_customers"),
        lab(Q.key_checks(star["fct_order_items"], ["pk_order_id", "pk_order_item_id"],
                         ["pk_order_id", "pk_order_item_id"]), "fct_order_items"),
        lab(Q.key_checks(star["fct_reviews"], ["pk_order_id", "pk_review_id"], ["pk_order_id", "pk_review_id"]),
            "fct_reviews"),
        lab(Q.key_checks(star["fct_payments"], ["pk_order_id", "pk_payment_sequential"],
                         ["pk_order_id", "pk_payment_sequential"]), "fct_payments"),
        lab(Q.key_checks(star["dim_orders"], ["pk_order_sid"], ["pk_order_sid"]), "dim_orders"),
        reference_tests(star),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Expected Spark types per table for the type suite (V-6, P21: date keys are strings).
EXPECTED_TYPES = {
    "dim_customers": {"pk_customer_sid": "bigint", "customer_zip_code_prefix": "string"},
    "dim_date": {"pk_date_sid": "string", "full_date": "date", "is_weekday": "int"},
    "dim_orders": {"pk_order_sid": "bigint", "total_payment": "double", "payment_status": "string"},
    "fct_order_items": {"price": "double", "fk_shipping_limit_date_sid": "string"},
    "dim_geolocation": {"geolocation_lat": "double", "geolocation_lng": "double"},
}


def validation_suites(star: Mapping[str, DataFrame], delivery: DataFrame, land: DataFrame) -> dict[str, DataFrame]:
    """The five validation suites: column positions, types, coordinate bounds."""
    suites = {
        "customers": Q.run_suite(star["dim_customers"], [Q.ColumnExists("pk_customer_sid", 0)]),
        "order_items": Q.run_suite(star["fct_order_items"], [
            Q.ColumnExists("fk_order_sid", 0), Q.ColumnExists("pk_order_id", 1),
            Q.ColumnExists("pk_order_item_id", 2), Q.ColumnExists("fk_shipping_limit_date_sid", 3)]),
        "orders_delivery": Q.run_suite(delivery, [Q.ColumnExists("pk_order_sid", 0),
                                                  Q.ColumnExists("fk_customer_sid", 1)]),
        "land_geolocation": Q.run_suite(land, [Q.Between(c, lo, hi) for c, (lo, hi) in FE.LAND_CHECK.items()]),
    }
    spark = land.sparkSession
    type_rows = []
    for table, cols in EXPECTED_TYPES.items():
        for c, t in cols.items():
            type_rows.append(Q.run_suite(star[table], [Q.ColumnType(c, t)], spark=spark)
                             .withColumn("column", F.lit(f"{table}.{c}")))
    types = type_rows[0]
    for p in type_rows[1:]:
        types = types.unionByName(p)
    suites["types"] = types
    return suites


def run_daily(spark: SparkSession, raw: Sources, target: str, on_fail: str = "raise",
              with_load_date: bool = True) -> list[tuple[str, str]]:
    """Run the five stages in order; a failing stage stops the rest.

    Stage outputs: ``target/raw/*``, ``target/models/*``,
    ``target/tests``, ``target/features/*``, ``target/validation/*``.
    """
    state: dict[str, object] = {}

    def p(*parts):
        return os.path.join(target, *parts)

    def ingest():
        state["ingest"] = io.ingest({t: raw[t] for t in RAW_TABLES}, p("raw"))

    def models():
        landed = Sources(spark)
        for t in RAW_TABLES:
            landed.register(t, lambda t=t: spark.read.parquet(p("raw", t)))
        star = W.build_star(landed, with_load_date=with_load_date)
        state["star"] = {name: io.materialize(df, name, "table", p("models", name)) for name, df in star.items()}

    def tests():
        res = io.materialize(data_tests(state["star"]), "data_tests", "table", p("tests"))
        if on_fail == "raise":
            bad = res.filter(~F.col("success")).count()
            if bad:
                raise Q.DataQualityError(f"{bad} data tests failed")

    def features():
        star = state["star"]
        state["delivery"] = io.materialize(FE.ds_orders_delivery(star["dim_orders"]), "ds_orders_delivery",
                                           "table", p("features", "ds_orders_delivery"))
        state["profits"] = io.materialize(FE.ds_orders_full_profits(star["dim_orders"], star["fct_order_items"]),
                                          "ds_orders_full_profits", "table", p("features", "ds_orders_full_profits"))
        state["land"] = io.materialize(FE.ds_land_geolocation(star["dim_geolocation"]), "ds_land_geolocation",
                                       "table", p("features", "ds_land_geolocation"))

    def validation():
        # failing suites are reported, not raised (P23), like the original job
        for name, res in validation_suites(state["star"], state["delivery"], state["land"]).items():
            io.write_results(res, p("validation", name))

    steps = [Q.Step("ingest", ingest), Q.Step("models", models), Q.Step("tests", tests),
             Q.Step("features", features), Q.Step("validation", validation)]
    return Q.run_pipeline(steps)
