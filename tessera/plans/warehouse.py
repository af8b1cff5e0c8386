"""Star-schema models.

Each model is a ``DataFrame → DataFrame`` function over the raw layer.
Money is summed as ``decimal(18,2)`` and cast to DOUBLE at the output
(SURVEY P1/P25); ``exact_float=True`` reproduces the original float
comparison instead.  ``load_date`` is the only non-deterministic column;
``with_load_date=False`` leaves it out (used by value comparisons).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scalars as S
from tessera.operators.joins import left_enrich, lookup_join
from tessera.sources.catalog import Sources


def _stamp(df: DataFrame, with_load_date: bool) -> DataFrame:
    return df.withColumn("load_date", S.load_stamp()) if with_load_date else df


# T-1
def dim_customers(customers: DataFrame, with_load_date: bool = True) -> DataFrame:
    out = customers.select(
        F.col("customer_id").alias("pk_customer_sid"),
        "customer_unique_id",
        S.zip5("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        "customer_city", "customer_state")
    return _stamp(out, with_load_date)


# Daily date series, both ends inclusive, generated in parallel.
def date_series(spark: SparkSession, start: str, end: str, col: str = "d") -> DataFrame:
    s, e = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    n = (e - s).days + 1
    return spark.range(0, max(n, 0)).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias(col))


def date_span(sources: list[tuple[DataFrame, list[str]]], col: str = "d") -> DataFrame:
    """S12 over data: every day of the whole years spanned by the date columns
    (date, timestamp or text) of some tables: a one-row aggregate of each, and
    one ``sequence`` over them; size = days in the span."""
    ends = None
    for df, cols in sources:
        days = [F.col(c).try_cast("date") for c in cols]
        one = df.agg(F.least(*[F.min(d) for d in days], F.lit(None).cast("date")).alias("lo"), F.greatest(*[F.max(d) for d in days], F.lit(None).cast("date")).alias("hi"))
        ends = one if ends is None else ends.unionByName(one)
    rng = ends.agg(F.make_date(F.year(F.min("lo")), F.lit(1), F.lit(1)).alias("_s"),
                   F.make_date(F.year(F.max("hi")), F.lit(12), F.lit(31)).alias("_e"))
    return rng.select(F.explode(F.sequence("_s", "_e")).alias(col))


def _dim_date_columns(days: DataFrame, with_load_date: bool) -> DataFrame:
    d = F.col("d")
    out = days.select(
        S.date_key(d).alias("pk_date_sid"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        S.month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        S.day_name(d).alias("day_name"),
        S.is_weekday(d).alias("is_weekday"))
    return _stamp(out, with_load_date)


# T-2
def dim_date(spark: SparkSession, start: str = "2014-01-01", end: str = "2050-01-01",
             with_load_date: bool = True) -> DataFrame:
    """Date dimension over a fixed range (the original's 2014-01-01 … 2050-01-01)."""
    return _dim_date_columns(date_series(spark, start, end), with_load_date)


def dim_date_for(sources: list[tuple[DataFrame, list[str]]], with_load_date: bool = True) -> DataFrame:
    """Date dimension covering the whole years of the dates found in some tables."""
    return _dim_date_columns(date_span(sources), with_load_date)


# T-3
def dim_geolocation(geolocation: DataFrame, with_load_date: bool = True) -> DataFrame:
    out = geolocation.select(
        S.zip5("geolocation_zip_code_prefix").alias("geolocation_zip_code_prefix"),
        "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state").distinct()
    return _stamp(out, with_load_date)


def payment_totals(payments: DataFrame, exact_float: bool = False) -> DataFrame:
    v = F.col("payment_value")
    v = v.cast("double") if exact_float else S.money(v)
    return payments.groupBy("order_id").agg(F.sum(v).alias("_paid"))


def item_totals(items: DataFrame, exact_float: bool = False) -> DataFrame:
    p, f = F.col("price"), F.col("freight_value")
    if exact_float:
        p, f = p.cast("double"), f.cast("double")
    else:
        p, f = S.money(p), S.money(f)
    return items.groupBy("order_id").agg(
        F.sum(p).alias("_amt"), F.sum(f).alias("_freight"),
        (F.sum(p) + F.sum(f)).alias("_amt_wf"))


def _date_sid_guarded(guard: str, text_col: str):
    """The guard is the customer-delivery column for all three keys."""
    return F.when(F.col(guard).isNotNull() & (F.col(text_col) != ""),
                  S.date_key(F.col(text_col).cast("date")))


# T-4
def dim_orders(orders: DataFrame, payments: DataFrame, items: DataFrame,
               exact_float: bool = False, with_load_date: bool = True) -> DataFrame:
    """Order header with payment and item totals, balance and payment status.

    Both children are aggregated to one row per order before the left
    joins (J-1); the joins then reuse the aggregation's partitioning on
    ``order_id`` instead of shuffling again.
    """
    enriched = left_enrich(orders, [payment_totals(payments, exact_float), item_totals(items, exact_float)],
                           "order_id")
    paid, amt, amt_wf = F.col("_paid"), F.col("_amt"), F.col("_amt_wf")
    balance = amt_wf - paid
    guard = "order_delivered_customer_date"
    out = enriched.select(
        F.col("order_id").alias("pk_order_sid"),
        F.col("customer_id").alias("fk_customer_sid"),
        S.date_key(F.col("order_purchase_timestamp").cast("date")).alias("fk_order_purchased_date_sid"),
        _date_sid_guarded(guard, "order_approved_at").alias("fk_order_approved_at_date_sid"),
        _date_sid_guarded(guard, "order_delivered_carrier_date").alias("fk_order_delivered_carrier_date_sid"),
        _date_sid_guarded(guard, "order_delivered_customer_date").alias("fk_order_delivered_customer_date_sid"),
        S.date_key(F.col("order_estimated_delivery_date").cast("date")).alias("fk_order_estimated_delivery_date_sid"),
        "order_status",
        S.money_out(paid).alias("total_payment"),
        S.money_out(amt).alias("order_amt"),
        S.money_out(F.col("_freight")).alias("freight_amt"),
        S.money_out(amt_wf).alias("total_order_amt_wf_freight"),
        S.money_out(balance).alias("balance_amt"),
        S.payment_status(paid, amt, balance, "order_status").alias("payment_status"),
        F.col("order_purchase_timestamp").try_cast("timestamp_ntz").alias("order_purchase_timestamp"),
        S.safe_ts("order_approved_at").alias("order_approved_at"),
        S.safe_ts("order_delivered_carrier_date").alias("order_delivered_carrier_date"),
        S.safe_ts("order_delivered_customer_date").alias("order_delivered_customer_date"),
        F.col("order_estimated_delivery_date").try_cast("timestamp_ntz").alias("order_estimated_delivery_date"),
    )
    return _stamp(out, with_load_date)


# T-5
def fct_order_items(items: DataFrame, products: DataFrame, translation: DataFrame, sellers: DataFrame,
                    with_load_date: bool = True) -> DataFrame:
    """Items ⟕ products ⟕ category translation ⟕ sellers (snowflake lookups).

    The three lookups are dimension tables; each is broadcast only after
    the planner finds it small enough (``lookup_join``), otherwise shuffled.
    """
    p = products.withColumnsRenamed({
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length"})
    j = lookup_join(items, p, "product_id")
    j = lookup_join(j, translation, "product_category_name")
    j = lookup_join(j, sellers, "seller_id")
    out = j.select(
        F.col("order_id").alias("fk_order_sid"),
        F.col("order_id").alias("pk_order_id"),
        F.col("order_item_id").cast("string").alias("pk_order_item_id"),
        S.date_key("shipping_limit_date").alias("fk_shipping_limit_date_sid"),
        "product_id", "seller_id", "shipping_limit_date",
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
        "product_category_name", "product_category_name_english",
        "product_name_length", "product_description_length", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        S.zip5("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        "seller_city", "seller_state")
    return _stamp(out, with_load_date)


# T-6
def fct_payments(payments: DataFrame, with_load_date: bool = True) -> DataFrame:
    out = payments.select(
        F.col("order_id").alias("fk_order_sid"),
        F.col("order_id").alias("pk_order_id"),
        F.col("payment_sequential").alias("pk_payment_sequential"),
        "payment_type", "payment_installments",
        F.col("payment_value").cast("double").alias("payment_value"))
    return _stamp(out, with_load_date)


# T-7
def fct_reviews(reviews: DataFrame, with_load_date: bool = True) -> DataFrame:
    out = reviews.select(
        F.col("order_id").alias("fk_order_sid"),
        F.col("order_id").alias("pk_order_id"),
        F.col("review_id").alias("pk_review_id"),
        S.date_key("review_creation_date").alias("fk_review_creation_date_sid"),
        "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp")
    return _stamp(out, with_load_date)


# The order/payment status lookup seed (20 rows, all text).
STATUS_SEED_COLUMNS = ["order_status", "payment_status", "record_count", "profit_lost", "status_description"]
STATUS_SEED = [
    ("Invoiced", "Completed", "273", "Profit", "Invoice processed, payment received."),
    ("Processing", "Completed", "269", "Profit", "Order finalized with successful payment."),
    ("Unavailable", "Completed", "6", "Profit", "Payment received despite item unavailability."),
    ("Canceled", "Completed", "411", "Profit", "Payment was completed despite order cancellation."),
    ("Shipped", "Completed", "1004", "Profit", "Shipment delivered with payment finalized."),
    ("Delivered", "Completed", "86973", "Profit", "Successfully fulfilled with payment received."),
    ("Approved", "Completed", "1", "Profit", "Successfully processed and finalized."),
    ("Processing", "In Progress", "32", "In Progress", "Awaiting completion of payment processing."),
    ("Approved", "In Progress", "1", "In Progress", "Awaiting payment completion."),
    ("Shipped", "In Progress", "102", "In Progress", "Goods dispatched, awaiting payment."),
    ("Canceled", "In Progress", "50", "In Progress", "Payment processing despite order cancellation."),
    ("Delivered", "In Progress", "9504", "In Progress", "Payment processing post-delivery."),
    ("Invoiced", "In Progress", "39", "In Progress", "Payment still being finalized."),
    ("Invoiced", "Order Items Not Found", "2", "Unknown", "Invoiced but items missing from order."),
    ("Canceled", "Order Items Not Found", "161", "Unknown", "Items missing, causing uncertainty in status."),
    ("Unavailable", "Order Items Not Found", "603", "Unknown", "Missing items prevent proper status evaluation."),
    ("Created", "Order Items Not Found", "5", "Unknown", "Newly created order but items not located."),
    ("Shipped", "Order Items Not Found", "1", "Unknown", "Shipped but item data missing."),
    ("Delivered", "Payments Not Found", "1", "Lost", "Payment missing despite delivery completion."),
    ("Canceled", "Canceled", "3", "Lost", "Transaction voided; no revenue gained."),
]
SEED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in STATUS_SEED_COLUMNS])


def status_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATUS_SEED, SEED_SCHEMA)


# T-8 / J-12
def status_summary(dim_orders_df: DataFrame, seed: DataFrame) -> DataFrame:
    """Orders counted by (order_status, payment_status), with the seed's text.

    The seed is title case and the computed statuses lower case (P22), so
    the join key is ``initcap`` of both.  NULL statuses are kept as a group.
    """
    counts = dim_orders_df.groupBy("order_status", "payment_status").agg(F.count(F.lit(1)).alias("n_orders"))
    keyed = counts.withColumns({"_os": F.initcap("order_status"), "_ps": F.initcap("payment_status")})
    s = seed.select(F.col("order_status").alias("_os"), F.col("payment_status").alias("_ps"),
                    "profit_lost", "status_description")
    return lookup_join(keyed, s, ["_os", "_ps"]).select(
        "order_status", "payment_status", "n_orders", "profit_lost", "status_description")


#: Every date of an order that has a date key.
ORDER_DATES = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]


class LazyTables(dict):
    """Mapping of table name → builder; a table is built on first access.

    Building a model can run small eager jobs (broadcast size checks), so
    a caller that needs one model does not pay for the others.
    """

    def __init__(self, builders):
        super().__init__()
        self._builders = dict(builders)

    def __getitem__(self, name):
        if not dict.__contains__(self, name):
            dict.__setitem__(self, name, self._builders[name]())
        return dict.__getitem__(self, name)

    def __contains__(self, name):
        return name in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)

    def keys(self):
        return self._builders.keys()

    def items(self):
        return [(k, self[k]) for k in self._builders]

    def values(self):
        return [self[k] for k in self._builders]


def build_star(raw: Sources, with_load_date: bool = True, exact_float: bool = False) -> LazyTables:
    """All seven models over one raw layer (built lazily, on first access)."""
    spark = raw.spark
    return LazyTables({
        "dim_customers": lambda: dim_customers(raw.customers, with_load_date),
        "dim_date": lambda: dim_date_for([(raw.orders, ORDER_DATES), (raw.order_items, ["shipping_limit_date"]),
                                          (raw.order_reviews, ["review_creation_date"])], with_load_date=with_load_date),
        "dim_geolocation": lambda: dim_geolocation(raw.geolocation, with_load_date),
        "dim_orders": lambda: dim_orders(raw.orders, raw.order_payments, raw.order_items, exact_float,
                                         with_load_date),
        "fct_order_items": lambda: fct_order_items(raw.order_items, raw.products,
                                                   raw.product_category_name_translation, raw.sellers,
                                                   with_load_date),
        "fct_payments": lambda: fct_payments(raw.order_payments, with_load_date),
        "fct_reviews": lambda: fct_reviews(raw.order_reviews, with_load_date),
    })
