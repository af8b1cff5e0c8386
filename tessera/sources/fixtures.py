"""Raw tables of the four workloads, derived from the supplied test tables.

Every definition is modulo arithmetic on keys (no random or hash
functions), so the same table can be written in DuckDB SQL for the oracle
(``tessera.sources.fixture_sql``).  All are narrow projections of one
scan, except ``x_items`` (one window per order) and ``x_payments`` (one
aggregation per order joined back to orders on the same key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.catalog import Sources

# Calendar events by (month, day) → event_name_1, and the
# three days that also carry an event_name_2.
CALENDAR_EVENTS = [
    (1, 1, "NewYear"),
    (2, 14, "ValentinesDay"),
    (3, 17, "StPatricksDay"),
    (4, 22, "EarthDay"),
    (5, 1, "LaborDay"),
    (6, 19, "Juneteenth"),
    (7, 4, "IndependenceDay"),
    (8, 15, "Assumption"),
    (9, 9, "EidAlAdha"),
    (10, 31, "Halloween"),
    (11, 11, "VeteransDay"),
    (12, 25, "Christmas"),
]
CALENDAR_EVENTS_2 = [
    (7, 4, "Ramadan starts"),
    (10, 31, "Father's day"),
    (12, 25, "OrthodoxChristmas"),
]

# Survey flag code rules — (a, b, threshold) per flag.
SURVEY_FLAGS = [(7, 3, 20), (11, 5, 15), (13, 7, 10), (17, 9, 5), (19, 11, 30)]

ORDER_STATUS_BY_MOD8 = {0: "canceled", 1: "unavailable", 2: "shipped", 3: "processing"}
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]


def _days(ts, n):
    return F.timestamp_add("DAY", n if not isinstance(n, int) else F.lit(n), ts)


def _text_ts(c):
    """'yyyy-MM-dd HH:mm:ss' text of a TIMESTAMP_NTZ (whole seconds) without
    going through the session time zone (``date_format`` would, and shifts
    wall-clock times that fall into a DST gap)."""
    return c.cast("timestamp_ntz").cast("string")


def x_customers(t: Sources) -> DataFrame:
    n = t.nation.select("n_nationkey", "n_name")
    c = t.customer
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        (F.col("c_custkey") % 500).alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("c_mktsegment").alias("customer_state"),
    )


def order_status_col(k):
    e = None
    for m, s in ORDER_STATUS_BY_MOD8.items():
        e = F.when(k % 8 == m, s) if e is None else e.when(k % 8 == m, s)
    return e.otherwise("delivered")


def x_orders(t: Sources) -> DataFrame:
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    status = order_status_col(k)
    return t.orders.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        ts.alias("order_purchase_timestamp"),
        F.when(k % 50 == 0, F.lit("")).otherwise(_text_ts(_days(ts, 1))).alias("order_approved_at"),
        F.when(k % 45 == 0, F.lit("")).otherwise(_text_ts(_days(ts, 3))).alias("order_delivered_carrier_date"),
        F.when((status == "delivered") & (k % 40 != 0), _text_ts(_days(ts, 5 + k % 20)))
        .alias("order_delivered_customer_date"),
        _days(ts, 15).alias("order_estimated_delivery_date"),
    )


def x_items(t: Sources) -> DataFrame:
    """One row per line item; ``order_item_id`` numbers the lines of an order."""
    li = t.lineitem
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    price = F.round(F.col("l_extendedprice").cast("decimal(18,2)")
                    * (F.lit(1) - F.col("l_discount").cast("decimal(5,2)")), 2).cast("decimal(18,2)")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.row_number().over(w).cast("bigint").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        F.col("l_tax").cast("decimal(5,2)").alias("_tax"),
    ).select(
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
        F.round(F.col("price") * F.col("_tax"), 2).cast("decimal(18,2)").alias("freight_value"),
    )


def x_payments(t: Sources, items: DataFrame | None = None) -> DataFrame:
    items = x_items(t) if items is None else items
    totals = items.groupBy("order_id").agg(
        (F.sum("price") + F.sum("freight_value")).alias("items_total"))
    k = F.col("o_orderkey")
    o = t.orders.filter(k % 97 != 0).select("o_orderkey", "o_totalprice")
    base = F.coalesce(F.col("items_total"), F.col("o_totalprice").cast("decimal(18,2)"))
    amount = (F.when(k % 5 == 0, base - F.lit(10)).when(k % 7 == 0, base + F.lit(5))
              .otherwise(base).cast("decimal(18,2)"))
    two = k % 10 == 0
    # two instalments: the first is half the amount rounded down to a cent
    half = F.expr("(CAST(amount * 100 AS BIGINT) - CAST(amount * 100 AS BIGINT) % 2) div 2")
    first_part = (half.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")
    joined = o.join(totals, o.o_orderkey == totals.order_id, "left").select(
        k, amount.alias("amount"), F.explode(F.when(two, F.array(F.lit(1), F.lit(2)))
                                            .otherwise(F.array(F.lit(1)))).alias("seq"))
    value = (F.when(~two, F.col("amount"))
             .when(F.col("seq") == 1, first_part)
             .otherwise(F.col("amount") - first_part)).cast("decimal(18,2)")
    ptype = None
    for i, name in enumerate(PAYMENT_TYPES):
        ptype = F.when(k % 4 == i, name) if ptype is None else ptype.when(k % 4 == i, name)
    return joined.select(
        k.alias("order_id"),
        F.col("seq").cast("bigint").alias("payment_sequential"),
        ptype.alias("payment_type"),
        (F.lit(1) + k % 6).cast("bigint").alias("payment_installments"),
        value.alias("payment_value"),
    )


def x_products(t: Sources) -> DataFrame:
    p = F.col("p_partkey")
    return t.part.select(
        p.alias("product_id"),
        F.when(p % 30 == 0, F.lit(None).cast("string")).otherwise(F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").cast("bigint").alias("product_name_lenght"),
        (F.length("p_brand") * 10).cast("bigint").alias("product_description_lenght"),
        (F.lit(1) + F.col("p_size") % 5).cast("bigint").alias("product_photos_qty"),
        (F.col("p_size") * 100).cast("bigint").alias("product_weight_g"),
        (F.lit(10) + p % 40).cast("bigint").alias("product_length_cm"),
        (F.lit(5) + p % 25).cast("bigint").alias("product_height_cm"),
        (F.lit(8) + p % 30).cast("bigint").alias("product_width_cm"),
    )


def x_translation(t: Sources) -> DataFrame:
    """Category → English name for every category but 'promo' (left-join miss)."""
    cats = t.part.select(F.lower("p_type").alias("product_category_name")).distinct()
    return cats.filter(F.col("product_category_name") != "promo").select(
        "product_category_name",
        F.upper("product_category_name").alias("product_category_name_english"))


def x_sellers(t: Sources) -> DataFrame:
    s = t.supplier
    n = t.nation.select("n_nationkey", "n_name")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("seller_id"),
        (F.col("s_suppkey") * 37).alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.concat(F.lit("S"), (F.col("s_nationkey") % 5).cast("string")).alias("seller_state"),
    )


def x_reviews(t: Sources) -> DataFrame:
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    return t.orders.select(
        F.concat(F.lit("r"), k.cast("string")).alias("review_id"),
        k.alias("order_id"),
        (F.lit(1) + k % 5).cast("bigint").alias("review_score"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("title "), (k % 5).cast("string"))).alias("review_comment_title"),
        F.when(k % 11 == 0, F.lit("line one\nline two\r\nend"))
        .otherwise(F.concat(F.lit("fine "), k.cast("string"))).alias("review_comment_message"),
        _days(ts, 10).alias("review_creation_date"),
        _days(ts, 12).alias("review_answer_timestamp"),
    )


def x_geo(t: Sources) -> DataFrame:
    c = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    both = c.unionAll(c)
    k = F.col("c_custkey")
    return both.select(
        (k % 500).alias("geolocation_zip_code_prefix"),
        (F.lit(-40.0) + ((k * 37) % 5000).cast("double") / F.lit(100.0).cast("double")).alias("geolocation_lat"),
        (F.lit(-80.0) + ((k * 53) % 5000).cast("double") / F.lit(100.0).cast("double")).alias("geolocation_lng"),
        F.lower("c_mktsegment").alias("geolocation_city"),
        F.concat(F.lit("S"), (F.col("c_nationkey") % 5).cast("string")).alias("geolocation_state"),
    )


def _event_case(d, events):
    e = None
    for m, day, name in events:
        cond = (F.month(d) == m) & (F.dayofmonth(d) == day)
        e = F.when(cond, name) if e is None else e.when(cond, name)
    return e


def calendar_frame(days: DataFrame, start: str | None = None) -> DataFrame:
    """Calendar columns for a frame of dates (column ``date``); day numbers
    count from ``start`` (default: the first date)."""
    d = F.col("date")
    first = F.lit(start).cast("date") if start else days.agg(F.min("date")).scalar()
    return days.select(
        F.concat(F.lit("d_"), (F.datediff(d, first) + 1).cast("string")).alias("d"),
        d,
        F.when(F.dayofmonth(d) <= 10, 1).otherwise(0).alias("snap_A"),
        F.when(F.dayofmonth(d).between(5, 14), 1).otherwise(0).alias("snap_B"),
        _event_case(d, CALENDAR_EVENTS).alias("event_name_1"),
        _event_case(d, CALENDAR_EVENTS_2).alias("event_name_2"),
    )


def x_calendar(t: Sources) -> DataFrame:
    """Daily calendar over the whole years spanned by the orders
    (1995-01-01 … 2001-12-31 on the supplied tables)."""
    rng = t.orders.agg(F.make_date(F.year(F.min("o_orderdate")), F.lit(1), F.lit(1)).alias("_s"),
                       F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("_e"))
    days = rng.select(F.explode(F.sequence("_s", "_e")).alias("date"))
    return calendar_frame(days)


def x_survey(t: Sources) -> DataFrame:
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    cols = [
        F.col("l_quantity").cast("bigint").alias("age"),
        F.col("l_linenumber").cast("bigint").alias("clasiffication_final"),
        (F.lit(1) + sk % 2).cast("bigint").alias("sex"),
        F.when(F.col("l_returnflag") == "R", F.date_format("l_shipdate", "dd/MM/yyyy"))
        .when((F.col("l_returnflag") == "A") & (pk % 50 == 0), F.lit(None).cast("string"))
        .otherwise(F.lit("9999-99-99")).alias("date_died"),
    ]
    for i, (a, b, thr) in enumerate(SURVEY_FLAGS, start=1):
        v = (pk * a + sk * b) % 100
        cols.append(F.when(pk % 200 == 0, F.lit(99)).when(v < thr, F.lit(1)).when(v < 97, F.lit(2))
                    .otherwise(v).cast("bigint").alias(f"f{i}"))
    return t.lineitem.select(*cols)


def x_scores(t: Sources) -> DataFrame:
    return t.lineitem.select(
        F.col("l_discount").alias("score"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))


def x_fraud(t: Sources, dims: int = 64) -> DataFrame:
    e = F.col("embedding")
    return t.embeddings.select(
        F.col("vec_id").alias("id"),
        *[e[i].cast("double").alias(f"v{i}") for i in range(dims)],
        F.when(F.col("label") == 0, 1).otherwise(0).alias("Class"))


def x_nulls(t: Sources) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("o_orderkey"), "o_custkey", "o_orderstatus",
        F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.lit(None).cast("double").alias("c_empty"),
        F.lit(1.0).alias("c_const"),
    )


def x_orphans(t: Sources) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("o_orderkey"),
        F.when(k % 1000 == 0, F.col("o_custkey") + F.lit(10**9)).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate")


def commerce_sources(spark, root: str) -> Sources:
    """The commerce raw layer (customers, orders, items, …) over the test tables."""
    t = Sources.parquet_dir(spark, root)
    raw = Sources(spark)
    raw.register("customers", lambda: x_customers(t))
    raw.register("orders", lambda: x_orders(t))
    raw.register("order_items", lambda: x_items(t))
    raw.register("order_payments", lambda: x_payments(t))
    raw.register("order_reviews", lambda: x_reviews(t))
    raw.register("products", lambda: x_products(t))
    raw.register("sellers", lambda: x_sellers(t))
    raw.register("product_category_name_translation", lambda: x_translation(t))
    raw.register("geolocation", lambda: x_geo(t))
    raw.base = t
    return raw
