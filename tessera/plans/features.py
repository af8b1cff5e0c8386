"""Feature tables and commerce analyses.

Money sums run on ``decimal(18,2)`` and are cast to DOUBLE at the end;
group keys that come from pandas code drop NULL keys (P4).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import stats as ST
from tessera.operators.filters import date_range, within_box
from tessera.operators.joins import join_on
from tessera.operators.ordered import top_k

LAND_BOX = {"geolocation_lat": (-34.0, 5.0), "geolocation_lng": (-74.0, -34.0)}
# the validation suite's (wider, shifted) bounds — P10
LAND_CHECK = {"geolocation_lat": (-35.0, 5.0), "geolocation_lng": (-75.0, -35.0)}


# T-9
def ds_orders_delivery(dim_orders: DataFrame) -> DataFrame:
    """Delivered orders with actual and estimated delivery time in minutes."""
    d = dim_orders.filter(F.col("order_status") == "delivered")
    return d.withColumns({
        "actual_delivery_time_minutes": S.minutes_between("order_delivered_customer_date", "order_purchase_timestamp"),
        "estimated_delivery_time_minutes": S.minutes_between("order_estimated_delivery_date",
                                                             "order_purchase_timestamp"),
    })


#: Dates that a delivered order should have.
TARGET_DATES = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]


# V-11
def missing_target_dates(delivery: DataFrame, cols: Sequence[str] = TARGET_DATES) -> DataFrame:
    """Missing dates of delivered orders: count and percent per column, and the
    number of orders that lack any (one aggregation)."""
    any_missing = F.greatest(*[F.col(c).isNull() for c in cols])
    rows = delivery.select(*cols, F.when(~any_missing, F.lit(1)).alias("any of these"))
    return ST.null_profile(rows, [*cols, "any of these"], keep_positive=False)


def delivered_without_date(delivery: DataFrame, col: str = "order_delivered_customer_date") -> DataFrame:
    """The delivered orders that lack a date, to be looked at or loaded again."""
    return delivery.filter(F.col(col).isNull())


# A-5
def item_agg(fct_items: DataFrame) -> DataFrame:
    """Per order: summed price and the modal English category.

    Mode ignores NULLs, breaks ties by the smallest value and is NULL when
    all are NULL (P5).  Its state per order is one count per distinct
    category of that order — bounded by the category list, not by rows —
    so it is computed in the same aggregation as the price sum.
    """
    return fct_items.groupBy("fk_order_sid").agg(
        F.sum(S.money("price")).alias("_price"),
        F.mode("product_category_name_english", deterministic=True).alias("product_category_name_english"))


# T-10
def ds_orders_full_profits(dim_orders: DataFrame, fct_items: DataFrame) -> DataFrame:
    agg = item_agg(fct_items)
    j = join_on(dim_orders, agg, {"pk_order_sid": "fk_order_sid"}, "left")
    return j.withColumns({
        "price": F.col("_price").cast("double"),
        "profit": (S.money("total_payment") - F.col("_price")).cast("double"),
    }).drop("_price")


# T-11
def ds_land_geolocation(dim_geolocation: DataFrame, box: Mapping = LAND_BOX) -> DataFrame:
    return within_box(dim_geolocation, box)


def orders_customers(dim_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """J-3: orders ⟕ customers on differently named keys."""
    return join_on(dim_orders, dim_customers, {"fk_customer_sid": "pk_customer_sid"}, "left")


# T-12
def monthly_city_sales(dim_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    oc = orders_customers(dim_orders.select("fk_customer_sid", "order_purchase_timestamp", "total_payment"),
                          dim_customers.select("pk_customer_sid", "customer_city"))
    return (oc.filter(F.col("customer_city").isNotNull())
            .groupBy("customer_city", S.year_month("order_purchase_timestamp").alias("year_month"))
            .agg(F.coalesce(F.sum(S.money("total_payment")), F.lit(0)).cast("double").alias("total_payment")))


def top_cities(monthly: DataFrame, k: int = 5) -> DataFrame:
    per_city = monthly.groupBy("customer_city").agg(F.sum(S.money("total_payment")).alias("_t"))
    return top_k(per_city, "_t", k, tie_break=["customer_city"]).select(
        "customer_city", F.col("_t").cast("double").alias("total_payment"), "rank")


def city_month_pivot(monthly: DataFrame, k: int = 5) -> DataFrame:
    """O-4 + U-6: months × top-k cities, labelled by rank (top1 … topk).

    Rank labels keep the output schema independent of the data; the city
    names of the labels are in ``top_cities``.  The k-row top list is
    broadcast (size bounded by k).
    """
    top = F.broadcast(top_cities(monthly, k).select("customer_city", "rank"))
    rows = monthly.join(top, "customer_city", "inner")
    return (rows.groupBy("year_month")
            .pivot("rank", list(range(1, k + 1)))
            .agg(F.first("total_payment"))
            .withColumnsRenamed({str(i): f"top{i}" for i in range(1, k + 1)}))


# T-13
def daily_sales(dim_orders: DataFrame, start: str, end: str, status: str = "delivered",
                closed: str = "both") -> DataFrame:
    d = dim_orders.filter(F.col("order_status") == status)
    d = date_range(d, "order_purchase_timestamp", start, end, closed)
    return (d.groupBy(F.to_date("order_purchase_timestamp").alias("order_purchase_date"))
            .agg(F.coalesce(F.sum(S.money("total_payment")), F.lit(0)).cast("double").alias("total_payment")))


def mean_daily_sales(dim_orders: DataFrame, start: str, end: str, status: str = "delivered",
                     closed: str = "both") -> DataFrame:
    """A-19: period sum ÷ inclusive day count, plus the peak day."""
    d = daily_sales(dim_orders, start, end, status, closed)
    days = (F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1)
    return d.agg(
        (F.sum(S.money("total_payment")).cast("double") / days).alias("mean_daily_sales"),
        F.max_by("order_purchase_date", F.struct("total_payment", (-F.datediff("order_purchase_date", F.lit(start)
                                                                                  .cast("date"))))).alias("peak_day"),
        F.max("total_payment").alias("peak_sales"),
    ).withColumn("n_days", days)


# T-14
def zip_centroids(land: DataFrame) -> DataFrame:
    return land.groupBy("geolocation_zip_code_prefix").agg(
        F.avg("geolocation_lat").alias("geolocation_lat"), F.avg("geolocation_lng").alias("geolocation_lng"))


def geo_sales(dim_orders: DataFrame, dim_customers: DataFrame, land: DataFrame, digits: int = 6) -> DataFrame:
    """Delivered sales summed by zip code at its centroid, with log1p for a heat
    map.  Places are told apart by zip code; only the output is rounded."""
    delivered = dim_orders.filter(F.col("order_status") == "delivered").select("fk_customer_sid", "total_payment")
    with_zip = join_on(delivered, dim_customers.select("pk_customer_sid", "customer_zip_code_prefix"),
                       {"fk_customer_sid": "pk_customer_sid"}, "left")
    per_zip = with_zip.groupBy("customer_zip_code_prefix").agg(
        F.coalesce(F.sum(S.money("total_payment")), F.lit(0)).cast("double").alias("total_payment"))
    geo = join_on(per_zip, zip_centroids(land), {"customer_zip_code_prefix": "geolocation_zip_code_prefix"}, "inner")
    return (geo.select("geolocation_zip_code_prefix", S.round_nudged("geolocation_lat", digits).alias("geolocation_lat"),
                       S.round_nudged("geolocation_lng", digits).alias("geolocation_lng"), "total_payment")
            .withColumn("log_total_payment", S.round_nudged(F.log1p("total_payment"), 9)))


# T-15
def category_profit(full_profits: DataFrame) -> DataFrame:
    return (full_profits.filter(F.col("product_category_name_english").isNotNull())
            .groupBy("product_category_name_english")
            .agg(F.coalesce(F.sum(S.money("profit")), F.lit(0)).alias("_p")))


def category_profit_top(full_profits: DataFrame, k: int = 10) -> DataFrame:
    return top_k(category_profit(full_profits), "_p", k, tie_break=["product_category_name_english"]).select(
        "product_category_name_english", F.col("_p").cast("double").alias("profit"), "rank")


def top_k_rows(df: DataFrame, by: Sequence[str] | str, measure: str, k: int) -> DataFrame:
    """O-4: all rows of the top-k groups by summed ``measure``."""
    by = [by] if isinstance(by, str) else list(by)
    per = df.groupBy(*by).agg(F.sum(measure).alias("_t"))
    top = F.broadcast(top_k(per, "_t", k, tie_break=by).select(*by))
    return df.join(top, by, "left_semi")
