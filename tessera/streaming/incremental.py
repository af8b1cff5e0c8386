"""Daily sales kept up to date from newly arrived order files.

The daily job re-reads whole tables.  This form reads only the files that
have arrived (``availableNow``), adds their orders to a store partitioned by
day, and recomputes the totals of every day that they touch, so that a late
order changes its day like any other and none is lost.  A batch that is
repeated after a failure overwrites its own part of the store and the same
days: the result is the batch aggregation over all orders that have arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
])


def daily_sales_frame(orders: DataFrame, ts_col: str = "o_orderdate", value_col: str = "o_totalprice") -> DataFrame:
    """Per calendar day: order count and summed value."""
    return (orders.groupBy(F.to_date(ts_col).alias("day"))
            .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.col(value_col).cast("decimal(18,2)")).cast("double").alias("total")))


def run_daily_sales_stream(spark: SparkSession, source_dir: str, store_dir: str, sink_dir: str, checkpoint_dir: str,
                           schema: T.StructType = ORDERS_SCHEMA, ts_col: str = "o_orderdate", value_col: str = "o_totalprice"):
    """Process all order files that have arrived in ``source_dir`` and stop.

    ``store_dir`` holds the orders by (day, batch), ``sink_dir`` the totals by day."""

    def update(arrived: DataFrame, batch: int) -> None:
        own = arrived.select(F.to_date(ts_col).alias("day"), F.lit(batch).alias("batch"), F.col(ts_col), F.col(value_col))
        overwrite = {"partitionOverwriteMode": "dynamic"}
        own.write.mode("overwrite").options(**overwrite).partitionBy("day", "batch").parquet(store_dir)
        store = spark.read.parquet(store_dir)
        touched = store.join(own.select("day").distinct(), "day", "left_semi")
        daily_sales_frame(touched, ts_col, value_col).write.mode("overwrite").options(**overwrite).partitionBy("day").parquet(sink_dir)

    q = (spark.readStream.schema(schema).parquet(source_dir).writeStream.foreachBatch(update)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
