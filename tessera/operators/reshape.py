"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# U-4 / U-5
def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None, var: str = "variable",
         val: str = "value") -> DataFrame:
    """Wide → long.  ``values`` defaults to every non-id column."""
    ids = list(ids)
    values = list(values) if values else [c for c in df.columns if c not in ids]
    return df.unpivot(ids, values, var, val)


# U-6
def pivot(df: DataFrame, index: Sequence[str] | str, columns: str, value: str, labels: Sequence | None = None,
          agg: str = "sum", fill=None) -> DataFrame:
    """Long → wide with an explicit label list (no extra job to find labels
    when given); cells with no row are NULL, or ``fill``."""
    index = [index] if isinstance(index, str) else list(index)
    g = df.groupBy(*index)
    p = g.pivot(columns, list(labels)) if labels is not None else g.pivot(columns)
    out = p.agg(getattr(F, agg)(value))
    return out.fillna(fill) if fill is not None else out


def wide_by_month(df: DataFrame, ids: Sequence[str], date_col: str, value: str) -> DataFrame:
    """x_sales_wide-style table: one row per id combination, one column per
    month (yyyy-MM), summed money value, missing month = 0."""
    m = df.withColumn("_month", F.date_format(date_col, "yyyy-MM"))
    p = m.groupBy(*ids).pivot("_month").agg(F.sum(F.col(value).cast("decimal(18,2)")).cast("double"))
    months = [c for c in p.columns if c not in ids]
    return p.fillna(0.0, subset=months)


# U-1
def union_events(calendar: DataFrame, date_col: str, event_cols: Sequence[str], lower: int = -3,
                 upper: int = 3) -> DataFrame:
    """Holiday table (ds, holiday, lower_window, upper_window) from several
    event columns: one ``stack`` over one scan instead of one scan per column."""
    n = len(event_cols)
    stacked = calendar.select(F.to_date(date_col).alias("ds"), F.expr(
        f"stack({n}, " + ", ".join(f"`{c}`" for c in event_cols) + ") AS holiday"))
    return stacked.filter(F.col("holiday").isNotNull()).select(
        "ds", "holiday", F.lit(lower).alias("lower_window"), F.lit(upper).alias("upper_window"))


# U-3
def future_frame(df: DataFrame, date_col: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` days after the last date of each series (one row per series
    and day, generated with ``sequence`` from a grouped max)."""
    by = list(by)
    mx = df.groupBy(*by).agg(F.max(F.to_date(date_col)).alias("_mx")) if by else \
        df.agg(F.max(F.to_date(date_col)).alias("_mx"))
    return mx.select(*by, F.explode(F.sequence(F.date_add("_mx", 1), F.date_add("_mx", n))).alias(date_col))


# U-2 (P16)
def history_plus_future(df: DataFrame, date_col: str, n: int, by: Sequence[str] = ()) -> DataFrame:
    by = list(by)
    hist = df.select(*by, F.to_date(date_col).alias(date_col))
    return hist.unionByName(future_frame(df, date_col, n, by)).dropDuplicates(by + [date_col])
