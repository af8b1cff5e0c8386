"""Projection and filter operators.

All are column expressions, so Catalyst pushes them into the Parquet
scan where the predicate allows (comparisons, IN, IS NULL).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import contains_ci as _contains_ci


def select_as(df: DataFrame, mapping: Mapping[str, str] | Sequence[tuple[str, str]]) -> DataFrame:
    """P-1/P-2: projection with aliases; a source column may appear twice."""
    items = mapping.items() if isinstance(mapping, Mapping) else mapping
    return df.select(*[F.col(src).alias(dst) for dst, src in items])


def within_box(df: DataFrame, box: Mapping[str, tuple[float, float]]) -> DataFrame:
    """P-6: closed interval on each column (NULL and NaN rows drop)."""
    cond = F.lit(True)
    for c, (lo, hi) in box.items():
        cond = cond & F.col(c).between(F.lit(lo), F.lit(hi)) & ~F.isnan(F.col(c))
    return df.filter(cond)


def _next_day(s: str) -> str:
    return (_dt.date.fromisoformat(s[:10]) + _dt.timedelta(days=1)).isoformat()


def date_range(df: DataFrame, col: str, lo: str | None, hi: str | None, closed: str = "both") -> DataFrame:
    """P-7: date/timestamp range filter.

    ``closed="both"`` keeps whole calendar days [lo, hi] (half-open
    [lo, hi + 1 day) on timestamps, P11); ``closed="raw"`` compares with
    the literal (``<= 'hi'`` means midnight of ``hi``), as the original.
    Literals are typed like the column so the predicate reaches the scan.
    """
    c = F.col(col)
    dtype = df.schema[col].dataType.simpleString()
    cast = "timestamp_ntz" if dtype == "timestamp_ntz" else ("timestamp" if dtype == "timestamp" else "date")
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo).cast(cast))
    if hi is not None:
        if closed == "raw" or cast == "date":
            cond = cond & (c <= F.lit(hi).cast(cast))
        elif closed == "both":
            cond = cond & (c < F.lit(_next_day(hi)).cast(cast))
        elif closed == "left":
            cond = cond & (c < F.lit(hi).cast(cast))
        else:
            raise ValueError(closed)
    return df.filter(cond)


def contains_ci(df: DataFrame, col: str, s: str) -> DataFrame:
    """P-11: case-insensitive substring filter; NULL never matches."""
    return df.filter(_contains_ci(col, s))


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P-12."""
    return df.dropna(how="all", subset=list(cols))


def last_n_days(df: DataFrame, col: str, n: int, by: Sequence[str] | None = None) -> DataFrame:
    """P-15 / W-4: rows with ``col >= max(col) - n days`` (per series when ``by``).

    The max is a scalar subquery (or one row per series joined back).  The raw
    column is compared with the cut-off day's beginning, in the column's own
    type, so the predicate reaches the scan.
    """
    if not by:
        kind = df.schema[col].dataType
        cutoff = F.date_sub(df.agg(F.max(F.to_date(col))).scalar(), n)
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return df.filter(F.col(col) >= cutoff.cast(kind))
        return df.filter(F.to_date(col) >= cutoff)
    mx = df.groupBy(*by).agg(F.max(F.to_date(col)).alias("_max"))
    j = df.join(mx, list(by), "inner")
    return j.filter(F.to_date(col) >= F.date_sub(F.col("_max"), n)).drop("_max")


def split_last_n_days(df: DataFrame, col: str, n: int, by: Sequence[str] | None = None) -> DataFrame:
    """W-4: label rows 'train' / 'test'; test = the last ``n`` days (exclusive of the cutoff)."""
    if by:
        mx = df.groupBy(*by).agg(F.max(F.to_date(col)).alias("_max"))
        j = df.join(mx, list(by), "inner")
    else:
        j = df.withColumn("_max", df.agg(F.max(F.to_date(col))).scalar())
    return j.withColumn("split", F.when(F.to_date(col) > F.date_sub(F.col("_max"), n), "test")
                        .otherwise("train")).drop("_max")


def slice_rows(df: DataFrame, order: str | Sequence[str], start: int | None, stop: int | None,
               by: Sequence[str] | None = None) -> DataFrame:
    """P-18: rows [start, stop) in ``order`` (negative = from the end), per group.

    A slice that lies at one end of its groups is a ``row_number() <= k``,
    which Spark applies before the shuffle too, so each task sends at most k
    rows of a group; without groups it is a top-k (``orderBy().limit``).  For others positions come from ``distributed_rank``
    (range partitions + offsets), not from a window over a whole group; group
    sizes are a grouped count joined back.  ``order`` must be unique within a
    group.
    """
    from tessera.operators.ordered import distributed_rank
    by = list(by or [])
    order = [order] if isinstance(order, str) else list(order)
    first = stop is not None and stop >= 0 and (start is None or start >= 0)
    last = start is not None and start < 0 and (stop is None or stop < 0)
    if by and (first or last):
        w = Window.partitionBy(*by).orderBy(*[F.col(c).asc() if first else F.col(c).desc() for c in order])
        n = F.col("_rn")
        inside = (n <= stop) & (n > (start or 0)) if first else (n <= -start) & (n > (0 if stop is None else -stop))
        return df.withColumn("_rn", F.row_number().over(w)).filter(inside).drop("_rn")
    if first and not by:
        head = df.orderBy(*order).limit(stop)
        return head.offset(start) if start else head
    if last and not by:
        tail = df.orderBy(*[F.col(c).desc() for c in order]).limit(-start)
        return tail.offset(-stop) if stop is not None else tail
    numbered = distributed_rank(df, by, order, out="_rn").withColumn("_rn", F.col("_rn") - 1)
    if (start is not None and start < 0) or (stop is not None and stop < 0):
        g = numbered.withColumn("_g", F.lit(0)) if not by else numbered
        keys = by or ["_g"]
        cnt = g.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        numbered = g.join(F.broadcast(cnt) if not by else cnt, keys, "inner")
        n = F.col("_n")
    else:
        n = F.lit(0)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("_rn") >= (n + start if start < 0 else F.lit(start)))
    if stop is not None:
        cond = cond & (F.col("_rn") < (n + stop if stop < 0 else F.lit(stop)))
    out = numbered.filter(cond).drop("_rn", "_n")
    return out.drop("_g") if "_g" in out.columns else out
