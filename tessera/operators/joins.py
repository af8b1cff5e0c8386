"""Join operators.

Joins carry no broadcast hint unless a side is bounded by a constant (one
row per weekday, k rows of a top-k) or was counted first (``sized``): the planner and AQE choose from the
sizes that they measure, in bytes, for the data at hand, and split skewed
keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import held


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """J-2/J-5/J-12: fact ⟕ dimension; the planner picks the strategy from sizes it has measured."""
    return fact.join(dim, on, how)


def join_on(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str = "left") -> DataFrame:
    """J-3/J-4: join on differently named keys; both key columns are kept."""
    cond = None
    for lk, rk in keys.items():
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


def left_enrich(header: DataFrame, child_aggs: Sequence[DataFrame], on: str) -> DataFrame:
    """J-1: header ⟕ pre-aggregated children (one row per key each), no fan-out."""
    out = header
    for agg in child_aggs:
        out = out.join(agg, on, "left")
    return out


#: Rows up to which ``sized`` sends a side to every task.
SMALL_ROWS = 100_000


def sized(side: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """A side of a join that is computed once and counted: with at most
    ``most`` rows it is hinted as broadcast, so the other side is not moved;
    beyond that the planner shuffles both."""
    once = held(side)
    return F.broadcast(once) if once.count() <= most else once


def semi(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """P-9: rows of ``df`` whose key occurs in ``other``."""
    return df.join(other, on, "left_semi")


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """J-13: rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other, on, "left_anti")


def add_counts(a: DataFrame, b: DataFrame, key: str, value: str = "count") -> DataFrame:
    """J-10: add two count tables by key, a missing side counting 0.

    Written as union + sum (one shuffle) instead of a full outer join.
    """
    return (a.select(key, F.col(value).alias("_v")).unionByName(b.select(key, F.col(value).alias("_v")))
            .groupBy(key).agg(F.sum("_v").alias(value)))


def holiday_window(days: DataFrame, holidays: DataFrame, day_col: str = "ds",
                   lower: int = -3, upper: int = 3) -> DataFrame:
    """J-11: days within [holiday + lower, holiday + upper].

    The range join is made an equi-join: every holiday is exploded to its
    (upper − lower + 1) offsets first, then joined on the date, so no
    nested-loop join is planned.  Output: day columns + holiday, offset.
    """
    offs = holidays.select(
        "holiday", F.col("ds").alias("_hds"),
        F.explode(F.sequence(F.lit(lower), F.lit(upper))).alias("offset"))
    offs = offs.select("holiday", "offset", F.date_add(F.col("_hds"), F.col("offset")).alias("_day"))
    return days.join(offs, F.to_date(days[day_col]) == offs["_day"], "inner").drop("_day")


def lookup_last_year(df: DataFrame, lookup: DataFrame, date_col: str, value_col: str,
                     years: int = 1, out: str | None = None) -> DataFrame:
    """J-8: value of the same calendar date ``years`` earlier.

    The lookup's dates are shifted forward by ``years`` (29 Feb → 28 Feb);
    when two source days land on one target day the later source day wins,
    so the shifted key stays unique and the join cannot fan out.
    """
    out = out or f"{value_col}_last_year"
    shifted = lookup.select(
        F.add_months(F.to_date(date_col), 12 * years).alias("_key"),
        F.to_date(date_col).alias("_src"), F.col(value_col).alias("_val"))
    dedup = shifted.groupBy("_key").agg(F.max_by("_val", "_src").alias(out))
    return df.join(dedup, F.to_date(df[date_col]) == dedup["_key"], "left").drop("_key")


def lookup_weekday(df: DataFrame, lookup: DataFrame, date_col: str, value_col: str,
                   out: str | None = None) -> DataFrame:
    """J-9: value by weekday, reduced to one row per weekday (latest date) first."""
    out = out or f"{value_col}_by_weekday"
    per_dow = lookup.groupBy(F.weekday(F.to_date(date_col)).alias("_dow")).agg(
        F.max_by(value_col, F.to_date(date_col)).alias(out))
    return df.join(F.broadcast(per_dow), F.weekday(F.to_date(df[date_col])) == per_dow["_dow"], "left").drop("_dow")
