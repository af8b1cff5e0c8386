"""Coded-survey cleaning and profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import stats as ST

# yes/no code recode of the boolean survey columns.
BOOL_RECODE = {1: 1, 2: 0, 97: None, 98: None, 99: None}
POSITIVE_CLASSES = [1, 2, 3]
FLAG_COLS = ["f1", "f2", "f3", "f4", "f5"]


# T-16
def survey_clean(df: DataFrame, flags: Sequence[str] = FLAG_COLS, class_col: str = "clasiffication_final",
                 died_col: str = "date_died") -> DataFrame:
    """Recode, derive positive / died, drop all-NULL flag rows, drop the sources."""
    out = df.withColumns({
        "positive": S.flag_in(class_col, POSITIVE_CLASSES),
        "died": S.died_flag(died_col),
        **{f: S.recode(f, BOOL_RECODE).cast("int") for f in flags},
    })
    out = out.dropna(how="all", subset=list(flags))
    return out.drop(class_col, died_col)


def positives(clean: DataFrame) -> DataFrame:
    return clean.filter(F.col("positive") == 1)


# T-17
def age_profile(clean: DataFrame, col: str = "age") -> DataFrame:
    """Describe, skew, mean and median of age for positives and for deaths among them."""
    pos = positives(clean)
    both = pos.select(F.lit("positive").alias("cohort"), col).unionByName(
        pos.filter(F.col("died") == 1).select(F.lit("died").alias("cohort"), col))
    d = ST.describe(both, [col], digits=2, by=["cohort"])
    sk = ST.skew(both, [col], by=["cohort"]).select("cohort", "column", S.round_nudged("skew", 3).alias("skew"))
    return d.join(sk, ["cohort", "column"])


def age_histogram(clean: DataFrame, col: str = "age", bins: int = 60) -> DataFrame:
    """T-17: equal-width histograms of age for positives and for deaths among them."""
    pos = positives(clean)
    both = pos.select(F.lit("positive").alias("cohort"), col).unionByName(
        pos.filter(F.col("died") == 1).select(F.lit("died").alias("cohort"), col))
    return ST.histogram(both, col, bins, by=["cohort"])


# T-18
def comorbidity_rates(clean: DataFrame, flags: Sequence[str] = FLAG_COLS) -> DataFrame:
    return ST.rate_by_flags(positives(clean), flags, "died", digits=2)


def comorbidity_rates_long(clean: DataFrame, flags: Sequence[str] = FLAG_COLS) -> DataFrame:
    """U-5: the rate table melted to (flag, status, death_rate)."""
    r = comorbidity_rates(clean, flags)
    return r.withColumnsRenamed({"without": "Without", "with": "With"}).unpivot(
        ["flag"], ["Without", "With"], "status", "death_rate")


# T-19
def missing_report(clean: DataFrame, flags: Sequence[str] = FLAG_COLS) -> DataFrame:
    return ST.null_profile(positives(clean), list(flags), keep_positive=False)


def impute_mode(df: DataFrame, cols: Sequence[str], max_percent: float = 100.0) -> DataFrame:
    """F-22: fill NULLs of each column with its mode (smallest on ties), but
    only of columns whose NULL share is at most ``max_percent``.

    One aggregation of (column, value) rows with map-side counts gives shares
    and modes of all columns of a type; they reach the rows as one map from a
    scalar subquery, so nothing goes through the driver.
    """
    kinds: dict[str, list[str]] = {}
    for c in cols:
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    filled = {}
    for same in kinds.values():
        counts = df.select(*same).unpivot([], same, "_col", "_v").groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_c"))
        known = F.col("_v").isNotNull()
        per = counts.groupBy("_col").agg(F.sum("_c").alias("_n"), F.sum(F.when(known, 0).otherwise(F.col("_c"))).alias("_null"),
                                         F.min(F.when(known, F.struct((-F.col("_c")).alias("_k"), "_v")))["_v"].alias("_mode"))
        low = per.filter((100.0 * F.col("_null") / F.col("_n") <= max_percent) & F.col("_mode").isNotNull())
        modes = low.agg(F.map_from_entries(F.collect_list(F.struct("_col", "_mode"))).alias("m")).scalar()  # one entry per column
        filled |= {c: F.coalesce(F.col(c), modes[c]) for c in same}
    return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def impute_low_missing(clean: DataFrame, flags: Sequence[str] = FLAG_COLS, max_percent: float = 10.0) -> DataFrame:
    """Impute by mode only the flags whose NULL share among positives is ≤ ``max_percent``."""
    return impute_mode(positives(clean), list(flags), max_percent)
