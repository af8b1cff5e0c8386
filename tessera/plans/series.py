"""Daily sales series, holidays, regressors and forecast evaluation
(SURVEY §2.11: R-1, R-2, R-6..R-8, R-10, R-12, R-13, R-15).

Everything here is SQL-expressible Spark: grouped aggregations, windows
partitioned by series, equi-joins on dates.  The model fit itself is in
``tessera.operators.forecast``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import joins as J
from tessera.operators import stats as ST
from tessera.operators.filters import last_n_days
from tessera.operators.ordered import residuals, rolling_folds
from tessera.operators.reshape import union_events

TOTAL = "TOTAL"


# R-1
def daily_series(facts: DataFrame, date_col: str, value_col: str, by: str, calendar: DataFrame,
                 snap_col: str = "snap_A", total: bool = True) -> DataFrame:
    """(series_id, ds, y, snap): daily sums per ``by`` value (and a TOTAL
    series), dense from each series' first to last day, absent days = 0.

    The day sums are one aggregation; the TOTAL series is re-aggregated
    from those (days × series rows, not the facts).  Each series' span is
    a grouped min/max of the same small table and the dense grid is one
    ``sequence`` per series (no cross join, no scalar subquery); the
    calendar is a lookup join on the date.
    """
    day = facts.groupBy(F.col(by).alias("series_id"), F.to_date(date_col).alias("ds")).agg(
        F.sum(S.money(value_col)).alias("_s"))
    if total:
        day = day.unionByName(day.groupBy("ds").agg(F.sum("_s").alias("_s"))
                              .select(F.lit(TOTAL).alias("series_id"), "ds", "_s"))
    span = day.groupBy("series_id").agg(F.min("ds").alias("_lo"), F.max("ds").alias("_hi"))
    grid = span.select("series_id", F.explode(F.sequence("_lo", "_hi")).alias("ds"))
    dense = grid.join(day, ["series_id", "ds"], "left").select(
        "series_id", "ds", F.coalesce(F.round("_s", 2), F.lit(0)).cast("double").alias("y"))
    cal = calendar.select(F.col("date").alias("ds"), F.col(snap_col).alias("snap"))
    return J.lookup_join(dense, cal, "ds")


def seasonal_naive(series: DataFrame, lag: int = 7) -> DataFrame:
    """Deterministic reference forecast: yhat = y ``lag`` days earlier."""
    w = Window.partitionBy("series_id").orderBy("ds")
    return series.withColumn("yhat", F.lag("y", lag).over(w))


# R-2
def holidays(calendar: DataFrame, lower: int = -3, upper: int = 3) -> DataFrame:
    return union_events(calendar, "date", ["event_name_1", "event_name_2"], lower, upper)


# R-6
def forecast_metrics(df: DataFrame, by: Sequence[str] = (), actual: str = "y", predicted: str = "yhat",
                     digits: int | None = 6) -> DataFrame:
    """RMSE, MAE, MAPE (rows with y > 0), SMAPE (rows with |y|+|ŷ| ≠ 0), R².

    One aggregation; rows with a NULL prediction are left out.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    d = df.filter(y.isNotNull() & p.isNotNull())
    e = y - p
    sm_den = F.abs(y) + F.abs(p)
    agg = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(100.0) * F.avg(F.when(y > 0, F.abs(e / y)))).alias("mape"),
        (F.lit(100.0) * F.avg(F.when(sm_den != 0, 2 * F.abs(p - y) / sm_den))).alias("smape"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.count(F.lit(1)) * F.var_pop(y))).alias("r2"))
    if digits is None:
        return agg
    return agg.select(*by, "n", *[S.round_nudged(c, digits).alias(c) for c in ["rmse", "mae", "mape", "smape", "r2"]])


# R-5 / R-7 with a given forecast
def fold_metrics(forecast: DataFrame, train: int, test: int, step: int, by: Sequence[str] = ("series_id",),
                 digits: int | None = 6) -> DataFrame:
    """Metrics per rolling-origin fold over the test rows of each fold, plus fold date ranges."""
    by = list(by)
    f = rolling_folds(forecast, by, "ds", train, test, step)
    rng = f.groupBy(*by, "fold").agg(
        F.min(F.when(F.col("role") == "train", F.col("ds"))).alias("train_start"),
        F.max(F.when(F.col("role") == "train", F.col("ds"))).alias("train_end"),
        F.min(F.when(F.col("role") == "test", F.col("ds"))).alias("test_start"),
        F.max(F.when(F.col("role") == "test", F.col("ds"))).alias("test_end"))
    m = forecast_metrics(f.filter(F.col("role") == "test"), by + ["fold"], digits=digits)
    return rng.join(m, by + ["fold"], "left")


def cv_summary(fold_metrics_df: DataFrame, by: Sequence[str] = ("series_id",), digits: int = 2) -> DataFrame:
    """R-7: describe of the fold metrics (per series)."""
    return ST.describe(fold_metrics_df, ["rmse", "mae", "mape", "r2"], digits=digits, by=list(by))


def weak_folds(fold_metrics_df: DataFrame, r2_below: float = 0.2) -> DataFrame:
    return fold_metrics_df.filter(F.col("r2") < r2_below)


# R-8
def holiday_counts_with_flag(calendar: DataFrame, flag: str, events: Sequence[str] = ("event_name_1", "event_name_2")
                             ) -> DataFrame:
    """Days with the flag set, counted per holiday over all event columns (J-10)."""
    events = list(events)
    on = calendar.filter((F.col(flag) == 1) & F.coalesce(*[F.col(e) for e in events]).isNotNull())
    parts = [on.filter(F.col(e).isNotNull()).groupBy(F.col(e).alias("holiday")).agg(
        F.count(F.lit(1)).alias("count")) for e in events]
    out = parts[0]
    for p in parts[1:]:
        out = J.add_counts(out, p, "holiday")
    return out


def eligible_holidays(calendar: DataFrame, flag: str, min_occurrence: int = 3) -> DataFrame:
    """Count ≥ ``min_occurrence`` (inclusive)."""
    return holiday_counts_with_flag(calendar, flag).filter(F.col("count") >= min_occurrence)


def interaction_regressor(series: DataFrame, calendar: DataFrame, flag: str, min_occurrence: int = 3,
                          events: Sequence[str] = ("event_name_1", "event_name_2"), out: str = "snap_holiday_interaction"
                          ) -> DataFrame:
    """1 when the flag is set and a day's event is an eligible holiday.

    The eligible list is bounded by the number of distinct holiday names;
    it is joined as a small lookup (no Python row function).
    """
    events = list(events)
    elig = eligible_holidays(calendar, flag, min_occurrence).select(F.col("holiday").alias("_h"), F.lit(1).alias("_e"))
    cal = calendar.select(F.col("date").alias("ds"), F.col(flag).alias("_flag"), *events)
    for i, e in enumerate(events):
        cal = J.lookup_join(cal, elig.withColumnsRenamed({"_h": e, "_e": f"_e{i}"}), e)
    hit = F.greatest(*[F.coalesce(F.col(f"_e{i}"), F.lit(0)) for i in range(len(events))])
    cal = cal.select("ds", F.when((F.col("_flag") == 1) & (hit == 1), 1).otherwise(0).alias(out))
    return J.lookup_join(series, cal, "ds")


def holiday_names(calendar: DataFrame, none: str = "None") -> DataFrame:
    """F-23 on the calendar: concatenated event names, '' → 'None'."""
    return calendar.select(F.col("date").alias("ds"), S.joined_names(["event_name_1", "event_name_2"], none)
                           .alias("holiday_name"))


# R-10
def holiday_effects(forecast: DataFrame, hol: DataFrame, effect: str = "residual", by: Sequence[str] = ("series_id",),
                    last_days: int | None = None) -> DataFrame:
    """Box statistics of a per-day effect by series and holiday name (inner
    join on ds), over all days or the last ``last_days`` of each series."""
    if last_days is not None:
        forecast = last_n_days(forecast, "ds", last_days, by=list(by))
    j = forecast.join(hol.select("ds", "holiday"), "ds", "inner")
    return ST.box_stats(j, effect, [*by, "holiday"])


# R-12
def residual_by_weekday(forecast: DataFrame, by: Sequence[str] = ("series_id",)) -> DataFrame:
    r = residuals(forecast)
    return ST.box_stats(r.withColumn("weekday", S.day_name("ds")), "residual", [*by, "weekday"])


# R-13
def forecast_frame(forecast: DataFrame, actuals: DataFrame, window_days: int = 365,
                   by: Sequence[str] = ("series_id",)) -> DataFrame:
    """Forecast ⟕ actuals (future rows kept), from ``window_days`` before the
    first forecast day after the history."""
    by = list(by)
    j = forecast.select(*by, "ds", "yhat").join(actuals.select(*by, "ds", "y"), by + ["ds"], "left")
    last = actuals.groupBy(*by).agg(F.max("ds").alias("_last"))
    j = j.join(last, by, "inner")
    return j.filter(F.col("ds") >= F.date_sub(F.date_add("_last", 1), window_days)).drop("_last")


# R-15 policies
def future_regressor(frame: DataFrame, lookup: DataFrame, value_col: str, policy: str = "ffill",
                     default: float = 0.0, by: Sequence[str] = ("series_id",)) -> DataFrame:
    """Regressor for future days: 'ffill' (J-7), 'weekday' (J-9), 'last_year' (J-8)."""
    by = list(by)
    if policy == "ffill":
        j = frame.join(lookup.select(F.col("ds"), F.col(value_col)), "ds", "left")
        w = Window.partitionBy(*by).orderBy("ds").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return j.withColumn(value_col, F.coalesce(F.last(value_col, True).over(w), F.lit(default)))
    if policy == "weekday":
        return J.lookup_weekday(frame, lookup, "ds", value_col, out=value_col)
    if policy == "last_year":
        out = J.lookup_last_year(frame, lookup, "ds", value_col, out=value_col)
        w = Window.partitionBy(*by).orderBy("ds").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return out.withColumn(value_col, F.coalesce(F.last(value_col, True).over(w), F.lit(default)))
    raise ValueError(policy)
