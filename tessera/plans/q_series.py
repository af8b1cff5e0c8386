"""Registered queries: reshaping and the SQL-expressible forecasting operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.operators import ordered as O
from tessera.operators import reshape as RS
from tessera.operators.filters import split_last_n_days
from tessera.plans import series as SE
from tessera.plans.registry import query
from tessera.sources import fixtures as X
from tessera.sources.catalog import Sources

TRAIN, TEST, STEP = 1095, 30, 30
DIG = 4


def _t(spark, sf_dir):
    return Sources.parquet_dir(spark, sf_dir)


def series(spark, sf_dir):
    """x_series: per order priority and TOTAL, dense daily sums with snap.

    The series table is small (series × days) and every forecasting query
    uses it several times (numbering, counts, spans, joins), so it is
    checkpointed once — later uses read it instead of re-aggregating the
    orders.
    """
    from tessera.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    t = _t(spark, sf_dir)
    return SE.daily_series(t.orders, "o_orderdate", "o_totalprice", "o_orderpriority",
                           X.x_calendar(t)).checkpoint(eager=True)


def forecast(spark, sf_dir):
    """x_forecast: the seasonal-naive forecast (y of 7 days earlier)."""
    return SE.seasonal_naive(series(spark, sf_dir))


SERIES_SQL = {
    "s_day": """
SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s
FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)
UNION ALL
SELECT 'TOTAL', CAST(o_orderdate AS DATE), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders GROUP BY CAST(o_orderdate AS DATE)""",
    "s_series": """
SELECT g.series_id, g.ds, CAST(COALESCE(ROUND(d.s, 2), 0) AS DOUBLE) AS y, c.snap_A AS snap
FROM (SELECT series_id, CAST(unnest(generate_series(mn, mx, INTERVAL 1 DAY)) AS DATE) AS ds
      FROM (SELECT series_id, MIN(ds) AS mn, MAX(ds) AS mx FROM s_day GROUP BY series_id) r) g
LEFT JOIN s_day d ON g.series_id = d.series_id AND g.ds = d.ds
LEFT JOIN x_calendar c ON c.date = g.ds""",
    "s_fc": "SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds) AS yhat FROM s_series",
    "s_hol": """
SELECT date AS ds, event_name_1 AS holiday, -3 AS lower_window, 3 AS upper_window FROM x_calendar WHERE event_name_1 IS NOT NULL
UNION ALL
SELECT date AS ds, event_name_2 AS holiday, -3, 3 FROM x_calendar WHERE event_name_2 IS NOT NULL""",
}


@query("melt_sales", """
WITH a AS (SELECT o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month,
             SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders GROUP BY ALL),
c AS (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders),
m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders)
SELECT c.o_orderstatus, c.o_orderpriority, m.month, CAST(COALESCE(a.s, 0) AS DOUBLE) AS sales
FROM c CROSS JOIN m LEFT JOIN a ON a.o_orderstatus = c.o_orderstatus AND a.o_orderpriority = c.o_orderpriority
  AND a.month = m.month""")
def q_melt_sales(spark, sf_dir):
    wide = RS.wide_by_month(_t(spark, sf_dir).orders, ["o_orderstatus", "o_orderpriority"], "o_orderdate",
                            "o_totalprice")
    return RS.melt(wide, ["o_orderstatus", "o_orderpriority"], var="month", val="sales")


@query("daily_series", "SELECT * FROM s_series", extra=SERIES_SQL)
def q_daily_series(spark, sf_dir):
    return series(spark, sf_dir)


@query("holidays", "SELECT * FROM s_hol", extra=SERIES_SQL)
def q_holidays(spark, sf_dir):
    return SE.holidays(X.x_calendar(_t(spark, sf_dir)))


@query("holiday_window", """
SELECT s.series_id, s.ds, s.y, s.snap, h.holiday, CAST(datediff('day', h.ds, s.ds) AS INTEGER) AS "offset"
FROM s_series s JOIN s_hol h ON s.ds BETWEEN h.ds - INTERVAL 3 DAY AND h.ds + INTERVAL 3 DAY""", extra=SERIES_SQL)
def q_holiday_window(spark, sf_dir):
    return J.holiday_window(series(spark, sf_dir), SE.holidays(X.x_calendar(_t(spark, sf_dir))), "ds")


@query("future_frame", """
SELECT series_id, CAST(unnest(generate_series(mx + INTERVAL 1 DAY, mx + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS ds
FROM (SELECT series_id, MAX(ds) AS mx FROM s_series GROUP BY series_id) m""", extra=SERIES_SQL)
def q_future_frame(spark, sf_dir):
    return RS.future_frame(series(spark, sf_dir), "ds", 30, ["series_id"])


@query("history_plus_future", """
SELECT DISTINCT series_id, ds FROM (
  SELECT series_id, ds FROM s_series
  UNION ALL
  SELECT series_id, CAST(unnest(generate_series(mx + INTERVAL 1 DAY, mx + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE)
  FROM (SELECT series_id, MAX(ds) AS mx FROM s_series GROUP BY series_id) m) u""", extra=SERIES_SQL)
def q_history_plus_future(spark, sf_dir):
    return RS.history_plus_future(series(spark, sf_dir), "ds", 30, ["series_id"])


@query("rolling_folds", f"""
WITH n AS (SELECT series_id, ds, y, snap, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i,
             COUNT(*) OVER (PARTITION BY series_id) AS n FROM s_series),
f AS (SELECT *, CAST(unnest(range(0, CAST(CASE WHEN n >= {TRAIN + TEST} THEN (n - {TRAIN + TEST}) // {STEP} + 1 ELSE 0 END AS BIGINT))) AS INTEGER) AS fold FROM n)
SELECT series_id, ds, y, snap, CAST(i AS INTEGER) AS row_index, fold,
  CASE WHEN i < fold * {STEP} + {TRAIN} THEN 'train' ELSE 'test' END AS role
FROM f WHERE i >= fold * {STEP} AND i < fold * {STEP} + {TRAIN + TEST}""", extra=SERIES_SQL)
def q_rolling_folds(spark, sf_dir):
    return O.rolling_folds(series(spark, sf_dir), ["series_id"], "ds", TRAIN, TEST, STEP)


@query("temporal_split", """
SELECT s.*, CASE WHEN s.ds > m.mx - INTERVAL 30 DAY THEN 'test' ELSE 'train' END AS split
FROM s_series s JOIN (SELECT series_id, MAX(ds) AS mx FROM s_series GROUP BY series_id) m USING (series_id)""",
       extra=SERIES_SQL)
def q_temporal_split(spark, sf_dir):
    return split_last_n_days(series(spark, sf_dir), "ds", 30, ["series_id"])


@query("rolling_mean", """
SELECT series_id, ds, y, snap, yhat, ROUND(AVG(yhat) OVER (PARTITION BY series_id ORDER BY ds
  ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING) + 1e-9, 4) AS yhat_smooth FROM s_fc""", extra=SERIES_SQL)
def q_rolling_mean(spark, sf_dir):
    r = O.rolling_mean(forecast(spark, sf_dir), ["series_id"], "ds", "yhat", 14, center=True, out="yhat_smooth")
    return r.withColumn("yhat_smooth", F.round(F.col("yhat_smooth") + F.lit(1e-9), 4))


@query("ffill", """
SELECT series_id, ds, y, snap, COALESCE(last_value(yhat IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ds
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS yhat FROM s_fc""", extra=SERIES_SQL)
def q_ffill(spark, sf_dir):
    return O.ffill(forecast(spark, sf_dir), ["series_id"], "ds", "yhat", default=0.0)


@query("acf", """
WITH n AS (SELECT series_id, y AS x, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i FROM s_series),
m AS (SELECT series_id, AVG(x) AS m FROM n GROUP BY series_id),
c AS (SELECT n.series_id, i, x - m AS d FROM n JOIN m USING (series_id)),
ss AS (SELECT series_id, SUM(d * d) AS ss FROM c GROUP BY series_id),
lags AS (SELECT CAST(unnest(range(0, 11)) AS INTEGER) AS lag)
SELECT a.series_id, lags.lag, ROUND(SUM(a.d * b.d) / ss.ss + 1e-9, 9) AS acf
FROM c a CROSS JOIN lags JOIN c b ON a.series_id = b.series_id AND b.i = a.i + lags.lag
JOIN ss ON ss.series_id = a.series_id GROUP BY a.series_id, lags.lag, ss.ss""", extra=SERIES_SQL)
def q_acf(spark, sf_dir):
    r = O.acf(series(spark, sf_dir), ["series_id"], "ds", "y", 10)
    return r.withColumn("acf", F.round(F.col("acf") + F.lit(1e-9), 9))


def metrics_sql(src: str, by: str, d: int = DIG) -> str:
    e = "(CAST(y AS DOUBLE) - CAST(yhat AS DOUBLE))"
    return f"""
SELECT {by}, COUNT(*) AS n, ROUND(SQRT(AVG({e} * {e})) + 1e-9, {d}) AS rmse, ROUND(AVG(ABS({e})) + 1e-9, {d}) AS mae,
  ROUND(100.0 * AVG(CASE WHEN y > 0 THEN ABS({e} / y) END) + 1e-9, {d}) AS mape,
  ROUND(100.0 * AVG(CASE WHEN ABS(y) + ABS(yhat) <> 0 THEN 2 * ABS(yhat - y) / (ABS(y) + ABS(yhat)) END) + 1e-9, {d}) AS smape,
  ROUND(1.0 - CASE WHEN COUNT(*) * VAR_POP(y) = 0 THEN NULL ELSE SUM({e} * {e}) / (COUNT(*) * VAR_POP(y)) END + 1e-9, {d}) AS r2
FROM {src} WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY {by}"""


@query("forecast_metrics", metrics_sql("s_fc", "series_id"), extra=SERIES_SQL)
def q_forecast_metrics(spark, sf_dir):
    return SE.forecast_metrics(forecast(spark, sf_dir), ["series_id"], digits=DIG)


FOLDS_SQL = f"""
WITH n AS (SELECT series_id, ds, y, yhat, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i,
             COUNT(*) OVER (PARTITION BY series_id) AS n FROM s_fc),
f AS (SELECT *, CAST(unnest(range(0, CAST(CASE WHEN n >= {TRAIN + TEST} THEN (n - {TRAIN + TEST}) // {STEP} + 1 ELSE 0 END AS BIGINT))) AS INTEGER) AS fold FROM n),
r AS (SELECT *, CASE WHEN i < fold * {STEP} + {TRAIN} THEN 'train' ELSE 'test' END AS role
      FROM f WHERE i >= fold * {STEP} AND i < fold * {STEP} + {TRAIN + TEST}),
rng AS (SELECT series_id, fold, MIN(CASE WHEN role = 'train' THEN ds END) AS train_start,
          MAX(CASE WHEN role = 'train' THEN ds END) AS train_end, MIN(CASE WHEN role = 'test' THEN ds END) AS test_start,
          MAX(CASE WHEN role = 'test' THEN ds END) AS test_end FROM r GROUP BY series_id, fold),
m AS ({metrics_sql("(SELECT * FROM r WHERE role = 'test') t", "series_id, fold")})
SELECT rng.*, m.n, m.rmse, m.mae, m.mape, m.smape, m.r2 FROM rng LEFT JOIN m USING (series_id, fold)"""


def _fold_metrics(spark, sf_dir):
    return SE.fold_metrics(forecast(spark, sf_dir), TRAIN, TEST, STEP, ["series_id"], digits=DIG)


@query("fold_metrics", FOLDS_SQL, extra=SERIES_SQL)
def q_fold_metrics(spark, sf_dir):
    return _fold_metrics(spark, sf_dir)


def _describe_by_sql(src: str, cols: list[str], by: str, digits: int = 2) -> str:
    def r(x):
        return f"ROUND(({x}) + 1e-9, {digits})"
    return " UNION ALL ".join(f"""
SELECT {by}, '{c}' AS "column", COUNT(v) AS count, {r('AVG(v)')} AS mean, {r('STDDEV_SAMP(v)')} AS std, {r('MIN(v)')} AS min,
  {r('quantile_cont(v, 0.25)')} AS p25, {r('quantile_cont(v, 0.5)')} AS p50, {r('quantile_cont(v, 0.75)')} AS p75,
  {r('MAX(v)')} AS max FROM (SELECT {by}, CAST({c} AS DOUBLE) AS v FROM {src} WHERE {c} IS NOT NULL) z GROUP BY {by}"""
                             for c in cols)


@query("cv_summary", f"WITH fm AS ({FOLDS_SQL}) " + _describe_by_sql("fm", ["rmse", "mae", "mape", "r2"], "series_id"),
       extra=SERIES_SQL)
def q_cv_summary(spark, sf_dir):
    return SE.cv_summary(_fold_metrics(spark, sf_dir), ["series_id"])


@query("weak_folds", f"WITH fm AS ({FOLDS_SQL}) SELECT * FROM fm WHERE r2 < 0.2", extra=SERIES_SQL)
def q_weak_folds(spark, sf_dir):
    return SE.weak_folds(_fold_metrics(spark, sf_dir))


ELIGIBLE_SQL = """
SELECT holiday, CAST(SUM(c) AS BIGINT) AS count FROM (
  SELECT event_name_1 AS holiday, COUNT(*) AS c FROM x_calendar
  WHERE snap_A = 1 AND COALESCE(event_name_1, event_name_2) IS NOT NULL AND event_name_1 IS NOT NULL GROUP BY 1
  UNION ALL
  SELECT event_name_2 AS holiday, COUNT(*) AS c FROM x_calendar
  WHERE snap_A = 1 AND COALESCE(event_name_1, event_name_2) IS NOT NULL AND event_name_2 IS NOT NULL GROUP BY 1) u
GROUP BY holiday"""


@query("holiday_counts_with_flag", ELIGIBLE_SQL)
def q_holiday_counts(spark, sf_dir):
    return SE.holiday_counts_with_flag(X.x_calendar(_t(spark, sf_dir)), "snap_A")


@query("interaction_flag", f"""
WITH e AS (SELECT holiday FROM ({ELIGIBLE_SQL}) c WHERE count >= 3)
SELECT s.*, CASE WHEN c.snap_A = 1 AND (c.event_name_1 IN (SELECT holiday FROM e) OR c.event_name_2 IN (SELECT holiday FROM e))
  THEN 1 ELSE 0 END AS snap_holiday_interaction
FROM s_series s LEFT JOIN x_calendar c ON c.date = s.ds""", extra=SERIES_SQL)
def q_interaction_flag(spark, sf_dir):
    return SE.interaction_regressor(series(spark, sf_dir), X.x_calendar(_t(spark, sf_dir)), "snap_A", 3)


@query("regressor_last_year", """
WITH fr AS (SELECT DISTINCT series_id, ds FROM (
  SELECT series_id, ds FROM s_series
  UNION ALL
  SELECT series_id, CAST(unnest(generate_series(mx + INTERVAL 1 DAY, mx + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE)
  FROM (SELECT series_id, MAX(ds) AS mx FROM s_series GROUP BY series_id) m) u),
sh AS (SELECT CAST(date + INTERVAL 1 YEAR AS DATE) AS k, arg_max(snap_A, date) AS snap FROM x_calendar GROUP BY 1),
j AS (SELECT fr.series_id, fr.ds, sh.snap FROM fr LEFT JOIN sh ON fr.ds = sh.k)
SELECT series_id, ds, COALESCE(last_value(snap IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ds
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS snap FROM j""", extra=SERIES_SQL)
def q_regressor_last_year(spark, sf_dir):
    fr = RS.history_plus_future(series(spark, sf_dir), "ds", 30, ["series_id"])
    cal = X.x_calendar(_t(spark, sf_dir)).select(F.col("date").alias("ds"), F.col("snap_A").alias("snap"))
    return SE.future_regressor(fr, cal, "snap", "last_year", default=0)


@query("regressor_weekday", """
WITH fr AS (SELECT series_id, CAST(unnest(generate_series(mx + INTERVAL 1 DAY, mx + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS ds
  FROM (SELECT series_id, MAX(ds) AS mx FROM s_series GROUP BY series_id) m),
lk AS (SELECT CAST(isodow(ds) - 1 AS INTEGER) AS dw, arg_max(snap, ds) AS snap FROM s_series GROUP BY 1)
SELECT fr.series_id, fr.ds, lk.snap FROM fr LEFT JOIN lk ON CAST(isodow(fr.ds) - 1 AS INTEGER) = lk.dw""",
       extra=SERIES_SQL)
def q_regressor_weekday(spark, sf_dir):
    s = series(spark, sf_dir)
    fr = RS.future_frame(s, "ds", 30, ["series_id"])
    return SE.future_regressor(fr, s.select("ds", "snap"), "snap", "weekday")


@query("forecast_frame", """
SELECT f.series_id, f.ds, f.yhat, a.y FROM s_fc f
LEFT JOIN s_series a ON a.series_id = f.series_id AND a.ds = f.ds
JOIN (SELECT series_id, MAX(ds) AS last FROM s_series GROUP BY series_id) l ON l.series_id = f.series_id
WHERE f.ds >= l.last + INTERVAL 1 DAY - INTERVAL 365 DAY""", extra=SERIES_SQL)
def q_forecast_frame(spark, sf_dir):
    s = series(spark, sf_dir)
    return SE.forecast_frame(SE.seasonal_naive(s), s, 365)


def _box_sql(src: str, by: str) -> str:
    iq = "v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""
WITH b AS ({src}),
q AS (SELECT {by}, MIN(v) AS min, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
        quantile_cont(v, 0.75) AS q3, MAX(v) AS max FROM b GROUP BY {by})
SELECT q.*, MIN(CASE WHEN {iq} THEN v END) AS whisker_low, MAX(CASE WHEN {iq} THEN v END) AS whisker_high,
  CAST(SUM(CASE WHEN {iq} THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM q JOIN b USING ({by}) GROUP BY ALL"""


@query("residual_by_weekday", _box_sql("""
SELECT series_id, strftime(ds, '%A') AS weekday, CAST(y AS DOUBLE) - CAST(yhat AS DOUBLE) AS v FROM s_fc
WHERE yhat IS NOT NULL""", "series_id, weekday"), extra=SERIES_SQL)
def q_residual_by_weekday(spark, sf_dir):
    return SE.residual_by_weekday(forecast(spark, sf_dir))


_EFFECT_SQL = """
SELECT f.series_id, h.holiday, CAST(f.y AS DOUBLE) - CAST(f.yhat AS DOUBLE) AS v FROM s_fc f JOIN s_hol h ON f.ds = h.ds
{} WHERE f.yhat IS NOT NULL"""


def _residual_effects(spark, sf_dir, last_days=None):
    r = O.residuals(forecast(spark, sf_dir))
    return SE.holiday_effects(r, SE.holidays(X.x_calendar(_t(spark, sf_dir))), "residual", last_days=last_days)


@query("holiday_effects", _box_sql(_EFFECT_SQL.format(""), "series_id, holiday"), extra=SERIES_SQL)
def q_holiday_effects(spark, sf_dir):
    return _residual_effects(spark, sf_dir)


@query("holiday_effects_last_year", _box_sql(_EFFECT_SQL.format("""
JOIN (SELECT series_id, MAX(ds) AS mx FROM s_fc WHERE yhat IS NOT NULL GROUP BY series_id) l
  ON l.series_id = f.series_id AND f.ds >= l.mx - INTERVAL 365 DAY"""), "series_id, holiday"), extra=SERIES_SQL)
def q_holiday_effects_last_year(spark, sf_dir):
    """R-10: the same over the last 365 days of each series."""
    return _residual_effects(spark, sf_dir, last_days=365)


@query("regressor_ffill", """
WITH f AS (SELECT series_id, CAST(unnest(generate_series(mx - INTERVAL 40 DAY, mx + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS ds
           FROM (SELECT series_id, MAX(ds) AS mx FROM s_series GROUP BY series_id) m),
k AS (SELECT date AS ds, snap_A AS snap FROM x_calendar WHERE day(date) % 3 = 0)
SELECT f.series_id, f.ds, COALESCE(last_value(k.snap IGNORE NULLS) OVER (PARTITION BY f.series_id ORDER BY f.ds
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS snap
FROM f LEFT JOIN k ON f.ds = k.ds""", extra=SERIES_SQL)
def q_regressor_ffill(spark, sf_dir):
    """J-7: a regressor known on some days only, carried forward over the end of the history."""
    last = series(spark, sf_dir).groupBy("series_id").agg(F.max("ds").alias("mx"))
    days = F.explode(F.sequence(F.date_sub("mx", 40), F.date_add("mx", 30))).alias("ds")
    known = X.x_calendar(_t(spark, sf_dir)).filter(F.dayofmonth("date") % 3 == 0).select(F.col("date").alias("ds"), F.col("snap_A").alias("snap"))
    return SE.future_regressor(last.select("series_id", days), known, "snap", "ffill", default=0)


@query("holiday_names", """
SELECT date AS ds, CASE WHEN COALESCE(event_name_1, '') || COALESCE(event_name_2, '') = '' THEN 'None'
  ELSE COALESCE(event_name_1, '') || COALESCE(event_name_2, '') END AS holiday_name FROM x_calendar""")
def q_holiday_names(spark, sf_dir):
    return SE.holiday_names(X.x_calendar(_t(spark, sf_dir)))


# ---- fitted forecaster: not SQL-expressible; row counts here, properties in tests

def _fc_all(spark, sf_dir):
    """The fitted forecast of every series; each is fitted in its own group."""
    from tessera.operators import forecast as FC
    s = series(spark, sf_dir)
    cal = X.x_calendar(_t(spark, sf_dir))
    fut = SE.future_regressor(RS.future_frame(s, "ds", 30, ["series_id"]),
                              cal.select(F.col("date").alias("ds"), F.col("snap_A").alias("snap")), "snap",
                              "last_year", default=0)
    return FC.forecast(s.withColumn("snap", F.col("snap").cast("double")), 30, SE.holidays(cal), ["snap"],
                       fut.withColumn("snap", F.col("snap").cast("double")), train_days=TRAIN)


@query("forecast")
def q_forecast(spark, sf_dir):
    return _fc_all(spark, sf_dir)


@query("components")
def q_components(spark, sf_dir):
    from tessera.operators import forecast as FC
    return FC.components(_fc_all(spark, sf_dir))


@query("cross_validate")
def q_cross_validate(spark, sf_dir):
    from tessera.operators import forecast as FC
    s = series(spark, sf_dir).withColumn("snap", F.col("snap").cast("double"))
    cv = FC.cross_validate(s, TRAIN, TEST, STEP, SE.holidays(X.x_calendar(_t(spark, sf_dir))), ["snap"])
    return SE.forecast_metrics(cv.filter(F.col("role") == "test"), ["series_id", "fold"], digits=DIG)


def _pacf_sql(rows: str, lags: int) -> str:
    """Autocorrelations of (series_id, ds, x) rows and the Durbin-Levinson recursion on them."""
    return f"""
SELECT * FROM (WITH RECURSIVE n AS (SELECT series_id, x, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i FROM ({rows}) z),
m AS (SELECT series_id, AVG(x) AS m FROM n GROUP BY series_id),
c AS (SELECT n.series_id, i, x - m AS d FROM n JOIN m USING (series_id)),
ss AS (SELECT series_id, SUM(d * d) AS ss FROM c GROUP BY series_id),
lags AS (SELECT CAST(unnest(range(0, {lags + 1})) AS INTEGER) AS lag),
a AS (SELECT a.series_id, lags.lag, SUM(a.d * b.d) / ss.ss AS acf FROM c a CROSS JOIN lags
      JOIN c b ON a.series_id = b.series_id AND b.i = a.i + lags.lag JOIN ss ON ss.series_id = a.series_id GROUP BY a.series_id, lags.lag, ss.ss),
r AS (SELECT series_id, list(acf ORDER BY lag) AS r FROM a GROUP BY series_id),
d AS (SELECT series_id, r, CAST(0 AS BIGINT) AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS v, CAST(1 AS DOUBLE) AS p FROM r
  UNION ALL
  SELECT series_id, r, k + 1, list_concat(list_transform(range(1, k + 1), lambda j: phi[j] - p * phi[k + 1 - j]), [p]), v * (1 - p * p), p
  FROM (SELECT series_id, r, k, phi, v, (r[k + 2] - COALESCE(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0)) / v AS p
        FROM d WHERE k < {lags}) s)
SELECT series_id, CAST(k AS INTEGER) AS lag, ROUND(p + 1e-9, 6) AS pacf FROM d) q"""


def _rounded(pacf):
    return pacf.withColumn("pacf", F.round(F.col("pacf") + F.lit(1e-9), 6))


@query("pacf", _pacf_sql("SELECT series_id, ds, y AS x FROM s_series", 10), extra=SERIES_SQL)
def q_pacf(spark, sf_dir):
    from tessera.operators import forecast as FC
    return _rounded(FC.pacf(series(spark, sf_dir), "y", 10))


@query("residual_pacf", _pacf_sql("SELECT series_id, ds, CAST(y AS DOUBLE) - CAST(yhat AS DOUBLE) AS x FROM s_fc WHERE yhat IS NOT NULL", 14), extra=SERIES_SQL)
def q_residual_pacf(spark, sf_dir):
    """R-12: partial autocorrelation of the forecast residuals, lags 0..14."""
    from tessera.operators import forecast as FC
    return _rounded(FC.pacf(O.residuals(forecast(spark, sf_dir)), "residual", 14))


@query("residual_acf", """
WITH r AS (SELECT series_id, ds, CAST(y AS DOUBLE) - CAST(yhat AS DOUBLE) AS x FROM s_fc WHERE yhat IS NOT NULL),
n AS (SELECT series_id, x, row_number() OVER (PARTITION BY series_id ORDER BY ds) - 1 AS i FROM r),
m AS (SELECT series_id, AVG(x) AS m FROM n GROUP BY series_id),
c AS (SELECT n.series_id, i, x - m AS d FROM n JOIN m USING (series_id)),
ss AS (SELECT series_id, SUM(d * d) AS ss FROM c GROUP BY series_id),
lags AS (SELECT CAST(unnest(range(0, 15)) AS INTEGER) AS lag)
SELECT a.series_id, lags.lag, ROUND(SUM(a.d * b.d) / ss.ss + 1e-9, 9) AS acf
FROM c a CROSS JOIN lags JOIN c b ON a.series_id = b.series_id AND b.i = a.i + lags.lag
JOIN ss ON ss.series_id = a.series_id GROUP BY a.series_id, lags.lag, ss.ss""", extra=SERIES_SQL)
def q_residual_acf(spark, sf_dir):
    """R-12: autocorrelation of the forecast residuals, lags 0..14."""
    from tessera.operators.ordered import residuals
    r = residuals(forecast(spark, sf_dir))
    a = O.acf(r, ["series_id"], "ds", "residual", 14)
    return a.withColumn("acf", F.round(F.col("acf") + F.lit(1e-9), 9))


@query("holiday_effects_model")
def q_holiday_effects_model(spark, sf_dir):
    """R-10: the fitted holiday component by series and holiday name (box statistics)."""
    fc = _fc_all(spark, sf_dir)
    return SE.holiday_effects(fc.filter(F.col("role") == "train"), SE.holidays(X.x_calendar(_t(spark, sf_dir))), "holidays")
