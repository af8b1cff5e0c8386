"""Additive daily forecaster fitted per series and fold.

Contract kept from the original workflow: trend with change points,
weekly and yearly Fourier seasonality, holiday windows, extra regressors
→ ``yhat, yhat_lower, yhat_upper`` and additive components.  Features
are built in Spark (``ts_features``: trigonometric columns and an
equi-joined holiday window); the fit is a ridge regression solved with
numpy inside ``groupBy(series_id, fold).applyInPandas`` — every group is
bounded by the training window length, and all (series, fold) groups
run in parallel.  Numeric equality with the original (Bayesian)
forecaster is not a goal.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import joins as J
from tessera.operators.ordered import acf as _acf
from tessera.operators.ordered import rolling_folds

# Defaults of the public forecaster's documentation: yearly order 10,
# weekly order 3, 25 change points in the first 80 % of the history,
# 80 % intervals.
YEARLY_ORDER, WEEKLY_ORDER, N_CHANGEPOINTS, CP_RANGE, INTERVAL = 10, 3, 25, 0.8, 0.8
ORIGIN = "1970-01-01"


def ts_features(df: DataFrame, holidays: DataFrame | None = None, date_col: str = "ds",
                yearly: int = YEARLY_ORDER, weekly: int = WEEKLY_ORDER) -> tuple[DataFrame, dict]:
    """R-3: add t (days), Fourier and holiday-window indicator columns.

    Holiday indicators are one column per (holiday, offset) pair: the
    holiday window is an equi-join on exploded offsets (J-11), then a
    pivot with the explicit (bounded) list of pairs.  Returns the frame
    and the feature blocks {block: [columns]}.
    """
    t = F.datediff(F.to_date(date_col), F.lit(ORIGIN).cast("date")).cast("double")
    out = df.withColumn("_t", t)
    blocks = {"weekly": [], "yearly": [], "holidays": []}
    cols = {}
    for n in range(1, weekly + 1):
        for fn, name in ((F.sin, "sin"), (F.cos, "cos")):
            c = f"_w{name}{n}"
            cols[c] = fn(F.lit(2 * math.pi * n / 7.0) * F.col("_t"))
            blocks["weekly"].append(c)
    for n in range(1, yearly + 1):
        for fn, name in ((F.sin, "sin"), (F.cos, "cos")):
            c = f"_y{name}{n}"
            cols[c] = fn(F.lit(2 * math.pi * n / 365.25) * F.col("_t"))
            blocks["yearly"].append(c)
    out = out.withColumns(cols)
    if holidays is not None:
        days = out.select(F.to_date(date_col).alias("_d")).distinct()
        win = J.holiday_window(days, holidays, "_d")
        win = win.withColumn("_hk", F.concat_ws("@", "holiday", F.col("offset").cast("string")))
        keys = sorted(r[0] for r in win.select("_hk").distinct().collect())  # holidays × offsets (bounded)
        names = {k: f"_h{i}" for i, k in enumerate(keys)}
        if keys:
            wide = win.groupBy("_d").pivot("_hk", keys).count()
            wide = wide.select("_d", *[F.coalesce(F.col(f"`{k}`"), F.lit(0)).cast("double").alias(names[k])
                                       for k in keys])
            out = J.lookup_join(out.withColumn("_d", F.to_date(date_col)), wide, "_d").drop("_d")
            out = out.fillna(0.0, subset=list(names.values()))
            blocks["holidays"] = list(names.values())
    return out, blocks


OUT_SCHEMA = T.StructType([
    T.StructField("series_id", T.StringType()), T.StructField("fold", T.IntegerType()),
    T.StructField("ds", T.DateType()), T.StructField("role", T.StringType()),
    T.StructField("y", T.DoubleType()), T.StructField("yhat", T.DoubleType()),
    T.StructField("yhat_lower", T.DoubleType()), T.StructField("yhat_upper", T.DoubleType()),
    T.StructField("trend", T.DoubleType()), T.StructField("weekly", T.DoubleType()),
    T.StructField("yearly", T.DoubleType()), T.StructField("holidays", T.DoubleType()),
    T.StructField("extra_regressors", T.DoubleType()),
])


def _fit_predict(blocks: dict, regressors: Sequence[str], ridge: float, n_cp: int, interval: float,
                 cp_ridge: float = 1e-2):
    feat_blocks = {k: list(v) for k, v in blocks.items()}
    feat_blocks["extra_regressors"] = list(regressors)
    lo_q, hi_q = (1 - interval) / 2, 1 - (1 - interval) / 2

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        tr = pdf["role"].to_numpy() == "train"
        t = pdf["_t"].to_numpy(dtype=float)
        t0, t1 = t[tr].min(), t[tr].max()
        ts = (t - t0) / max(t1 - t0, 1.0)
        cps = np.quantile(ts[tr][: max(1, int(CP_RANGE * tr.sum()))], np.linspace(0, 1, n_cp + 2)[1:-1]) \
            if tr.sum() > 2 else np.array([])
        trend_x = np.column_stack([np.ones_like(ts), ts] + [np.maximum(0.0, ts - c) for c in cps])
        mats = {"trend": trend_x}
        for b, cols in feat_blocks.items():
            mats[b] = pdf[cols].to_numpy(dtype=float) if cols else np.zeros((len(pdf), 0))
        x = np.column_stack([mats[b] for b in ["trend", "weekly", "yearly", "holidays", "extra_regressors"]])
        y = pdf["y"].to_numpy(dtype=float)
        fit = tr & ~np.isnan(y)
        xt, yt = x[fit], y[fit]
        scale = np.abs(yt).mean() if fit.any() and np.abs(yt).mean() > 0 else 1.0
        # intercept and base slope unpenalised; change points shrunk harder
        # than seasonal/holiday/regressor terms (sparse trend changes)
        pen = np.full(x.shape[1], ridge)
        pen[:2] = 0.0
        pen[2:trend_x.shape[1]] = cp_ridge
        a = xt.T @ xt + np.diag(pen * max(len(yt), 1))
        coef = np.linalg.lstsq(a, xt.T @ (yt / scale), rcond=None)[0] * scale
        parts, start = {}, 0
        for b in ["trend", "weekly", "yearly", "holidays", "extra_regressors"]:
            w = mats[b].shape[1]
            parts[b] = mats[b] @ coef[start:start + w] if w else np.zeros(len(pdf))
            start += w
        yhat = sum(parts.values())
        res = yt - yhat[fit]
        ql, qh = (np.quantile(res, lo_q), np.quantile(res, hi_q)) if res.size else (0.0, 0.0)
        return pd.DataFrame({
            "series_id": pdf["series_id"].astype(str).to_numpy(), "fold": pdf["fold"].astype("int32").to_numpy(),
            "ds": pdf["ds"].to_numpy(), "role": pdf["role"].to_numpy(), "y": y, "yhat": yhat,
            "yhat_lower": yhat + ql, "yhat_upper": yhat + qh, "trend": parts["trend"], "weekly": parts["weekly"],
            "yearly": parts["yearly"], "holidays": parts["holidays"], "extra_regressors": parts["extra_regressors"]})
    return fn


def fit_predict(frame: DataFrame, blocks: dict, regressors: Sequence[str] = (), ridge: float = 1e-4,
                n_changepoints: int = N_CHANGEPOINTS, interval: float = INTERVAL) -> DataFrame:
    """R-4 / R-9 / R-11: one ridge fit per (series_id, fold) on its 'train'
    rows; predictions, 80 % residual-quantile band and components for all
    rows of the group (train, test and future)."""
    need = ["series_id", "fold", "ds", "role", "y", "_t"] + [c for v in blocks.values() for c in v] + list(regressors)
    f = frame.select(*[F.col(c) for c in dict.fromkeys(need)])
    f = f.withColumn("y", F.col("y").cast("double")).withColumn("fold", F.col("fold").cast("int"))
    return f.groupBy("series_id", "fold").applyInPandas(
        _fit_predict(blocks, regressors, ridge, n_changepoints, interval), OUT_SCHEMA)


def forecast(history: DataFrame, horizon: int, holidays: DataFrame | None = None,
             regressors: Sequence[str] = (), future_regressors: DataFrame | None = None,
             train_days: int | None = None) -> DataFrame:
    """Fit on the last ``train_days`` of each series (all when None) and predict
    ``horizon`` future days.  Future regressor values come from
    ``future_regressors`` (series_id, ds, regressors…), else 0."""
    from tessera.operators.reshape import future_frame
    h = history.withColumn("ds", F.to_date("ds"))
    if train_days:
        from tessera.operators.filters import last_n_days
        h = last_n_days(h, "ds", train_days - 1, by=["series_id"])
    fut = future_frame(h, "ds", horizon, ["series_id"])
    if future_regressors is not None and regressors:
        fut = fut.join(future_regressors.select("series_id", "ds", *regressors), ["series_id", "ds"], "left")
    for r in regressors:
        if r not in fut.columns:
            fut = fut.withColumn(r, F.lit(0.0))
    fut = fut.fillna(0.0, subset=list(regressors)) if regressors else fut
    frame = h.select("series_id", "ds", F.col("y").cast("double"), *regressors).withColumn("role", F.lit("train")) \
        .unionByName(fut.withColumn("y", F.lit(None).cast("double")).withColumn("role", F.lit("future")))
    frame = frame.withColumn("fold", F.lit(0))
    feats, blocks = ts_features(frame, holidays)
    return fit_predict(feats, blocks, regressors)


def cross_validate(series: DataFrame, train: int, test: int, step: int, holidays: DataFrame | None = None,
                   regressors: Sequence[str] = ()) -> DataFrame:
    """R-5: rolling-origin folds as rows (W-3) → one fit per (series, fold), all in one job."""
    folds = rolling_folds(series, ["series_id"], "ds", train, test, step)
    feats, blocks = ts_features(folds, holidays)
    return fit_predict(feats, blocks, regressors)


def components(fc: DataFrame) -> DataFrame:
    """R-9: components in long form (series_id, fold, ds, component, value)."""
    comps = ["trend", "weekly", "yearly", "holidays", "extra_regressors"]
    return fc.select("series_id", "fold", "ds", *comps).unpivot(
        ["series_id", "fold", "ds"], comps, "component", "value")


# W-6
def pacf(df: DataFrame, col: str, max_lag: int, key: str = "series_id", order: str = "ds") -> DataFrame:
    """Yule–Walker PACF per series: the ACF (W-5), then the Durbin–Levinson
    recursion over its ≤ L+1 values as a fold over an array, without Python."""
    a = _acf(df, [key], order, col, max_lag).withColumnRenamed(key, "series_id")
    rows = a.groupBy(F.col("series_id").cast("string").alias("series_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("r"))
    r = F.col("r")

    def step(acc, k):
        phi, v = acc["phi"], acc["v"]
        products = F.transform(phi, lambda x, i: x * F.get(r, k - 1 - i))
        left = F.get(r, k) - F.aggregate(products, F.lit(0.0), lambda x, y: x + y)
        one = F.array(F.when(v != 0, left / v).otherwise(F.lit(float("nan"))))
        return F.get(F.transform(one, lambda p: F.struct(
            F.concat(F.transform(phi, lambda x, i: x - p * F.get(phi, k - 2 - i)), F.array(p)).alias("phi"),
            (v * (1 - p * p)).alias("v"), F.concat(acc["out"], F.array(p)).alias("out"))), F.lit(0))

    start = F.struct(F.array().cast("array<double>").alias("phi"), F.when(F.get(r, F.lit(0)) != 0, F.get(r, F.lit(0))).otherwise(F.lit(1.0)).alias("v"),
                     F.array(F.lit(1.0)).alias("out"))
    out = rows.select("series_id", F.aggregate(F.sequence(F.lit(1), F.size("r") - 1), start, step, lambda acc: acc["out"]).alias("p"))
    return out.select("series_id", F.posexplode("p").alias("lag", "pacf"))
