"""Properties of the operators that have no SQL twin, and negative checks."""
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from tessera.operators import classify as C
from tessera.operators import quality as Q
from tessera.plans import features as FE
from tessera.plans import warehouse as W
from tessera.sources import fixtures as X
from tessera.sources.catalog import Sources


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1500
    assert "payment_status" in df.columns


def test_payment_status_counts_sf001(spark):
    r = X.commerce_sources(spark, SF_MID)
    d = W.dim_orders(r.orders, r.order_payments, r.order_items, with_load_date=False)
    got = {row[0]: row[1] for row in d.groupBy("payment_status").count().collect()}
    assert got == {"completed": 11670, "in progress": 2918, "order items not found": 257,
                   "payments not found": 96, "canceled": 40, None: 19}


def test_compound_unique_fails_on_raw_lineitem(spark):
    t = Sources.parquet_dir(spark, SF_MID)
    r = Q.unique_check(t.lineitem, ["l_orderkey", "l_linenumber"]).first()
    assert not r["success"] and r["unexpected_count"] == 14168


def test_land_bounds_validation_fails(spark):
    r = X.commerce_sources(spark, SF_MID)
    land = FE.ds_land_geolocation(W.dim_geolocation(r.geolocation, with_load_date=False))
    assert land.count() == 927
    res = {row["column"]: row for row in Q.run_suite(land, [Q.Between(c, lo, hi) for c, (lo, hi) in
                                                            FE.LAND_CHECK.items()]).collect()}
    assert res["geolocation_lat"]["success"]
    assert not res["geolocation_lng"]["success"] and res["geolocation_lng"]["unexpected_count"] == 24


def test_suite_raises_on_request(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    with pytest.raises(Q.DataQualityError):
        Q.run_suite(df, [Q.NotNull("a")], on_fail="raise")


def test_pipeline_stops_at_first_failure():
    calls = []
    steps = [Q.Step("a", lambda: calls.append("a")), Q.Step("b", lambda: 1 / 0), Q.Step("c", lambda: calls.append("c"))]
    with pytest.raises(Q.PipelineError) as e:
        Q.run_pipeline(steps)
    assert calls == ["a"]
    assert e.value.args[0][-1] == ("c", "skipped")


def test_daily_pipeline_end_to_end(spark):
    from tessera.plans.pipeline import run_daily
    target = tempfile.mkdtemp(prefix="tessera-pipe-")
    report = run_daily(spark, X.commerce_sources(spark, SF_SMALL), target)
    assert [s for s, _ in report] == ["ingest", "models", "tests", "features", "validation"]
    assert all(status == "ok" for _, status in report)
    tests = spark.read.parquet(os.path.join(target, "tests"))
    assert tests.count() == 24 and tests.filter(~F.col("success")).count() == 0
    geo = spark.read.json(os.path.join(target, "validation", "land_geolocation"))
    assert geo.count() == 2


def test_distributed_rank_equals_naive(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "u": rng.random(500), "id": np.arange(500)})
    df = spark.createDataFrame(pdf)
    got = C.distributed_rank(df, ["g"], ["u", "id"]).toPandas().set_index("id")["_rank"]
    exp = pdf.sort_values(["g", "u", "id"]).groupby("g").cumcount() + 1
    assert (got.sort_index() == exp.sort_index()).all()


def test_stratified_split_sizes(spark):
    t = Sources.parquet_dir(spark, SF_MID)
    fr = X.x_fraud(t)
    s = C.stratified_split(fr, "Class", "id")
    got = {(r["Class"], r["split"]): r["count"] for r in s.groupBy("Class", "split").count().collect()}
    for cls in (0, 1):
        n = sum(v for (c, _), v in got.items() if c == cls)
        nt = round(n * 0.2)
        assert got[(cls, "test")] == nt
        assert got[(cls, "valid")] == round((n - nt) * 0.2)
    assert s.count() == fr.count()


def test_smote_points_on_segments(spark):
    t = Sources.parquet_dir(spark, SF_SMALL)
    fr = X.x_fraud(t)
    feats = [f"v{i}" for i in range(8)]
    out = C.smote(fr.select("id", *feats, "Class"), "Class", feats, "id", ratio=0.5, k=3, seed=1)
    n1 = fr.filter("Class = 1").count()
    n0 = fr.filter("Class = 0").count()
    syn = out.filter("synthetic = 1").toPandas()
    assert len(syn) == int(0.5 * n0) - n1
    base = fr.select("id", *feats).toPandas().set_index("id")
    for _, r in syn.head(30).iterrows():
        a = base.loc[r["_base_id"], feats].to_numpy(float)
        b = base.loc[r["_nbr_id"], feats].to_numpy(float)
        x = r[feats].to_numpy(float)
        d = b - a
        u = np.dot(x - a, d) / np.dot(d, d)
        assert -1e-9 <= u <= 1 + 1e-9
        assert np.allclose(a + u * d, x, atol=1e-9)


def test_knn_exact_matches_bruteforce(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 5))
    rows = [(i, [float(v) for v in x[i]]) for i in range(120)]
    pts = spark.createDataFrame(rows, "id bigint, vec array<double>")
    nn = C.knn_exact(pts, "id", "vec", 3, block_rows=25).toPandas()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    for i in range(0, 120, 17):
        exp = set(np.argsort(d[i])[:3])
        assert set(nn[nn["id"] == i]["nbr_id"]) == exp


def test_isolation_forest_flags_about_contamination(spark):
    t = Sources.parquet_dir(spark, SF_SMALL)
    fr = X.x_fraud(t)
    feats = [f"v{i}" for i in range(16)]
    m = C.isolation_forest(fr, feats, "id", n_trees=30, sample=64, contamination=0.1, seed=3)
    share = m.flag(fr).agg(F.avg("outlier")).first()[0]
    assert 0.05 <= share <= 0.15


def test_forecast_recovers_weekly_pattern(spark):
    days = pd.date_range("2000-01-01", periods=800, freq="D")
    pattern = np.array([10, 20, 30, 40, 50, 60, 70], dtype=float)
    y = 1000 + 0.5 * np.arange(800) + pattern[days.dayofweek]
    pdf = pd.DataFrame({"series_id": "s", "ds": days.date, "y": y})
    from tessera.operators import forecast as FC
    fc = FC.forecast(spark.createDataFrame(pdf), 14).toPandas()
    fut = fc[fc["role"] == "future"].sort_values("ds")
    assert len(fut) == 14
    truth = 1000 + 0.5 * np.arange(800, 814) + pattern[pd.to_datetime(fut["ds"]).dt.dayofweek]
    assert np.abs(fut["yhat"].to_numpy() - truth).max() < 2.0
    parts = fut[["trend", "weekly", "yearly", "holidays", "extra_regressors"]].sum(axis=1)
    assert np.allclose(parts.to_numpy(), fut["yhat"].to_numpy())


def test_pacf_matches_yule_walker(spark):
    rng = np.random.default_rng(8)
    e = rng.normal(size=600)
    x = np.zeros(600)
    for i in range(2, 600):
        x[i] = 0.6 * x[i - 1] - 0.3 * x[i - 2] + e[i]
    pdf = pd.DataFrame({"series_id": "s", "ds": pd.date_range("2001-01-01", periods=600).date, "y": x})
    from tessera.operators import forecast as FC
    got = FC.pacf(spark.createDataFrame(pdf), "y", 4).toPandas().sort_values("lag")["pacf"].to_numpy()
    d = x - x.mean()
    r = np.array([np.sum(d[: len(d) - k] * d[k:]) / np.sum(d * d) for k in range(5)])
    ref = [1.0]
    for k in range(1, 5):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        ref.append(np.linalg.solve(R, r[1:k + 1])[-1])
    assert np.allclose(got, ref, atol=1e-9)


def test_streaming_daily_sales_matches_batch(spark):
    from tessera.streaming.incremental import daily_sales_frame, run_daily_sales_stream
    src, store, sink, ck = (tempfile.mkdtemp(prefix=f"tessera-{n}-") for n in ("src", "store", "sink", "ck"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    late = F.pmod(F.xxhash64("o_orderkey"), F.lit(5)) == 0
    for part in (orders.filter(~late), orders.filter(late)):  # the second run brings late orders of old days
        part.write.mode("append").parquet(src)
        run_daily_sales_stream(spark, src, store, sink, ck)
    streamed = spark.read.parquet(sink).select("day", "n_orders", "total")
    batch = daily_sales_frame(orders)
    assert streamed.count() == batch.count() and streamed.exceptAll(batch).count() == 0


def test_search_draws_differ_for_spark_and_folds_are_stratified(spark):
    rows = [(i, 1 if i % 60 == 0 else 0) for i in range(600)]
    df = spark.createDataFrame(rows, "id bigint, label int")
    sizes = {(r["label"], r["_fold"]): r["count"] for r in C.stratified_folds(df, "label", "id", 3).groupBy("label", "_fold").count().collect()}
    assert sorted(v for (y, _), v in sizes.items() if y) == [3, 3, 4] and sorted(v for (y, _), v in sizes.items() if not y) == [196, 197, 197]


def test_modes_compare_values_in_their_own_type(spark):
    import datetime as dt
    from tessera.operators.stats import modes
    df = spark.createDataFrame([(9, dt.date(2020, 10, 1), True), (9, dt.date(2020, 9, 1), None), (10, dt.date(2020, 10, 1), False), (10, dt.date(2020, 9, 1), True)],
                               "n int, d date, b boolean")
    assert modes(df, ["n", "d", "b"]) == {"n": 9, "d": dt.date(2020, 9, 1), "b": True}


def test_order_models_do_not_depend_on_session_time_zone(spark):
    from tessera.plans import features as FE2
    def run():
        r = X.commerce_sources(spark, SF_SMALL)
        d = W.dim_orders(r.orders, r.order_payments, r.order_items, with_load_date=False)
        return sorted(tuple(row) for row in FE2.ds_orders_delivery(d).collect())
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = run()
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # DST gaps at midnight
        assert run() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hash_rank_and_cuts_equal_sorting(spark):
    import pandas as pd
    from tessera.operators import classify as C, ordered as O
    rows = [(i, None if i % 10 == 0 else i % 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g long").repartition(5).withColumn("u", C.hash_uniform("id", seed=3))
    pdf = df.toPandas().sort_values(["u", "id"])
    pdf["want"] = pdf.groupby("g", dropna=False).cumcount() + 1
    for per in (7, 1 << 18):
        got = O.hash_rank(df, ["g"], "u", "id", per_prefix=per).toPandas().set_index("id")["_rank"]
        assert (got.loc[pdf["id"]].to_numpy() == pdf["want"].to_numpy()).all()
        cuts = spark.createDataFrame([(0, "a", 5), (1, "a", 300), (None, "b", 200), (2, "b", 0), (1, "c", 10**9)], "_by long, _cut string, _at long")
        found = {(None if pd.isna(r["_by"]) else r["_by"], r["_cut"]): r["_id"] for r in O.hash_cuts(df, "g", "u", "id", cuts, per_prefix=per).collect()}
        pick = lambda g, n: int(pdf[(pdf.g.isna() if g is None else pdf.g == g) & (pdf.want == n)]["id"].iloc[0])
        assert found == {(0, "a"): pick(0, 5), (1, "a"): pick(1, 300), (None, "b"): pick(None, 200)}
    whole = O.hash_rank(df, [], "u", "id", per_prefix=50).toPandas().set_index("id")["_rank"]
    assert (whole.loc[pdf["id"]].to_numpy() == range(1, 2001)).all()


def test_quantiles_of_awkward_values(spark):
    """Values that differ in the last bits, span all sizes, repeat, or are infinite."""
    import numpy as np
    import pandas as pd
    from tessera.operators import stats as ST
    rng = np.random.default_rng(0)
    probs = [0, 0.1, 0.25, 0.333, 0.5, 0.9, 0.999, 1]
    cases = [rng.normal(size=3000), np.exp(rng.normal(size=3000) * 50) * rng.choice([-1, 1], 3000), rng.integers(0, 3, 3000) * 1.0,
             1 + rng.integers(0, 100_000, 3000) * 2.0**-50, np.r_[0.0, -0.0, 1e-320, -1e-320, 1e300, -1e300, 5e-324, rng.normal(size=20)], np.array([3.5])]
    table = pd.concat([pd.DataFrame({"g": i, "v": x}) for i, x in enumerate(cases)])
    got = {(r["g"], r["prob"]): r["value"] for r in ST.exact_quantiles(spark.createDataFrame(table).repartition(4), ["v"], probs, by=["g"]).collect()}
    for i, x in enumerate(cases):
        for p, want in zip(probs, np.quantile(x, probs)):
            assert got[i, p] == want or abs(got[i, p] - want) <= 1e-12 * abs(want)
    odd = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),), (float("nan"),), (None,)], "v double")
    assert [str(r["value"]) for r in ST.exact_quantiles(odd, ["v"], [0.0, 1 / 3, 2 / 3, 1.0]).orderBy("prob").collect()] == ["-inf", "1.0", "inf", "nan"]


def test_end_slices_without_groups(spark):
    from tessera.operators import filters as FL
    df = spark.range(100).withColumn("v", -spark.range(1).select("id").scalar() + 7)
    ids = lambda a, b: sorted(r["id"] for r in FL.slice_rows(df, "id", a, b).collect())
    assert ids(None, 5) == list(range(5)) and ids(2, 6) == [2, 3, 4, 5] and ids(-3, None) == [97, 98, 99] and ids(-5, -2) == [95, 96, 97] and ids(10, -85) == list(range(10, 15))


def _two_class_rows(spark, n=60):
    """Rows of two classes that one feature parts, as ``id, Class, scaled``."""
    from pyspark.ml.functions import array_to_vector
    x = F.col("id").cast("double")
    return spark.range(n).select("id", (F.col("id") % 3 == 0).cast("int").alias("Class"),
                                 array_to_vector(F.array(x % 3, x % 7, x / n)).alias("scaled"))


def test_forest_scores_in_a_session_that_has_observed_a_metric(spark):
    from pyspark.sql import Observation
    seen = Observation("rows")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 5}
    df = _two_class_rows(spark)
    model = C.rf_fit(df, "scaled", "Class", num_trees=5, max_depth=4)
    got = C.positive_probability(model, df).select("Class", "score").collect()
    assert len(got) == 60
    assert all((r["score"] > 0.5) == (r["Class"] == 1) for r in got)


def test_forest_keeps_node_ids_and_joins_partitions_beyond_the_cores(spark):
    """A level costs every partition the statistics of every node."""
    df = _two_class_rows(spark, 64).repartition(64, "id")
    packed = C._packed(df)
    assert packed.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in packed.collect()) == list(range(64))
    assert C._packed(df, 8192).rdd.getNumPartitions() == 1
    assert C._packed(df, 32).rdd.getNumPartitions() == 2
    model = C.rf_fit(df, "scaled", "Class", num_trees=2, max_depth=2)
    assert model.getCacheNodeIds() and not C.rf_fit(df, "scaled", "Class", num_trees=2, max_depth=2, cacheNodeIds=False).getCacheNodeIds()


def test_random_search_equals_cross_validator(spark):
    """The fits of all folds run beside each other, with the metrics, the best map and the scores of Spark's own search."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator
    df = _two_class_rows(spark, 90).coalesce(1)
    space = {"numTrees": [3, 5], "maxDepth": [1, 2], "minInstancesPerNode": [1]}
    got = C.random_search(df, "scaled", "Class", n_iter=4, folds=3, seed=1, id_col="id", space=space)
    maps = [m for m in _search_maps(space, 4, 1)]
    rf = RandomForestClassifier(featuresCol="scaled", labelCol="Class", seed=1)
    ev = MulticlassClassificationEvaluator(labelCol="Class", metricName="fMeasureByLabel", metricLabel=1.0)
    folds = C.held(C.stratified_folds(df, "Class", "id", 3, 1).select("scaled", "Class", "_fold")).coalesce(1)
    cv = CrossValidator(estimator=rf, estimatorParamMaps=[{getattr(rf, k): v for k, v in m.items()} for m in maps],
                        evaluator=ev, foldCol="_fold", seed=1).fit(folds)
    assert len(got.avgMetrics) == 4 and np.allclose(got.avgMetrics, cv.avgMetrics) and np.allclose(got.stdMetrics, cv.stdMetrics)
    assert got.bestModel.toDebugString.split("\n")[1:] == cv.bestModel.toDebugString.split("\n")[1:]
    with pytest.raises(ValueError):
        C.random_search(df, "scaled", "Class", n_iter=1, folds=91, seed=1, id_col="id", space=space)


def _search_maps(space, n_iter, seed):
    import random
    rng, seen = random.Random(seed), []
    while len(seen) < n_iter:
        draw = {k: rng.choice(list(v)) for k, v in space.items()}
        if draw not in seen:
            seen.append(draw)
    return seen
