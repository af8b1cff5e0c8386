"""Hand-made frames with literal expectations (FIXTURES §4) and pitfalls P1–P25."""
import math
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.operators import metrics as M
from tessera.operators import ordered as O
from tessera.operators import stats as ST
from tessera.plans import warehouse as W
from tessera.sources import io


def test_mode_ties_smallest_and_all_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert ST.mode_min(df, "x").first()[0] == "a"
    empty = spark.createDataFrame([(None,), (None,)], "x string")
    assert ST.mode_min(empty, "x").first()[0] is None


def test_exact_quantiles_linear(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    q = {r["prob"]: r["value"] for r in ST.exact_quantiles(df, ["v"], [0.25, 0.5, 0.75]).collect()}
    assert q == {0.25: 1.75, 0.5: 2.5, 0.75: 3.25}


def test_exact_quantiles_match_numpy_with_skewed_groups(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([np.full(500, 7.0), rng.normal(size=700)])  # one value holds 40 % of rows
    g = np.where(np.arange(vals.size) % 3 == 0, "a", "b")
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": vals}))
    got = ST.exact_quantiles(df, ["v"], [0.1, 0.5, 0.9], by=["g"]).toPandas()
    for (gg, p), row in got.set_index(["g", "prob"]).iterrows():
        assert math.isclose(row["value"], np.quantile(vals[g == gg], p), rel_tol=1e-12, abs_tol=1e-12)


def test_guarded_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5.0), (2.0, 2.0, 5.0), (3.0, None, 5.0), (4.0, 9.0, 5.0)],
                               "x double, z double, c double")
    r = df.agg(ST.corr_guarded("x", "z").alias("r"), ST.corr_guarded("x", "c").alias("k")).first()
    assert abs(r["r"] - 0.9762210399) < 1e-9
    assert r["k"] is None  # constant column: NULL, not an error


def test_date_dimension_counts(spark):
    d = W.dim_date(spark, with_load_date=False)
    assert d.count() == 13150
    assert d.filter(F.col("is_weekday") == 1).count() == 9393


def test_zero_pad_truncates(spark):
    df = spark.createDataFrame([(1234,), (1234567,)], "z bigint")
    assert [r[0] for r in df.select(S.zip5("z")).collect()] == ["01234", "12345"]


def test_year_shift_leap_day(spark):
    df = spark.createDataFrame([("2012-02-29",)], "d string").select(F.to_date("d").alias("d"))
    assert str(df.select(S.shift_years("d", 1)).first()[0]) == "2013-02-28"


def test_safe_timestamp_parse(spark):
    df = spark.createDataFrame([("",), ("2017-10-02 10:56:33",), ("garbage",)], "s string")
    got = [r[0] for r in df.select(S.safe_ts("s")).collect()]
    assert got[0] is None and got[2] is None and str(got[1]) == "2017-10-02 10:56:33"


def test_payment_status_decimal_vs_float(spark):
    # 0.1 + 0.2 paid against 0.3 owed is settled on decimals
    df = spark.createDataFrame([(0.3, 0.1, 0.2)], "owed double, p1 double, p2 double")
    dec = df.select((S.money("owed") - (S.money("p1") + S.money("p2"))).alias("b"))
    flt = df.select((F.col("owed") - (F.col("p1") + F.col("p2"))).alias("b"))
    assert dec.first()[0] == 0
    assert flt.first()[0] != 0


def test_newline_csv_audit(spark):
    d = tempfile.mkdtemp(prefix="tessera-csv-")
    path = os.path.join(d, "x.csv")
    with open(path, "w") as f:
        f.write('id,msg\n1,"a\nb"\n2,plain\n')
    audit = io.csv_line_audit(spark, path).first()
    assert audit["physical_lines"] == 4 and audit["logical_rows"] == 3  # header + 2 records
    cleaned = io.clean_newlines(io.read_csv(spark, path, "id int, msg string", multiline=True))
    assert sorted(r["msg"] for r in cleaned.collect()) == ["a b", "plain"]


def test_rolling_mean_matches_pandas_centered(spark):
    vals = np.random.default_rng(1).normal(size=40)
    pdf = pd.DataFrame({"k": "s", "i": np.arange(40), "v": vals})
    got = O.rolling_mean(spark.createDataFrame(pdf), ["k"], "i", "v", 14, out="r").orderBy("i").toPandas()["r"]
    exp = pd.Series(vals).rolling(14, center=True, min_periods=1).mean()
    assert np.allclose(got.to_numpy(), exp.to_numpy(), atol=1e-12)


@pytest.mark.parametrize("n", [1000, 1124, 1125, 1126, 1155, 1500])
def test_fold_count_formula(spark, n):
    df = spark.range(n).select(F.lit("s").alias("k"), F.col("id").alias("i"))
    folds = O.rolling_folds(df, ["k"], "i", 1095, 30, 30)
    expected = 0 if n < 1125 else (n - 1125) // 30 + 1
    assert folds.select("fold").distinct().count() == expected
    if expected:
        sizes = folds.groupBy("fold", "role").count().collect()
        assert {(r["role"], r["count"]) for r in sizes} == {("train", 1095), ("test", 30)}


def test_roc_auc_perfect_constant_reversed(spark):
    rows = [(float(i), 1 if i >= 50 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert abs(M.auc(df).first()[0] - 1.0) < 1e-12
    const = df.withColumn("score", F.lit(0.5))
    assert abs(M.auc(const).first()[0] - 0.5) < 1e-12
    rev = df.withColumn("score", -F.col("score"))
    assert abs(M.auc(rev).first()[0]) < 1e-12


def test_auc_and_ap_match_direct_definitions(spark):
    rng = np.random.default_rng(3)
    s = np.round(rng.random(2000), 2)  # ties
    y = (rng.random(2000) < s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"score": s, "label": y}))
    # reference values by direct numpy evaluation of the same definitions
    order = np.argsort(-s, kind="stable")
    ss, yy = s[order], y[order]
    thr = np.unique(ss)[::-1]
    tp = np.array([yy[ss >= t].sum() for t in thr])
    fp = np.array([(1 - yy[ss >= t]).sum() for t in thr])
    P, N = y.sum(), (1 - y).sum()
    tpr, fpr = np.r_[0, tp / P], np.r_[0, fp / N]
    auc_ref = np.trapezoid(tpr, fpr)
    prec, rec = tp / (tp + fp), tp / P
    ap_ref = np.sum(np.diff(np.r_[0, rec]) * prec)
    assert abs(M.auc(df).first()[0] - auc_ref) < 1e-12
    assert abs(M.average_precision(df).first()[0] - ap_ref) < 1e-12


def test_all_null_row_dropped(spark):
    df = spark.createDataFrame([(None, None), (1, None), (None, 2)], "a int, b int")
    from tessera.operators import quality as Q
    assert Q.drop_all_null(df, ["a", "b"]).count() == 2
    assert Q.rows_all_null(df, ["a", "b"]).count() == 1


def test_skew_matches_pandas(spark):
    vals = np.random.default_rng(5).gamma(2.0, size=500)
    df = spark.createDataFrame(pd.DataFrame({"v": vals}))
    got = ST.skew(df, ["v"]).first()["skew"]
    assert abs(got - pd.Series(vals).skew()) < 1e-10


def test_describe_matches_pandas(spark):
    vals = np.random.default_rng(6).normal(10, 3, size=301)
    df = spark.createDataFrame(pd.DataFrame({"v": vals}))
    got = ST.describe(df, ["v"], digits=None).first()
    ref = pd.Series(vals).describe()
    for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                         ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert abs(got[ours] - ref[theirs]) < 1e-9


def test_histogram_top_edge_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    h = ST.histogram(df, "v", bins=5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 2, 2, 2, 3]
    assert sum(np.histogram(np.arange(11.0), bins=5)[0]) == 11
    assert [r["count"] for r in h] == list(np.histogram(np.arange(11.0), bins=5)[0])


def test_lookup_last_year_unique_key(spark):
    from tessera.operators.joins import lookup_last_year
    cal = spark.createDataFrame([("2012-02-28", 1), ("2012-02-29", 2)], "ds string, v int") \
        .select(F.to_date("ds").alias("ds"), "v")
    frame = spark.createDataFrame([("2013-02-28",)], "ds string").select(F.to_date("ds").alias("ds"))
    out = lookup_last_year(frame, cal, "ds", "v").collect()
    assert len(out) == 1 and out[0]["v_last_year"] == 2  # later source day wins, no fan-out


def test_status_seed_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tessera-seed-")
    path = os.path.join(d, "seed.csv")
    pd.DataFrame(W.STATUS_SEED, columns=W.STATUS_SEED_COLUMNS).to_csv(path, index=False)
    seed = io.load_seed(spark, path, W.STATUS_SEED_COLUMNS)
    assert seed.count() == 20
    assert all(f.dataType.simpleString() == "string" for f in seed.schema.fields)
    assert seed.filter(F.col("status_description").contains(",")).count() == 3


def test_jdbc_options_partitioned():
    o = io.jdbc_options("jdbc:postgresql://h/db", "public.orders", "id", 0, 1000, 8)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8" and o["dbtable"] == "public.orders"
    with pytest.raises(ValueError):
        io.jdbc_options("u", "t", "id")


def test_corr_matrix_equals_pairs_of_whole_rows(spark):
    import random
    rng = random.Random(5)
    rows = [(1e9 + rng.random(), None if i % 7 == 0 else rng.random() * i, 4.1, 0.3 if i % 2 else None, None if i % 2 else rng.random(), None) for i in range(400)]
    names = ["offset", "some", "constant", "half", "other_half", "nothing"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r.col_a, r.col_b): r["corr"] for r in ST.corr_matrix(df, names, digits=6).collect()}
    assert len(got) == len(names) ** 2
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            pairs = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            x, y = ([p[k] for p in pairs] for k in (0, 1))
            if len(set(x)) < 2 or len(set(y)) < 2:
                assert got[a, b] is None, (a, b)
                continue
            mx, my = sum(v - x[0] for v in x) / len(x) + x[0], sum(y) / len(y)
            c, sx, sy = (sum(p * q for p, q in zip(*s)) for s in (([v - mx for v in x], [v - my for v in y]), ([v - mx for v in x],) * 2, ([v - my for v in y],) * 2))
            assert abs(got[a, b] - c / (sx * sy) ** 0.5) < 2e-6, (a, b)
    assert ST.corr_matrix(df.limit(0), names).count() == 0
    assert ST.corr_with(df, "some", ["some"]).count() == 0
