"""Sources/sinks and join helpers on small frames and the supplied tables."""
import pytest
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import joins as J
from tessera.operators import quality as Q
from tessera.operators import stats as ST
from tessera.operators.reshape import melt, pivot, union_events
from tessera.sources import io
from tessera.sources.catalog import Sources


def test_flatten_structs_one_level(spark):
    df = spark.createDataFrame([(1, (2, (3, 4)))], "a int, s struct<b:int, t:struct<c:int, d:int>>")
    one = io.flatten_structs(df, max_depth=1)
    assert one.columns == ["a", "s_b", "s_t"]
    two = io.flatten_structs(df, max_depth=2)
    assert two.columns == ["a", "s_b", "s_t_c", "s_t_d"]
    assert io.raw_table_name("public-orders") == "public_orders"


def test_ingest_counts_rows_while_writing(spark):
    t = Sources.parquet_dir(spark, SF_SMALL)
    target = tempfile.mkdtemp(prefix="tessera-ingest-")
    report = io.ingest({"public-nation": t.nation, "public-region": t.region}, target)
    assert [(n, r) for n, r, _ in report] == [("public_nation", 25), ("public_region", 5)]
    assert spark.read.parquet(os.path.join(target, "public_nation")).count() == 25
    m = io.ingest_metrics(spark, report)
    assert m.count() == 2


def test_materialize_and_results_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tessera-mat-")
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    back = io.materialize(df, "t", "table", os.path.join(d, "t"))
    assert back.count() == 10
    io.materialize(df, "tessera_view_t", "view")
    assert spark.table("tessera_view_t").count() == 10
    res = Q.run_suite(df, [Q.NotNull("x"), Q.Between("x", 0, 10)])
    io.write_results(res, os.path.join(d, "res"))
    got = {r["check"]: r["success"] for r in spark.read.json(os.path.join(d, "res")).collect()}
    assert got == {"not_null": True, "values_between": False}


def test_preview_is_ordered(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert [r[0] for r in io.preview(df, 2, "k").collect()] == [1, 2]


def test_add_counts_missing_side_is_zero(spark):
    a = spark.createDataFrame([("x", 2), ("y", 1)], "k string, count bigint")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "k string, count bigint")
    got = {r["k"]: r["count"] for r in J.add_counts(a, b, "k").collect()}
    assert got == {"x": 2, "y": 4, "z": 4}


def test_holiday_window_offsets(spark):
    days = spark.createDataFrame([(f"2020-01-{d:02d}",) for d in range(1, 15)], "ds string") \
        .select(F.to_date("ds").alias("ds"))
    hol = spark.createDataFrame([("2020-01-07", "H")], "ds string, holiday string").select(
        F.to_date("ds").alias("ds"), "holiday")
    w = J.holiday_window(days, hol, "ds").orderBy("ds").collect()
    assert [r["offset"] for r in w] == [-3, -2, -1, 0, 1, 2, 3]
    assert str(w[0]["ds"]) == "2020-01-04"


def test_lookup_join_keeps_every_fact_row(spark):
    fact = spark.range(100).withColumn("k", F.col("id") % 3)
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, v string")
    out = J.lookup_join(fact, dim.filter("k < 2"), "k")
    assert out.count() == 100 and out.filter("v is null").count() == 33


def test_one_to_one_flags_any_value_column(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("b", 1.0, 2.0), ("b", 1.0, 2.0),
                                ("c", None, 1.0)], "k string, x double, y double")
    bad = {r["k"] for r in Q.one_to_one(df, "k", ["x", "y"]).collect()}
    assert bad == {"a"}  # P12: a key is flagged only when some value column has >1 distinct value


def test_value_counts_drop_nulls_and_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    rows = ST.value_counts(df, "v", normalize=True).collect()
    assert [(r["v"], r["count"]) for r in rows] == [("a", 2), ("b", 1)]
    assert abs(rows[0]["share"] - 2 / 3) < 1e-12


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(float("nan"), None), (1.0, "x")], "d double, s string")
    got = {r["column"]: r["null_count"] for r in ST.null_profile(df).collect()}
    assert got == {"d": 1, "s": 1}


def test_melt_pivot_round_trip(spark):
    wide = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "id string, m1 double, m2 double")
    long = melt(wide, ["id"], var="month", val="v")
    assert long.count() == 4
    back = pivot(long, "id", "month", "v", ["m1", "m2"]).orderBy("id").collect()
    assert [(r["id"], r["m1"], r["m2"]) for r in back] == [("a", 1.0, 2.0), ("b", 3.0, 4.0)]


def test_union_events_drops_empty(spark):
    cal = spark.createDataFrame([("2020-01-01", "A", None), ("2020-01-02", None, None), ("2020-01-03", "B", "C")],
                                "date string, e1 string, e2 string")
    h = union_events(cal, "date", ["e1", "e2"]).collect()
    assert sorted(r["holiday"] for r in h) == ["A", "B", "C"]
    assert all(r["lower_window"] == -3 and r["upper_window"] == 3 for r in h)


def test_checkpoint_folder_is_demanded_on_a_cluster():
    from tessera.session import ensure_checkpoint_dir

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
