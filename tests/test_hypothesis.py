"""Property-based checks of the distributed building blocks against direct numpy."""
import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import ordered as O
from tessera.operators import stats as ST

values = st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=200)  # many ties
probs = st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=3, unique=True)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, ps=probs)
def test_exact_quantiles_equal_numpy(spark, vals, ps):
    df = spark.createDataFrame(pd.DataFrame({"v": np.array(vals, dtype=float)}))
    got = {r["prob"]: r["value"] for r in ST.exact_quantiles(df, ["v"], ps, partitions=4).collect()}
    for p in ps:
        assert abs(got[p] - np.quantile(np.array(vals, dtype=float), p)) < 1e-9


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 9), st.integers(0, 1)), min_size=1, max_size=150))
def test_running_counts_equal_naive(spark, rows):
    pdf = pd.DataFrame(rows, columns=["score", "label"])
    got = O.running_counts(spark.createDataFrame(pdf), "score", "label", partitions=3).toPandas()
    for _, r in got.iterrows():
        above = pdf[pdf["score"] >= r["score"]]
        assert r["tp"] == int((above["label"] == 1).sum())
        assert r["fp"] == int((above["label"] == 0).sum())
    assert len(got) == pdf["score"].nunique()
