"""Every registered query with an oracle equals its DuckDB twin (sf0.001)."""
import math

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as E
from tessera.plans import registry as R

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


ORACLE_NAMES = sorted(R.oracle_sql())


def test_every_query_registered_with_callable():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    assert len(qs) >= 100


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = df.collect()
    rel = con.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    si = [df.columns.index(c) for c in order]
    di = [rel.columns.index(c) for c in order]
    s = sorted((tuple(_canon(r[i]) for i in si) for r in srows), key=repr)
    d = sorted((tuple(_canon(r[i]) for i in di) for r in drows), key=repr)
    assert len(s) == len(d)
    assert s == d
