"""Queries with SQL equal their DuckDB twins; all queries are registered."""
import duckdb
import pytest

import __spark_entry__ as E
from tessera.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_all_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(Q.oracle_sql()[name])
    got = Q.queries()[name](spark, SF)
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    canon = lambda rows, cols: sorted(tuple(round(r[cols.index(c)], 6) if isinstance(r[cols.index(c)], float) else r[cols.index(c)] for c in order) for r in rows)
    assert canon(got.collect(), got.columns) == canon(want.fetchall(), want.columns)
