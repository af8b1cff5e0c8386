"""Scale rules checked on the physical plans of the registered queries."""
import io
import re
from contextlib import redirect_stdout

import pytest

from tessera.plans import registry as E
from conftest import SF_SMALL

NAMES = sorted(E.oracle_sql())  # the SQL-expressible queries (model fits are eager, checked elsewhere)


def _plan(spark, name):
    buf = io.StringIO()
    with redirect_stdout(buf):
        E.queries()[name](spark, SF_SMALL).explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loop_or_python(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"BroadcastNestedLoopJoin|CartesianProduct", plan), name
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan), name


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = _plan(spark, "semi_join")
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
    orders = _plan(spark, "dim_orders")
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double,l_tax:double>" in orders
    assert "Window" not in orders  # the unused item numbering is pruned
