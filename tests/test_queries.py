"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as registry
from harness import connect, spark_rows, sql_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in registry.queries() if n in registry.oracle_sql()])
def test_agrees_with_sql(spark, duck, name, capsys):
    result = registry.queries()[name](spark, SF)
    found, columns = spark_rows(result)
    expected, expected_columns = sql_rows(duck, registry.oracle_sql()[name])
    assert columns == expected_columns
    assert found == expected
    assert found, "a query without rows checks nothing"
    capsys.readouterr()
    result.explain("formatted")
    plan = capsys.readouterr().out
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan


def test_entry(spark):
    assert registry.entry(spark).count() > 0
