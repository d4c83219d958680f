"""Every registered query against its SQL, and the shape of its plan."""

import pytest
from conftest import SMALL

import __spark_entry__ as driver
from check import compare, oracle
from martflow.queries import ORACLE, QUERIES

# Nodes that leave the JVM row by row, or pair every row with every other.
UNWANTED = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con():
    return oracle(SMALL)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_driver_sees_each_query():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql())


def test_entry_has_rows(spark):
    result = driver.entry(spark)
    assert result.columns[0] == "songplay_id"
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, con, name):
    verdict, _, _ = compare(spark, con, name, SMALL)
    assert verdict == "ok"


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("join", "agg", "fn", "dq", "imm", "temp"))))
def test_query_stays_in_the_jvm(spark, capsys, name):
    QUERIES[name](spark, SMALL).explain()
    plan = capsys.readouterr().out
    assert not [node for node in UNWANTED if node in plan]
