"""Registered queries against their SQL on the smallest generated data."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences
from checks.oracle import sql_texts
from checks.queries import registry
from tests.conftest import SMALL

QUERIES, TEXTS = registry(), sql_texts()


def test_every_query_has_sql():
    assert set(QUERIES) == set(TEXTS)
    assert set(QUERIES) <= set(entry.queries()) and set(TEXTS) <= set(entry.oracle_sql())


def test_entry_point_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "close" in df.columns


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert differences(got, duck.sql(TEXTS[name]).df()) == ""


def test_no_python_udf_in_plans(spark):
    for name in ("B2_vtwap", "B4_trade_size", "B8_run_structure", "B10_slippage", "X2_asof_join"):
        df = QUERIES[name](spark, SMALL)
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert "Python" not in plan and "CartesianProduct" not in plan
