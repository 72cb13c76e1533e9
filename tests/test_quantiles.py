import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickloom.operators.quantiles import exact_quantiles

POINTS = {"p00": 0.0, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def check(spark, groups):
    rows = [(key, float(v)) for key, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {row.k: row for row in exact_quantiles(df, ["k"], "v", POINTS).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        for name, point in POINTS.items():
            want = float(np.quantile(np.array(values, dtype=float), point))
            assert np.isclose(got[key][name], want, rtol=1e-12, atol=1e-12), (key, name)


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    check(
        spark,
        {
            0: rng.normal(0, 1, 2001),  # both signs
            1: np.exp(rng.normal(0, 8, 1500)),  # many magnitudes
            2: np.round(rng.uniform(99, 101, 3000), 2),  # few distinct prices
            3: [7.0] * 500,
            4: [0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300],
            5: [3.5],
            6: 60_000 + rng.uniform(0, 1e-6, 400),  # one bin
            7: [1.0] * 900 + [2.0] * 100,
        },
    )


@settings(
    max_examples=4,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(
    st.lists(
        st.lists(st.floats(-1e12, 1e12), min_size=1, max_size=40), min_size=1, max_size=5
    )
)
def test_random_groups(spark, lists):
    check(spark, dict(enumerate(lists)))


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, None)], "k int, v double")
    rows = exact_quantiles(df, ["k"], "v", {"p50": 0.5}).collect()
    assert [tuple(row) for row in rows] == [(1, 2.0)]


def test_counts_are_shuffled_once_for_both_branches(spark):
    df = spark.range(100).selectExpr("cast(id % 3 as int) k", "cast(id as double) v")
    found = exact_quantiles(df, ["k"], "v", POINTS)
    found.collect()
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


@pytest.mark.parametrize("hot", [200_000])
def test_hot_group(spark, hot):
    df = spark.range(hot).selectExpr(
        "if(id % 10 < 9, 0, cast(id % 7 as int)) k", "cast(pmod(hash(id), 5000) as double) v"
    )
    plain = df.groupBy("k").agg({"k": "count"}).count()
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", POINTS).collect()}
    assert len(got) == plain
    pdf = df.toPandas()
    for key, values in pdf.groupby("k")["v"]:
        assert got[key].p95 == pytest.approx(np.quantile(values, 0.95))
