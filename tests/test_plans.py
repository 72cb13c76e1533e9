"""Scans, exchanges and operators of executed plans on the smallest generated data."""

import re
import shutil

import pytest
from pyspark.sql import functions as F

from checks.queries import tick_tables
from tests.conftest import SMALL
from tickloom.catalogue import QUOTES, TRADES
from tickloom.operators.asof import asof_mid
from tickloom.operators.slices import carry_last
from tickloom.operators.trade_bars import trade_tally
from tickloom.plans.build import build


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def count(plan, node):
    return len(re.findall(rf"^[ :|+*()0-9-]*{node}\b", plan, re.M))


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Tick tables of a copy of the file, which no other test has cached."""
    folder = tmp_path_factory.mktemp("events")
    shutil.copy(f"{SMALL}/events.parquet", folder)
    return tick_tables(spark, str(folder))


@pytest.mark.parametrize("dataset", ["trade_size", "range"])
def test_quantiles_take_two_scans(files, dataset):
    assert count(final_plan(build(dataset, files, "4h")), "FileScan") == 2


def test_all_quantiles_take_two_scans(files):
    plan = final_plan(trade_tally(files["trades"], "4h"))
    assert count(plan, "FileScan") == 2
    assert count(plan, "Exchange") <= 8


def test_asof_takes_two_scans(files):
    plan = final_plan(asof_mid(files["trades"], files["quotes"]))
    # the reused exchange shows its inputs once
    assert count(plan, "FileScan") == 2 and "ReusedExchange" in plan


@pytest.mark.parametrize(
    "dataset", ["ohlcv", "range", "basis", "funding", "open_interest", "derivative_price"]
)
def test_first_and_last_stay_in_a_hash_aggregate(files, dataset):
    plan = final_plan(build(dataset, files, "4h"))
    assert count(plan, "HashAggregate") >= 2 and count(plan, "SortAggregate") == 0


@pytest.mark.parametrize("dataset", ["l2_imbalance", "l2_liquidity"])
def test_book_sums_are_compiled(spark, files, dataset):
    folder = files["book"].select("*")
    plan = final_plan(build(dataset, {"book": folder}, "4h"))
    assert "lambda" not in plan and "zip_with" not in plan


def test_look_back_stays_in_chunks(spark):
    """A series without any value: few of its rows meet in the window across chunks."""
    steps = spark.range(20_000).select(
        F.lit("binance-futures").alias("exchange"),
        F.when(F.col("id") % 10 == 0, "B").otherwise("A").alias("symbol"),
        (F.col("id") * 1000).alias("slice"),
        F.when(F.col("id") % 10 == 0, F.col("id").cast("double")).alias("v"),
    )
    carried = carry_last(steps, "v", "slice", 1000, "seed", chunk_rows=100)
    rows = {r.symbol: r for r in carried.groupBy("symbol").agg(F.count("seed").alias("n"), F.count("*").alias("rows")).collect()}
    assert (rows["A"].n, rows["A"].rows) == (0, 18_000)
    assert rows["B"].n == 1_999


def test_null_series_never_match(spark):
    trades = spark.createDataFrame(
        [(1, "okx-perps", None, 5, 5, 1.0, 1.0, "buy"), (2, "okx-perps", "A", 5, 5, 1.0, 1.0, "buy"), (3, None, "A", 5, 5, 1.0, 1.0, "buy")],
        TRADES,
    )
    quotes = spark.createDataFrame(
        [(1, "okx-perps", None, 4, 4, 9.0, 11.0, 1.0, 1.0), (2, "okx-perps", "A", 4, 4, 19.0, 21.0, 1.0, 1.0), (3, None, "A", 4, 4, 1.0, 1.0, 1.0, 1.0), (4, "okx-perps", "A", 5, 5, -1.0, 1.0, 1.0, 1.0)],
        QUOTES,
    )
    found = {r.trade_id: r.mid for r in asof_mid(trades, quotes).collect()}
    assert found == {1: None, 2: 20.0, 3: None}  # a zero mid counts as no quote
