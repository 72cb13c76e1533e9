import bisect
import random

import pytest
from pyspark.sql import functions as F

from tickloom import catalogue
from tickloom.operators.resample import merge_states
from tickloom.operators.sketches import with_quantiles
from tickloom.operators.trade_bars import QUANTILES, price_range, trade_size
from tickloom.plans.build import build

T0 = 1704067200000
DAY = 86_400_000


def day_of_trades(spark, n, seed=0):
    r = random.Random(seed)
    rows = [
        (k, "okx-perps", "A", ts := T0 + r.randrange(DAY), ts, r.lognormvariate(3, 1), r.expovariate(1), "buy")
        for k in range(n)
    ]
    return spark.createDataFrame(rows, catalogue.TRADES), rows


def rank_error(values, found, fraction):
    """How far the rank of ``found`` is from the wanted one, as a share of all values."""
    low, high = bisect.bisect_left(values, found), bisect.bisect_right(values, found)
    want = fraction * len(values)
    return max(0.0, low - want, want - high) / len(values)


@pytest.mark.parametrize("n", [50, 3_000, 60_000])
def test_rank_error_of_direct_and_merged_sketches(spark, n):
    trades, rows = day_of_trades(spark, n)
    direct = build("sketch_state", {"trades": trades}, "1d")
    merged = merge_states(build("sketch_state", {"trades": trades}, "4h"), "sketch_state", "1d")
    bound = 0.0 if n < 200 else 0.02
    for states in (direct, merged):
        row = with_quantiles(states, QUANTILES).first()
        for value, column in (("price", 5), ("qty", 6)):
            values = sorted(r[column] for r in rows)
            for name, point in QUANTILES[value].items():
                assert rank_error(values, row[f"{value}_{name}"], point) <= bound + 1 / n
    for make, value, column in ((trade_size, "qty", 6), (price_range, "price", 5)):
        row = make(trades, "1d", quantiles="sketch").first()
        values = sorted(r[column] for r in rows)
        for name, point in QUANTILES[value].items():
            assert rank_error(values, row[name], point) <= bound + 1 / n


def test_size_is_bounded(spark):
    trades, _ = day_of_trades(spark, 60_000)
    state = build("sketch_state", {"trades": trades}, "1d")
    assert state.select(F.length("qty_sketch")).first()[0] < 8_000


def test_bars_without_values(spark):
    rows = [(1, "okx-perps", "A", T0, T0, None, float("nan"), "buy"), (2, "okx-perps", "B", T0, T0, 5.0, None, "buy")]
    trades = spark.createDataFrame(rows, catalogue.TRADES)
    states = merge_states(build("sketch_state", {"trades": trades}, "1h"), "sketch_state", "1d")
    found = {r.symbol: r for r in with_quantiles(states, QUANTILES).collect()}
    assert found["A"].qty_p50 is None and found["A"].price_p50 is None
    assert found["B"].qty_p50 is None and found["B"].price_p50 == 5.0
    assert build("sketch_state", {"trades": trades.limit(0)}, "1h").collect() == []
