import random

import pytest

from tests.helpers import same
from tickloom.catalogue import metric_columns
from tickloom.operators.resample import FROM_STATES, from_states, merge_states, resample
from tickloom.plans.build import build, write_dataset
from tickloom.sources import lake, reports

T0 = 1704067200000


@pytest.fixture(scope="module")
def busy(spark):
    """Bursts with many trades a minute, long gaps, runs over bar edges and unknown sides."""
    from tickloom import catalogue

    r = random.Random(11)
    rows, ts, side = [], T0, "buy"
    for k in range(1200):
        ts += r.choice([0, 1, 700, 20_000, 20_000, 400_000]) if k % 150 else 9_000_000
        side = side if r.random() < 0.7 else r.choice(["buy", "sell", "swap"])
        price = r.choice([100.0, 100.5, 101.0, 99.0])
        rows.append((k, "okx-perps", r.choice("AAB"), ts, ts, price, float(r.randrange(1, 9)), side))
    return spark.createDataFrame(rows, catalogue.TRADES).cache()


@pytest.mark.parametrize("dataset", FROM_STATES)
@pytest.mark.parametrize("interval", ["5m", "1h", "1d"])
def test_merged_states_give_the_bars_of_the_trades(busy, dataset, interval):
    states = build(FROM_STATES[dataset], {"trades": busy}, "1m")
    want = build(dataset, {"trades": busy}, interval)
    same(resample(states, dataset, interval), want, tolerance=1e-9)
    longs = [n for n, kind in want.dtypes if kind == "bigint"]
    got = resample(states, dataset, interval).select("exchange", "symbol", *longs)
    assert sorted(got.collect()) == sorted(want.select("exchange", "symbol", *longs).collect())


@pytest.mark.parametrize("kind", ["path_state", "run_state"])
def test_merge_is_associative_and_independent_of_slices(busy, kind):
    fine = build(kind, {"trades": busy}, "1m")
    direct = build(kind, {"trades": busy}, "1d")
    same(merge_states(fine, kind, "1d"), direct, tolerance=1e-9)
    steps = merge_states(merge_states(fine, kind, "15m"), kind, "4h")
    same(merge_states(steps, kind, "1d"), direct, tolerance=1e-9)
    same(merge_states(fine, kind, "1m"), fine, tolerance=1e-9)


def test_states_through_the_lake(spark, busy, root):
    write_dataset("run_state", {"trades": busy}, root, "1m")
    path = f"{root}/run_state"
    stored = spark.read.parquet(path)
    assert set(metric_columns("run_state")) <= set(stored.columns)
    want = build("run_structure", {"trades": busy}, "4h")
    same(from_states(stored, "run_structure", "4h"), want, tolerance=1e-9)


def test_returns_take_the_close_before_the_states(busy):
    states = build("path_state", {"trades": busy}, "1m")
    cut = T0 + 12 * 3_600_000
    early, late = states.where(f"timestamp < {cut}"), states.where(f"timestamp >= {cut}")
    previous = reports.last_values(early, "last_price")
    got = from_states(late, "returns", "4h", previous=previous)
    want = build("returns", {"trades": busy}, "4h").where(f"timestamp >= {cut}")
    same(got, want, tolerance=1e-9)


def test_wrong_requests(busy):
    bars = build("impact", {"trades": busy}, "1m")
    with pytest.raises(ValueError, match="path_state"):
        resample(bars, "impact", "1h")
    with pytest.raises(ValueError, match="no state"):
        from_states(bars, "ohlcv", "1h")
    with pytest.raises(ValueError, match="no state table"):
        merge_states(bars, "ohlcv", "1h")


def test_empty(busy, root):
    for kind in ("path_state", "run_state"):
        none = build(kind, {"trades": busy.limit(0)}, "1m")
        assert merge_states(none, kind, "1h").collect() == []
    assert lake.empty_result(busy.sparkSession, "path_state").columns


def test_mid_states(small):
    fine, direct = (build("mid_state", {"quotes": small["quotes"]}, i) for i in ("1m", "1d"))
    same(merge_states(fine, "mid_state", "1d"), direct, tolerance=0)
