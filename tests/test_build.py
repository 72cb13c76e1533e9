from datetime import date

import pytest

from tests.helpers import same
from tickloom.catalogue import DATASETS
from tickloom.plans.build import Sizing, _width, build, measure, write_datasets
from tickloom.sources import lake

FIRST, LAST = date(2024, 1, 1), date(2024, 12, 31)


def test_measure_counts_slices(small):
    trades = small["trades"]
    most = trades.selectExpr("exchange", "symbol", "exchange_ts div 86400000 d").groupBy("exchange", "symbol", "d").count()
    largest = most.agg({"count": "max"}).first()[0]
    assert measure(trades, "1d").slice_ms == 86_400_000
    assert measure(trades, "1d", max_rows=largest).slice_ms == 86_400_000
    assert measure(trades, "1d", max_rows=largest - 1).slice_ms < 86_400_000
    assert measure(trades, "1d", max_rows=0).slice_ms == 1000
    assert measure(trades, "1s").slice_ms == 1000


@pytest.mark.parametrize("dataset", DATASETS)
def test_sizing_does_not_change_the_result(small, dataset):
    plain = build(dataset, small, "1d", "true")
    for width in (86_400_000, 60_000):
        sizing = dict.fromkeys(small, Sizing(width))
        same(build(dataset, small, "1d", "true", sizing=sizing), plain)


def test_slippage_needs_both_measured(small):
    plain = build("slippage", small, "1d")
    same(build("slippage", small, "1d", sizing={"trades": Sizing(86_400_000)}), plain)
    assert _width("slippage", {"trades": Sizing(86_400_000)}) is None
    assert _width("slippage", {"trades": Sizing(3_600_000), "quotes": Sizing(60_000)}) == 60_000


GROUPS = {
    "tally": ("ohlcv", "trade_size"),
    "path": ("vtwap", "returns"),
    "single": ("run_structure", "l2_liquidity", "funding"),
}


@pytest.mark.parametrize("group", sorted(GROUPS))
def test_shared_pass_equals_single_datasets(spark, small, root, group):
    names = GROUPS[group]
    sizing = {"trades": Sizing(3_600_000)}
    options = {"limits": (700.0, 2400.0)}
    paths = write_datasets(names, small, root, "1d", sizing=sizing, **options)
    assert len(paths) == len(names)
    for name in names:
        got = lake.load(spark, root, name, "exchange", "1d", None, None, FIRST, LAST, sort=False)
        want = build(name, small, "1d", **options)
        same(got.select(want.columns), want)
