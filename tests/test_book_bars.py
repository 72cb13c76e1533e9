import pytest

from tests.helpers import check, only, same
from tickloom import catalogue
from tickloom.operators import book_bars as bb

T0 = 1704067200000
MIN = 60_000

# Mids 10, 11, 20 in slices 0, 0 and 3 of the hour.
THREE = [
    (T0 + 2 * MIN, 9.0, 11.0, 1.0, 3.0),
    (T0 + 5 * MIN, 10.0, 12.0, 2.0, 2.0),
    (T0 + 50 * MIN, 19.0, 21.0, 6.0, 2.0),
]


@pytest.mark.parametrize("width", [None, MIN, 60 * MIN])
def test_l1_price(quotes, width):
    row = only(bb.l1_price(quotes(THREE), "1h", slice_ms=width))
    check(
        row,
        bid_price=19,
        ask_price=21,
        mid_price=20,
        mid_twap=(10 * 3 + 11 * 45 + 20 * 10) / 58,
        mid_vwap=(10 * 4 + 11 * 4 + 20 * 8) / 16,
        micro_price=((27 + 11) / 4 + (20 + 24) / 4 + (38 + 126) / 8) / 3,
    )


def test_l1_imbalance(quotes):
    row = only(bb.l1_imbalance(quotes(THREE), "1h"))
    check(
        row,
        imbalance=(-0.5 + 0 + 0.5) / 3,
        ratio=(1 / 3 + 1 + 3) / 3,
        bid_pct=(0.25 + 0.5 + 0.75) / 3,
        ask_pct=(0.75 + 0.5 + 0.25) / 3,
    )


def test_l1_liquidity(quotes):
    row = only(bb.l1_liquidity(quotes(THREE), "1h"))
    check(
        row,
        spread=2,
        spread_bps=(2 / 10 + 2 / 11 + 2 / 20) * 1e4 / 3,
        depth=16 / 3,
        dollar_depth=(9 + 33 + 20 + 24 + 114 + 42) / 3,
    )


def test_empty_sides_give_null_ratios(quotes):
    row = only(bb.l1_imbalance(quotes([(T0, 9.0, 11.0, 0.0, 0.0)]), "1h"))
    check(row, imbalance=None, ratio=None, bid_pct=None, ask_pct=None)
    row = only(bb.l1_price(quotes([(T0, 9.0, 11.0, 0.0, 0.0)]), "1h"))
    check(row, mid_price=10, mid_twap=10, mid_vwap=None, micro_price=None)


@pytest.fixture
def book(spark):
    def snapshot(i, ts, size):
        prices = [100.0 - level for level in range(10)]
        return (
            i, "okx-perps", "perpetual-A", ts, ts,
            prices, [size] * 10, [201.0 - p for p in prices], [1.0] * 10,
        )

    return spark.createDataFrame(
        [snapshot(0, T0, 3.0), snapshot(1, T0 + MIN, 1.0)], catalogue.BOOK
    )


def test_l2_imbalance(book):
    row = only(bb.l2_imbalance(book, "1h"))
    for k in (1, 5, 10):
        check(row, **{f"imbalance_{k}": (0.5 + 0) / 2})
    check(row, dollar_imbalance_1=((300 - 101) / (300 + 101) + (100 - 101) / 201) / 2)
    bid, ask = sum(range(96, 101)), sum(range(101, 106))
    check(
        row,
        dollar_imbalance_5=((3 * bid - ask) / (3 * bid + ask) + (bid - ask) / (bid + ask)) / 2,
    )


def test_l2_liquidity(book):
    row = only(bb.l2_liquidity(book, "1h"))
    check(row, bid_depth_1=2, ask_depth_1=1, bid_depth_5=10, ask_depth_10=10)
    check(row, bid_dollar_1=200, ask_dollar_1=101, bid_dollar_5=2 * sum(range(96, 101)))


def test_depths_are_a_parameter(book):
    row = only(bb.l2_liquidity(book, "1h", depths=(2,)))
    check(row, bid_depth_2=4, ask_dollar_2=203)


def test_slice_width_does_not_matter(small):
    whole = bb.l1_price(small["quotes"], "1d", "true", slice_ms=86_400_000)
    same(bb.l1_price(small["quotes"], "1d", "true", slice_ms=60_000), whole)
