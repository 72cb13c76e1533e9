"""Hand-computed bars, and slices against whole bars."""

import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import check, only, same
from tickloom.catalogue import metric_columns
from tickloom.operators import trade_bars as tb

T0 = 1704067200000  # 2024-01-01
MIN = 60_000
HOUR = 3_600_000

# Four trades over three 15-minute slices; the last two share a slice.
FOUR = [
    (T0 + 5 * MIN, 10, 2, "buy"),
    (T0 + 20 * MIN, 12, 1, "buy"),
    (T0 + 50 * MIN, 11, 3, "sell"),
    (T0 + 55 * MIN, 11, 4, "buy"),
]
ONE = [(T0 + HOUR, 10, 2, "sell")]


def hourly(builder, df, **options):
    return only(builder(df, "1h", **options))


def test_keys(trades):
    row = hourly(tb.ohlcv, trades(FOUR))
    assert row["timestamp"] == T0
    assert str(row["time"]) == "2024-01-01 00:00:00"
    assert (row["exchange"], row["symbol"]) == ("binance-futures", "perpetual-A-USDT:USDT")


def test_ohlcv(trades):
    row = hourly(tb.ohlcv, trades(FOUR))
    check(row, open=10, high=12, low=10, close=11, volume=10)


def test_same_millisecond_is_ordered_by_id(trades):
    rows = [(T0, price, 1, "buy") for price in (5, 9, 7)]
    df = trades(rows).orderBy(F.desc("trade_id"))
    check(hourly(tb.ohlcv, df), open=5, close=7)
    check(hourly(tb.returns, df), ret=7 / 5 - 1)


@pytest.mark.parametrize("ids", [(None, -5, 3), (-(2**63), 0, 2**63 - 1), (-7, -6, -5)])
def test_any_id_orders_ticks(trades, ids):
    rows = trades([(T0, price, 1, "buy") for price in (5, 9, 7)])
    ids = F.array(*(F.lit(i).cast("bigint") for i in ids))
    df = rows.withColumn("trade_id", F.element_at(ids, (F.col("trade_id") + 1).cast("int")))
    check(hourly(tb.ohlcv, df.orderBy(F.rand(1))), open=5, close=7)
    check(only(tb.ohlcv(df, "1d")), open=5, close=7)


def test_unknown_side_counts_for_neither(trades):
    rows = [(T0, 10, 2, "buy"), (T0 + 1, 11, 3, "BUY"), (T0 + 2, 12, 5, None), (T0 + 3, 13, 7, "sell")]
    check(hourly(tb.flow, trades(rows)), buy_volume=2, sell_volume=7, buy_count=1, sell_count=1)
    check(hourly(tb.ohlcv, trades(rows)), volume=17)
    check(hourly(tb.impact, trades(rows)), buy_impact=None, sell_impact=1 / 7)


def test_vtwap(trades):
    row = hourly(tb.vtwap, trades(FOUR))
    check(
        row,
        vwap=(20 + 12 + 33 + 44) / 10,
        twap=(10 * 15 + 12 * 30 + 11 * 5 + 11 * 5) / 55,
    )
    check(hourly(tb.vtwap, trades(ONE)), vwap=10, twap=10)


def test_flow(trades):
    row = hourly(tb.flow, trades(FOUR), limits=(15, 33))
    check(
        row,
        buy_volume=7,
        sell_volume=3,
        buy_count=3,
        sell_count=1,
        net_volume=4,
        buy_volume_ratio=0.7,
        buy_count_ratio=0.75,
        buy_volume_small=1,
        buy_volume_medium=2,
        buy_volume_large=4,
        sell_volume_large=3,  # notional 33 is on the upper limit
        sell_count_large=1,
        sell_count_small=0,
        sell_volume_medium=0,
    )
    row = hourly(tb.flow, trades(ONE))
    check(row, buy_volume=0, buy_count=0, buy_volume_ratio=0, net_volume=-2)


def test_trade_size(trades):
    row = hourly(tb.trade_size, trades(FOUR), limits=(15, 33))
    qty = [2, 1, 3, 4]
    mean = 2.5
    m2 = sum((x - mean) ** 2 for x in qty) / 4
    m4 = sum((x - mean) ** 4 for x in qty) / 4
    check(
        row,
        mean=mean,
        std=math.sqrt(m2 * 4 / 3),
        min=1,
        max=4,
        p25=1.75,
        p50=2.5,
        p75=3.25,
        p95=3.85,
        skew=0,
        kurt=m4 / m2**2 - 3,
        volume_small=1,
        count_medium=1,
        volume_large=7,
    )
    row = hourly(tb.trade_size, trades(ONE))
    check(row, mean=2, std=None, p25=2, p95=2, skew=None, kurt=None)
    row = hourly(tb.trade_size, trades(FOUR[:3]))
    assert row["skew"] is not None and row["kurt"] is None


def test_impact(trades):
    row = hourly(tb.impact, trades(FOUR))
    pairs = [(1, 2), (-3, -1), (4, 0)]  # signed quantity, price change
    mx = sum(x for x, _ in pairs) / 3
    my = sum(y for _, y in pairs) / 3
    slope = sum((x - mx) * (y - my) for x, y in pairs) / sum((x - mx) ** 2 for x, _ in pairs)
    check(
        row,
        amihud=abs(11 / 10 - 1) / 109,
        kyle_lambda=slope,
        buy_impact=(2 + 0) / (1 + 4),
        sell_impact=-1 / 3,
    )
    check(
        hourly(tb.impact, trades(ONE)),
        amihud=0,
        kyle_lambda=None,
        buy_impact=None,
        sell_impact=None,
    )
    check(hourly(tb.impact, trades(FOUR[:2])), kyle_lambda=None, buy_impact=2)


def test_range(trades):
    row = hourly(tb.price_range, trades(FOUR))
    check(
        row,
        range=2,
        range_pct=0.2,
        log_range=math.log(1.2),
        parkinson_var=math.log(1.2) ** 2 / (4 * math.log(2)),
        mean=11,
        std=math.sqrt(2 / 3),
        p05=10.15,
        p25=10.75,
        p50=11,
        p75=11.25,
        p95=11.85,
    )
    check(hourly(tb.price_range, trades(ONE)), range=0, std=None, p05=10)


def test_updownticks(trades):
    row = hourly(tb.updownticks, trades(FOUR))
    check(
        row,
        up_count=1,
        down_count=1,
        flat_count=1,
        up_volume=1,
        down_volume=3,
        up_down_ratio=1,
        up_pct=1 / 3,
        down_pct=1 / 3,
    )
    row = hourly(tb.updownticks, trades(ONE))
    check(row, up_count=0, flat_count=0, up_volume=0, up_down_ratio=None, up_pct=None)


def test_returns(trades):
    rows = [*FOUR, (T0 + HOUR, 22, 1, "buy"), (T0 + 5 * HOUR, 44, 1, "buy")]
    first, second, third = tb.returns(trades(rows), "1h").orderBy("timestamp").collect()
    check(
        first,
        ret=0.1,
        log_ret=math.log(1.1),
        realized_var=math.log(12 / 10) ** 2 + math.log(11 / 12) ** 2,
        close_to_close=None,
    )
    check(second, ret=0, realized_var=0, close_to_close=math.log(2))
    check(third, close_to_close=math.log(2))  # empty hours in between are skipped


def test_runs(trades):
    row = hourly(tb.run_structure, trades(FOUR))
    check(
        row,
        run_count=3,
        max_run_length=2,
        mean_run_length=4 / 3,
        buy_run_count=2,
        sell_run_count=1,
        max_run_volume=4,
    )
    check(hourly(tb.run_structure, trades(ONE)), run_count=1, buy_run_count=0, sell_run_count=1)


def test_one_sided_bar_is_one_run(trades):
    rows = [(T0 + i * 7 * MIN, 10, 1, "buy") for i in range(8)]
    check(
        hourly(tb.run_structure, trades(rows)),
        run_count=1,
        max_run_length=8,
        mean_run_length=8,
        max_run_volume=8,
        sell_run_count=0,
    )


def test_slippage(trades, quotes):
    book = quotes([(T0 + 10 * MIN, 9, 11, 1, 1), (T0 + 50 * MIN, 10, 12, 1, 1)])
    row = only(tb.slippage(trades(FOUR), book, "1h"))
    # mids: none, 10 (an earlier slice), 11 (same ms), 11
    buy = 1 * (12 - 10) / 10 + 4 * 0
    sell = -3 * 0
    check(
        row,
        slippage_bps=(buy + sell) * 1e4 / 8,
        buy_slippage_bps=buy * 1e4 / 5,
        sell_slippage_bps=0,
        unmatched_count=1,
    )


def test_slippage_without_quotes_and_after_an_empty_day(trades, quotes):
    row = only(tb.slippage(trades(FOUR), quotes([(T0 + 2 * HOUR, 9, 11, 1, 1)]), "1h"))
    check(row, slippage_bps=None, buy_slippage_bps=None, unmatched_count=4)
    late = [(T0 + 49 * HOUR, 11, 1, "buy")]
    row = only(tb.slippage(trades(late), quotes([(T0, 9, 11, 1, 1)]), "1h"))
    check(row, slippage_bps=1000, unmatched_count=0)


def test_slippage_skips_null_and_zero_mids(trades, quotes):
    rows = [(T0, 9.0, 11.0, 1.0, 1.0), (T0 + MIN, None, 5.0, 1.0, 1.0),
            (T0 + 2 * MIN, 0.0, 0.0, 1.0, 1.0)]
    row = only(tb.slippage(trades(FOUR[:1]), quotes(rows), "1h"))
    check(row, slippage_bps=0, unmatched_count=0)


def test_arrival_time_moves_a_trade_to_the_next_bar(trades):
    df = trades(FOUR).withColumn("true_ts", F.col("true_ts") + 8 * MIN)
    first, second = tb.ohlcv(df, "1h", "true").orderBy("timestamp").collect()
    check(first, volume=6, close=11)
    check(second, volume=4)


def test_rows_without_clock_or_symbol_are_left_out(trades):
    df = trades(FOUR)
    odd = df.withColumn("exchange_ts", F.lit(None).cast("bigint")).unionByName(
        df.withColumn("symbol", F.lit(None).cast("string"))
    )
    for builder in (tb.ohlcv, tb.vtwap):
        same(builder(df.unionByName(odd), "1h"), builder(df, "1h"))


def test_bars_ignore_series_and_rows_of_others(trades):
    other = trades(FOUR, symbol="perpetual-B-USDT:USDT", exchange="okx-perps")
    for builder in (tb.returns, tb.run_structure):
        got = builder(trades(FOUR).unionByName(other), "1h").where("exchange != 'okx-perps'")
        same(got, builder(trades(FOUR), "1h"))


def test_slice_must_divide_the_interval(trades):
    with pytest.raises(ValueError, match="divide"):
        tb.vtwap(trades(FOUR), "1h", slice_ms=7000)


SLICED = [tb.vtwap, tb.impact, tb.updownticks, tb.returns, tb.run_structure]


@pytest.mark.parametrize("builder", SLICED)
def test_slice_width_does_not_matter(small, builder):
    whole = builder(small["trades"], "1d", "true", slice_ms=86_400_000)
    for width in (60_000, 14_400_000):
        same(builder(small["trades"], "1d", "true", slice_ms=width), whole)


def test_slice_width_does_not_matter_for_slippage(small):
    def bars(**options):
        return tb.slippage(small["trades"], small["quotes"], "4h", "true", **options)

    whole = bars(slice_ms=14_400_000)
    same(bars(slice_ms=60_000), whole)
    same(bars(slice_ms=900_000, chunk_rows=3), whole)


def test_chunk_size_does_not_matter_for_returns(small):
    whole = tb.returns(small["trades"], "4h")
    for rows in (1, 7):
        same(tb.returns(small["trades"], "4h", chunk_rows=rows), whole)


def test_any_date_slice_gives_the_same_bars(small):
    day = 86_400_000
    part = small["trades"].where(F.col("exchange_ts").between(T0 + 5 * day, T0 + 6 * day - 1))
    for builder in (tb.vtwap, tb.impact, tb.run_structure):
        kept = builder(small["trades"], "4h").where(
            F.col("timestamp").between(T0 + 5 * day, T0 + 6 * day - 1)
        )
        same(builder(part, "4h"), kept)


def test_approximate_quantiles_are_near(small):
    got = tb.trade_size(small["trades"], "1d", quantiles="approx").toPandas()
    assert ((got["min"] <= got["p50"]) & (got["p50"] <= got["max"])).all()
    with pytest.raises(ValueError):
        tb.trade_size(small["trades"], "1d", quantiles="guess")


def test_columns_follow_the_catalogue(small):
    for name, builder in {"flow": tb.flow, "range": tb.price_range, "impact": tb.impact}.items():
        columns = builder(small["trades"], "1d").columns
        assert columns[:4] == ["exchange", "symbol", "timestamp", "time"]
        assert sorted(columns[4:]) == sorted(metric_columns(name))
