import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import same
from tests.test_asof import brute
from tickloom import catalogue
from tickloom.operators.asof import asof_mid
from tickloom.operators.ranges import Cuts, balance
from tickloom.operators.trade_bars import slippage

T0 = 1704067200000
DAY = 86_400_000


def crowded(spark, seed, n, inside):
    """Trades and quotes of two series, most of them as ``inside`` places them."""
    r = random.Random(seed)
    trades, quotes = [], []
    for k in range(n):
        symbol = r.choice("AB") if k % 10 == 0 else "A"
        ts = T0 + (r.randrange(3 * DAY) if k % 10 == 0 else inside(r))
        if k % 2:
            bid = None if r.random() < 0.05 else r.uniform(1, 9)
            quotes.append((k, "okx-perps", symbol, ts, ts, bid, r.uniform(9, 11), 1.0, 1.0))
        else:
            side = r.choice(["buy", "sell"])
            trades.append((k, "okx-perps", symbol, ts, ts, r.uniform(1, 11), 1.0, side))
    return (
        spark.createDataFrame(trades, catalogue.TRADES).cache(),
        spark.createDataFrame(quotes, catalogue.QUOTES).cache(),
    )


def in_a_second(r):
    return DAY + 3_600_000 + r.randrange(1000)


def in_a_millisecond(r):
    return DAY + 3_600_000 + (0 if r.random() < 0.8 else r.randrange(5))


@pytest.mark.parametrize("inside", [in_a_second, in_a_millisecond])
@pytest.mark.parametrize("target", [None, 7, 150])
def test_asof_and_slippage_of_crowded_time(spark, inside, target):
    trades, quotes = crowded(spark, 1, 1500, inside)
    cuts = balance([trades, quotes], width_ms=DAY, target_rows=target)
    got = asof_mid(trades, quotes, cuts=cuts)
    assert {r.trade_id: r.mid for r in got.collect()} == brute(trades, quotes, "exchange_ts")
    for interval in ("1m", "4h", "1d"):
        same(slippage(trades, quotes, interval, cuts=cuts), slippage(trades, quotes, interval))


@pytest.mark.parametrize("inside", [in_a_second, in_a_millisecond])
def test_no_task_holds_twice_the_mean(spark, inside):
    """90 % of the rows in one second: as shuffled by slice and part, over 8 tasks."""
    trades, quotes = crowded(spark, 2, 40_000, inside)
    ticks = trades.select("exchange", "symbol", F.col("exchange_ts").alias("ts"), F.col("trade_id").alias("id"))
    ticks = ticks.unionByName(
        quotes.select("exchange", "symbol", F.col("exchange_ts").alias("ts"), F.col("quote_id").alias("id"))
    )
    target = 40_000 // (8 * 8)
    cuts = balance([trades, quotes], width_ms=DAY, target_rows=target)
    placed = cuts.place(ticks)
    sizes = [r["count"] for r in placed.groupBy("exchange", "symbol", "slice", "part").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * target
    dealt = placed.repartition(8, "exchange", "symbol", "slice", "part")
    tasks = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 2 * 40_000 / 8
    # a fixed width of one second puts nine tenths into one task
    fixed = ticks.repartition(8, "exchange", "symbol", F.floor(F.col("ts") / 1000))
    tasks = [r["count"] for r in fixed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) >= 0.85 * 40_000


def test_slices_are_neighbours_in_time(spark):
    trades, quotes = crowded(spark, 3, 2000, in_a_second)
    cuts = balance([trades, quotes], width_ms=3_600_000, target_rows=40)
    ticks = trades.select("exchange", "symbol", F.col("exchange_ts").alias("ts"), F.col("trade_id").alias("id"))
    rows = cuts.place(ticks).orderBy("symbol", "ts").collect()
    for one, other in zip(rows, rows[1:]):
        if one.symbol == other.symbol:
            assert one.slice <= other.slice and one.slice <= one.ts
    assert len({(r.symbol, r.slice) for r in rows}) > 40


def test_uncounted_rows_behind_a_dealt_millisecond(spark):
    trades, quotes = crowded(spark, 4, 600, lambda r: 5 * DAY)
    cuts = balance([trades, quotes], width_ms=DAY, target_rows=50)
    more = [(10**6 + k, "okx-perps", "A", T0 + 5 * DAY + d, T0, 5.0, 1.0, "buy") for k, d in enumerate((-1, 0, 1, 9))]
    trades = trades.unionByName(spark.createDataFrame(more, catalogue.TRADES))
    got = asof_mid(trades, quotes, cuts=cuts)
    assert {r.trade_id: r.mid for r in got.collect()} == brute(trades, quotes, "exchange_ts")


def test_quiet_and_empty_input(spark):
    trades, quotes = crowded(spark, 5, 40, in_a_second)
    assert balance([trades, quotes], target_rows=1000) == Cuts(900_000)
    none = [trades.limit(0), quotes.limit(0)]
    assert balance(none) == Cuts(900_000)
    assert asof_mid(*none).collect() == []
    with pytest.raises(ValueError):
        balance(none, width_ms=2 * DAY)
