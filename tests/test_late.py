import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import same
from tickloom import catalogue
from tickloom.plans import late as late_ticks
from tickloom.plans.build import build, sources_of, write_dataset
from tickloom.plans.late import LOOKS_BACK, changed_bars, rebuild
from tickloom.sources import lake

T0 = 1704067200000
HOUR = 3_600_000
X, S = "okx-perps", "A"


def trade(k, ts, price=10.0, symbol=S):
    return (k, X, symbol, ts, ts, price, 1.0, "buy" if k % 2 else "sell")


def quote(k, ts, bid=9.0, symbol=S):
    return (k, X, symbol, ts, ts, bid, 11.0, 1.0, 1.0)


def frames(spark, trades, quotes):
    return {
        "trades": spark.createDataFrame(trades, catalogue.TRADES),
        "quotes": spark.createDataFrame(quotes, catalogue.QUOTES),
    }


def stored(spark, root, dataset):
    df = lake.load(spark, root, dataset, "exchange", "1h", None, None, date(2024, 1, 1), date(2024, 2, 1))
    return df.select("exchange", "symbol", "timestamp", *catalogue.metric_columns(dataset))


def first_load(dataset, tables, root):
    for name in (*LOOKS_BACK.get(dataset, ())[:1], dataset):
        write_dataset(name, tables, root, "1h")


def together(one, other):
    return {name: df.unionByName(other[name]) for name, df in one.items()}


def hours(bars):
    return sorted((r.bar - T0) // HOUR for r in bars.collect())


def test_bars_that_are_rebuilt(spark, root):
    """Trades in hours 0 to 11, quotes in hours 0, 4 and 8 (that of hour 4 has no mid)."""
    tables = frames(
        spark,
        [trade(k, T0 + k * HOUR + 60_000) for k in range(12)],
        [quote(0, T0), quote(1, T0 + 4 * HOUR, None), quote(2, T0 + 8 * HOUR)],
    )
    for dataset in ("ohlcv", "returns", "slippage"):
        first_load(dataset, tables, root)
    late = frames(spark, [trade(90, T0 + 3 * HOUR), trade(91, T0 + 11 * HOUR)], [quote(92, T0 + HOUR)])
    now = together(tables, late)
    for dataset, want in {
        "ohlcv": [3, 11],
        "returns": [3, 4, 11],
        # by trades 3 and 11; by the quote 1 and all that look back at it, 8 with trades before
        # the next valid quote's hour ends
        "slippage": [1, 2, 3, 4, 5, 6, 7, 8, 11],
    }.items():
        bars = rebuild(dataset, now, late, root, "1h")
        assert hours(bars) == want
        same(stored(spark, root, dataset), build(dataset, now, "1h").drop("time"))
    no_quotes = {"trades": late["trades"]}
    assert hours(changed_bars("slippage", no_quotes, root, "1h")) == [3, 11]


def test_only_ticks_of_changed_bars_are_read(spark, root, monkeypatch):
    tables = frames(spark, [trade(k, T0 + k * HOUR) for k in range(50)], [])
    first_load("ohlcv", tables, root)
    late = {"trades": spark.createDataFrame([trade(99, T0 + 7 * HOUR + 1)], catalogue.TRADES)}
    read = []
    monkeypatch.setattr(
        late_ticks, "build", lambda d, t, *a, **o: read.append(t["trades"].count()) or build(d, t, *a, **o)
    )
    rebuild("ohlcv", together({"trades": tables["trades"]}, late), late, root, "1h")
    assert read == [2]


@pytest.mark.parametrize("dataset", ["returns", "slippage", "run_structure", "l1_price"])
def test_random_loads_in_any_order(spark, root, dataset):
    r = random.Random(dataset)
    trades = [
        trade(k, T0 + r.randrange(60) * HOUR // 2 + r.randrange(3), r.choice([9.5, 10.0, 10.5, None]), r.choice("AB"))
        for k in range(120)
    ]
    quotes = [
        quote(k, T0 + r.randrange(30) * HOUR + r.randrange(3) * 900_000, r.choice([8.0, 9.0, None]), r.choice("AB"))
        for k in range(40)
    ]
    r.shuffle(trades)
    r.shuffle(quotes)
    loads = [frames(spark, trades[a::4], quotes[a::4]) for a in range(4)]
    now = loads[0]
    first_load(dataset, now, root)
    for k, again in ((1, False), (2, False), (3, False), (2, True)):
        late = {name: loads[k][name] for name in sources_of(dataset)}
        now = now if again else together(now, loads[k])
        rebuild(dataset, now, late, root, "1h")
        same(stored(spark, root, dataset), build(dataset, now, "1h").drop("time"))


def test_nothing_late_and_wrong_input(spark, root):
    tables = frames(spark, [trade(k, T0 + k * HOUR) for k in range(3)], [quote(0, T0)])
    first_load("returns", tables, root)
    none = {"trades": tables["trades"].limit(0)}
    assert hours(rebuild("returns", tables, none, root, "1h")) == []
    same(stored(spark, root, "returns"), build("returns", tables, "1h").drop("time"))
    with pytest.raises(ValueError, match="no late ticks"):
        changed_bars("returns", {"quotes": tables["quotes"]}, root, "1h")
    lost = {"trades": tables["trades"].withColumn("symbol", F.lit(None).cast("string"))}
    assert hours(changed_bars("ohlcv", lost, root, "1h")) == []
