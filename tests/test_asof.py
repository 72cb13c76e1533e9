import bisect

import pytest
from pyspark.sql import functions as F

from tickloom.operators.asof import asof_mid
from tickloom.operators.slices import carry_last

T0 = 1704067200000
DAY = 86_400_000


def brute(trades, quotes, clock):
    series = {}
    for q in quotes.collect():
        if q.bid_price is not None and q.ask_price is not None and q[clock] is not None:
            mid = (q.bid_price + q.ask_price) / 2
            series.setdefault((q.exchange, q.symbol), []).append((q[clock], q.quote_id, mid))
    for rows in series.values():
        rows.sort()
    out = {}
    for t in trades.collect():
        rows = series.get((t.exchange, t.symbol), [])
        place = None if t[clock] is None else bisect.bisect(rows, (t[clock], float("inf"), 0))
        out[t.trade_id] = rows[place - 1][2] if place else None
    return out


@pytest.mark.parametrize("kind", ["exchange", "true"])
@pytest.mark.parametrize(("width", "chunk"), [(900_000, 4096), (DAY, 4096), (3_600_000, 2)])
def test_against_brute_force(small, kind, width, chunk):
    got = asof_mid(
        small["trades"], small["quotes"], kind, slice_ms=width, chunk_rows=chunk
    ).collect()
    want = brute(small["trades"], small["quotes"], f"{kind}_ts")
    assert {row.trade_id: row.mid for row in got} == want
    assert len(got) == small["trades"].count()


def test_edges(trades, quotes):
    t = trades(
        [
            (T0, 10, 1, "buy"),  # before any quote
            (T0 + 10, 10, 1, "buy"),  # same ms as two quotes
            (T0 + 5, 10, 1, "buy"),
            (T0 + 3 * DAY, 10, 1, "buy"),  # days without quotes
        ]
    )
    q = quotes(
        [
            (T0 + 10, 1.0, 1.0, 1.0, 1.0),
            (T0 + 10, 2.0, 2.0, 1.0, 1.0),
            (T0 + 11, None, 2.0, 1.0, 1.0),
        ]
    )
    rows = {row.trade_id: row.mid for row in asof_mid(t, q).collect()}
    assert rows == {0: None, 1: 2.0, 2: None, 3: 2.0}


def test_trades_without_clock_are_kept(trades, quotes):
    t = trades([(T0, 10, 1, "buy"), (T0, 11, 1, "buy")]).withColumn(
        "exchange_ts", F.when(F.col("trade_id") == 0, F.col("exchange_ts"))
    )
    rows = asof_mid(t, quotes([(T0, 9.0, 11.0, 1.0, 1.0)])).collect()
    assert {row.trade_id: row.mid for row in rows} == {0: 10.0, 1: None}
    assert rows[0].asDict().keys() >= set(t.columns)


def test_carry_last(spark):
    values = [None, 1, None, None, 4, None, 6, None, None, None, None, 11, None]
    steps = [0, 1, 2, 3, 4, 5, 6, 7, 20, 21, 40, 41, 90]
    rows = [
        ("x", name, step * 10, None if value is None else float(value))
        for name in ("a", "b")
        for step, value in zip(steps, values, strict=True)
    ]
    df = spark.createDataFrame(rows, "exchange string, symbol string, at bigint, v double")
    want = [None, None, 1, 1, 1, 4, 4, 6, 6, 6, 6, 6, 11]
    for chunk in (1, 2, 3, 5, 1000):
        got = carry_last(df, "v", "at", 10, "prev", chunk).where("symbol = 'b'")
        assert [row.prev for row in got.orderBy("at").collect()] == want
    assert got.columns == [*df.columns, "prev"]
