"""Bars from trades: ohlcv, vtwap, flow, trade_size, impact, range, updownticks,
run_structure, returns and slippage.

The dataset names are fixed by the interface; the formulas are this project's own
choice from published definitions. Every builder is ``fn(trades, interval, ts_kind)``,
lazy, and free of Python UDFs. A ratio with denominator zero is null. Price changes and
runs stay inside a bar, so any date slice of the input gives the same bars. Two
measures look back further: ``returns.close_to_close`` (previous bar) and ``slippage``
(prevailing quote).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.catalogue import BAR, SERIES, SIZE_CLASSES, metric_columns
from tickloom.functions.clock import interval_ms
from tickloom.functions.expr import first_by, last_by, order_key, ratio, sum_if, taker_buy
from tickloom.operators.quantiles import exact_quantiles, quantile_aggregates
from tickloom.operators.ranges import Cuts
from tickloom.operators.slices import (
    CHUNK_ROWS,
    carry_last,
    cell_keys,
    cell_window,
    edge_window,
    finish,
    or_previous,
    slice_width,
    ticks,
)

SIZE_LIMITS = (1e3, 1e4)
QUANTILES = {
    "qty": {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95},
    "price": {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95},
}


def _trade_ticks(trades, interval, ts_kind, slice_ms=None):
    return ticks(
        trades,
        "trade_id",
        interval,
        ts_kind,
        {
            "price": "price",
            "qty": "qty",
            "buy": taker_buy(F.col("side")),
        },
        slice_ms,
    )


def _size_class(limits: tuple[float, float]) -> dict[str, Column]:
    """Condition per size class, by notional against two limits."""
    notional = F.col("price") * F.col("qty")
    low, high = (F.lit(float(limit)) for limit in limits)
    return dict(
        zip(
            SIZE_CLASSES,
            (notional < low, (notional >= low) & (notional < high), notional >= high),
            strict=True,
        )
    )


# Plain aggregates: one shuffle of map-side partial sums ---------------------------


def trade_tally(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    limits: tuple[float, float] = SIZE_LIMITS,
    quantiles: str = "exact",
    spread: tuple[str, ...] = ("qty", "price"),
) -> DataFrame:
    """Wide bar table behind ohlcv, flow, trade_size and range.

    A builder selects its columns and Catalyst drops the other sums. ``spread`` names
    the values whose quantiles are wanted; all of them come from one more pass.
    ``quantiles``: ``exact`` (any bar size), ``approx`` or ``sketch``.
    """
    rows = _trade_ticks(trades, interval, ts_kind)
    order = order_key(F.col("ts"), F.col("id"), interval_ms(interval))
    price, qty, buy = F.col("price"), F.col("qty"), F.col("buy")
    sums = [
        first_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        last_by("price", order).alias("close"),
        F.sum("qty").alias("volume"),
        F.min("qty").alias("qty_min"),
        F.max("qty").alias("qty_max"),
        F.when(F.count(qty) >= 3, F.skewness(qty)).alias("qty_skew"),
        F.when(F.count(qty) >= 4, F.kurtosis(qty)).alias("qty_kurt"),
    ]
    for name, value in (("qty", qty), ("price", price)):
        sums.append(F.avg(value).alias(f"{name}_mean"))
        sums.append(F.stddev_samp(value).alias(f"{name}_std"))
    for name, inside in {"": F.lit(True), **_size_class(limits)}.items():
        suffix = f"_{name}" if name else ""
        for side, on in (("buy", buy & inside), ("sell", ~buy & inside)):
            sums.append(sum_if(on, qty).alias(f"{side}_volume{suffix}"))
            sums.append(F.count_if(on).alias(f"{side}_count{suffix}"))
    wanted = {
        value: {f"{value}_{name}": point for name, point in QUANTILES[value].items()}
        for value in spread
    }
    if quantiles != "exact":
        for value, points in wanted.items():
            sums += quantile_aggregates(value, points, quantiles)
    bars = rows.groupBy(*BAR).agg(*sums)
    if quantiles == "exact":
        bars = bars.join(_quantiles(rows, wanted), list(BAR), "left") if wanted else bars
    return bars


def _quantiles(rows: DataFrame, wanted: dict[str, dict[str, float]]) -> DataFrame:
    """Quantiles of several values per bar, ranked together under one shuffle."""
    values = F.array(
        *(F.struct(F.lit(k).alias("which"), F.col(v).alias("v")) for k, v in enumerate(wanted))
    )
    tall = rows.select(*BAR, F.explode(values).alias("x")).select(*BAR, "x.which", "x.v")
    fractions = {f"q{point}": point for points in wanted.values() for point in points.values()}
    fractions = {name.replace(".", "_"): point for name, point in fractions.items()}
    column = {point: name for name, point in fractions.items()}
    found = exact_quantiles(tall, [*BAR, "which"], "v", fractions)
    return found.groupBy(*BAR).agg(
        *(
            F.max(F.when(F.col("which") == k, F.col(column[point]))).alias(name)
            for k, points in enumerate(wanted.values())
            for name, point in points.items()
        )
    )


def ohlcv(trades: DataFrame, interval: str, ts_kind: str = "exchange") -> DataFrame:
    """First, highest, lowest and last price, and traded quantity."""
    bars = trade_tally(trades, interval, ts_kind, spread=())
    return finish(bars, *ohlcv_columns())


def ohlcv_columns() -> list[Column]:
    return [F.col(name) for name in ("open", "high", "low", "close", "volume")]


def flow(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    limits: tuple[float, float] = SIZE_LIMITS,
) -> DataFrame:
    """Taker buy and sell volume and count, in total and per size class."""
    bars = trade_tally(trades, interval, ts_kind, limits=limits, spread=())
    return finish(bars, *flow_columns())


def flow_columns() -> list[Column]:
    """``flow`` columns from its summable ones; also used when resampling."""
    buy, sell = F.col("buy_volume"), F.col("sell_volume")
    count = F.col("buy_count") + F.col("sell_count")
    out = [
        buy,
        sell,
        F.col("buy_count"),
        F.col("sell_count"),
        (buy - sell).alias("net_volume"),
        ratio(buy, buy + sell).alias("buy_volume_ratio"),
        ratio(F.col("buy_count"), count).alias("buy_count_ratio"),
    ]
    for name in SIZE_CLASSES:
        for kind in ("buy_volume", "sell_volume", "buy_count", "sell_count"):
            out.append(F.col(f"{kind}_{name}"))
    return out


def trade_size(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    limits: tuple[float, float] = SIZE_LIMITS,
    quantiles: str = "exact",
) -> DataFrame:
    """Volume and count per size class, and the distribution of trade quantity.

    ``std`` is the sample value; ``skew`` and ``kurt`` (excess) are population values,
    null below 3 and 4 trades.
    """
    bars = trade_tally(
        trades, interval, ts_kind, limits=limits, quantiles=quantiles, spread=("qty",)
    )
    return finish(bars, *trade_size_columns())


def trade_size_columns() -> list[Column]:
    out = []
    for kind in ("volume", "count"):
        for name in SIZE_CLASSES:
            both = F.col(f"buy_{kind}_{name}") + F.col(f"sell_{kind}_{name}")
            out.append(both.alias(f"{kind}_{name}"))
    names = ("mean", "std", "min", "max", *QUANTILES["qty"], "skew", "kurt")
    return out + [F.col(f"qty_{name}").alias(name) for name in names]


def price_range(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    quantiles: str = "exact",
) -> DataFrame:
    """High-low range, Parkinson (1980) variance and the distribution of price."""
    bars = trade_tally(trades, interval, ts_kind, quantiles=quantiles, spread=("price",))
    return finish(bars, *range_columns())


def range_columns() -> list[Column]:
    spread = F.col("high") - F.col("low")
    log_range = F.ln(ratio(F.col("high"), F.col("low")))
    return [
        spread.alias("range"),
        ratio(spread, F.col("open")).alias("range_pct"),
        log_range.alias("log_range"),
        (log_range * log_range / F.lit(4 * math.log(2))).alias("parkinson_var"),
        *(F.col(f"price_{n}").alias(n) for n in ("mean", "std", *QUANTILES["price"])),
    ]


# Order-dependent measures: cells in time order, stitched per bar -------------------


def price_path(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
) -> DataFrame:
    """Wide bar table behind vtwap, impact, updownticks and returns.

    They share one shuffle and one sort of the trades. A builder selects its columns
    and Catalyst drops the windows and sums it doesn't need.
    """
    return path_bars(merge_paths(_path_cells(trades, interval, ts_kind, slice_ms)), interval)


def path_state(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
) -> DataFrame:
    """Bars in a form that can be merged (``resample``): first and last trade, and sums over
    the pairs of neighbouring trades between them."""
    state = merge_paths(_path_cells(trades, interval, ts_kind, slice_ms))
    return finish(state, *metric_columns("path_state"))


def _path_cells(trades, interval, ts_kind, slice_ms) -> DataFrame:
    """Path state of every slice of every bar."""
    cells = cell_keys(interval, slice_ms)
    rows = _trade_ticks(trades, interval, ts_kind, slice_ms)
    by_time = cell_window(cells)
    price, qty = F.col("price"), F.col("qty")
    rows = rows.select(
        "*",
        F.lag("ts").over(by_time).alias("prev_ts"),
        F.lead("ts").over(by_time).alias("next_ts"),
        (price - F.lag("price").over(by_time)).alias("dp"),
        F.ln(ratio(price, F.lag("price").over(by_time))).alias("log_dp"),
        F.when(F.col("buy"), qty).when(~F.col("buy"), -qty).alias("signed"),
    )
    head, tail, dp = F.col("prev_ts").isNull(), F.col("next_ts").isNull(), F.col("dp")
    buy = F.col("buy")

    def at(edge: Column, name: str) -> Column:
        return F.max(F.when(edge, F.col(name)))

    return rows.groupBy(*cells).agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        at(head, "price").alias("first_price"),
        at(head, "qty").alias("first_qty"),
        at(head, "buy").alias("first_buy"),
        at(head, "signed").alias("first_signed"),
        at(tail, "price").alias("last_price"),
        F.sum(price * qty).alias("notional"),
        F.sum(qty).alias("volume"),
        F.sum(price * (F.col("next_ts") - F.col("ts"))).alias("held"),
        F.sum(F.col("log_dp") * F.col("log_dp")).alias("log_dp_sq"),
        F.count(dp).alias("pairs"),
        F.count_if(dp > 0).alias("ups"),
        F.count_if(dp < 0).alias("downs"),
        F.count_if(dp == 0).alias("flats"),
        sum_if(dp > 0, qty).alias("up_qty"),
        sum_if(dp < 0, qty).alias("down_qty"),
        sum_if(buy & dp.isNotNull(), dp).alias("buy_dp"),
        sum_if(buy & dp.isNotNull(), qty).alias("buy_dp_qty"),
        sum_if(~buy & dp.isNotNull(), dp).alias("sell_dp"),
        sum_if(~buy & dp.isNotNull(), qty).alias("sell_dp_qty"),
        F.regr_count("dp", "signed").alias("k_n"),
        F.regr_avgx("dp", "signed").alias("k_x"),
        F.regr_avgy("dp", "signed").alias("k_y"),
        F.regr_sxx("dp", "signed").alias("k_sxx"),
        F.regr_sxy("dp", "signed").alias("k_sxy"),
    )


def merge_paths(cell: DataFrame) -> DataFrame:
    """Path states of neighbouring stretches of time to one per (exchange, symbol, bar).

    The result is a state again and the merge is associative, so slices can be put together
    to minutes, minutes to hours and hours to days.
    """
    # The pair formed by a cell's first trade and the previous cell's last one.
    edges, whole = edge_window(), Window.partitionBy(*BAR)
    last_price, last_ts = F.lag("last_price").over(edges), F.lag("last_ts").over(edges)
    cell = cell.select(
        "*",
        F.lag("first_ts").over(edges).isNull().alias("opens"),
        F.lead("first_ts").over(edges).isNull().alias("closes"),
        (last_price * (F.col("first_ts") - last_ts)).alias("e_held"),
        (F.col("first_price") - last_price).alias("e_dp"),
        F.ln(ratio(F.col("first_price"), last_price)).alias("e_log"),
    ).withColumn("e_x", F.when(F.col("e_dp").isNotNull(), F.col("first_signed")))
    e_dp, e_x, n = F.col("e_dp"), F.col("e_x"), F.col("k_n")
    e_n = F.count("e_x").over(whole) + F.sum("k_n").over(whole)

    def mean(inner: str, edge: Column) -> Column:
        inside = F.coalesce(n * F.col(inner), F.lit(0.0))
        return F.sum(inside + F.coalesce(edge, F.lit(0.0))).over(whole) / F.nullif(
            e_n, F.lit(0)
        )

    cell = cell.withColumns(
        {"m_x": mean("k_x", e_x), "m_y": mean("k_y", F.when(e_x.isNotNull(), e_dp))}
    )
    off_x, off_y = F.col("k_x") - F.col("m_x"), F.col("k_y") - F.col("m_y")
    e_off_x, e_off_y = e_x - F.col("m_x"), e_dp - F.col("m_y")

    def add(*parts: Column) -> Column:
        total = F.coalesce(parts[0], F.lit(0.0))
        for part in parts[1:]:
            total = total + F.coalesce(part, F.lit(0.0))
        return F.sum(total)

    def add_count(name: str, edge: Column) -> Column:
        return F.sum(F.col(name) + F.when(edge, 1).otherwise(0))

    def at(edge: str, name: str) -> Column:
        return F.max(F.when(F.col(edge), F.col(name))).alias(name)

    first_qty, first_buy = F.col("first_qty"), F.col("first_buy")
    return cell.groupBy(*BAR).agg(
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *(at("opens", f"first_{name}") for name in ("price", "qty", "buy", "signed")),
        at("closes", "last_price"),
        F.sum("notional").alias("notional"),
        F.sum("volume").alias("volume"),
        add(F.col("held"), F.col("e_held")).alias("held"),
        add(F.col("log_dp_sq"), F.col("e_log") * F.col("e_log")).alias("log_dp_sq"),
        add_count("pairs", e_dp.isNotNull()).alias("pairs"),
        add_count("ups", e_dp > 0).alias("ups"),
        add_count("downs", e_dp < 0).alias("downs"),
        add_count("flats", e_dp == 0).alias("flats"),
        add(F.col("up_qty"), F.when(e_dp > 0, first_qty)).alias("up_qty"),
        add(F.col("down_qty"), F.when(e_dp < 0, first_qty)).alias("down_qty"),
        add(F.col("buy_dp"), F.when(first_buy, e_dp)).alias("buy_dp"),
        add(F.col("buy_dp_qty"), F.when(first_buy & e_dp.isNotNull(), first_qty)).alias(
            "buy_dp_qty"
        ),
        add(F.col("sell_dp"), F.when(~first_buy, e_dp)).alias("sell_dp"),
        add(F.col("sell_dp_qty"), F.when(~first_buy & e_dp.isNotNull(), first_qty)).alias(
            "sell_dp_qty"
        ),
        F.sum(n + F.when(e_x.isNotNull(), 1).otherwise(0)).alias("k_n"),
        F.max("m_x").alias("k_x"),
        F.max("m_y").alias("k_y"),
        add(F.col("k_sxx"), n * off_x * off_x, e_off_x * e_off_x).alias("k_sxx"),
        add(F.col("k_sxy"), n * off_x * off_y, e_off_x * e_off_y).alias("k_sxy"),
    )


def path_bars(state: DataFrame, interval: str) -> DataFrame:
    """Bar table from the path state of each bar: the last price holds until the bar's end."""
    end = F.col("bar") + interval_ms(interval)
    tail = F.col("last_price") * (end - F.col("last_ts"))
    return state.withColumns(
        {
            "open": F.col("first_price"),
            "close": F.col("last_price"),
            "held": F.coalesce("held", F.lit(0.0)) + F.coalesce(tail, F.lit(0.0)),
            "held_ms": end - F.col("first_ts"),
        }
    )


def vtwap(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
) -> DataFrame:
    """Volume- and time-weighted price.

    A price holds until the next trade or the end of the bar; the time before the
    first trade of a bar has no weight.
    """
    bars = price_path(trades, interval, ts_kind, slice_ms=slice_ms)
    return finish(bars, *vtwap_columns())


def vtwap_columns() -> list[Column]:
    return [
        ratio(F.col("notional"), F.col("volume")).alias("vwap"),
        ratio(F.col("held"), F.col("held_ms")).alias("twap"),
    ]


def impact(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
) -> DataFrame:
    """Price impact: Amihud (2002) per bar, Kyle (1985) lambda as the slope of price
    change on signed quantity, and price change per quantity on each side."""
    bars = price_path(trades, interval, ts_kind, slice_ms=slice_ms)
    return finish(bars, *impact_columns())


def impact_columns() -> list[Column]:
    move = ratio(F.col("close"), F.col("open")) - F.lit(1.0)
    slope = ratio(F.col("k_sxy"), F.col("k_sxx"))
    return [
        ratio(F.abs(move), F.col("notional")).alias("amihud"),
        F.when(F.col("k_n") >= 2, slope).alias("kyle_lambda"),
        ratio(F.col("buy_dp"), F.col("buy_dp_qty")).alias("buy_impact"),
        ratio(F.col("sell_dp"), F.col("sell_dp_qty")).alias("sell_impact"),
    ]


def updownticks(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
) -> DataFrame:
    """Trades above, below and at the previous price of the bar."""
    bars = price_path(trades, interval, ts_kind, slice_ms=slice_ms)
    return finish(bars, *updowntick_columns())


def updowntick_columns() -> list[Column]:
    ups, downs, pairs = F.col("ups"), F.col("downs"), F.col("pairs")
    return [
        ups.alias("up_count"),
        downs.alias("down_count"),
        F.col("flats").alias("flat_count"),
        F.col("up_qty").alias("up_volume"),
        F.col("down_qty").alias("down_volume"),
        ratio(ups, downs).alias("up_down_ratio"),
        ratio(ups, pairs).alias("up_pct"),
        ratio(downs, pairs).alias("down_pct"),
    ]


def returns(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Open-to-close return, realized variance and close-to-close log return.

    ``close_to_close`` at the first bar of a series in the input needs the close before
    it: ``previous`` (exchange, symbol, value), see ``reports.last_values``; else it is null.
    """
    bars = price_path(trades, interval, ts_kind, slice_ms=slice_ms)
    return finish(with_previous_close(bars, interval, chunk_rows, previous), *return_columns())


def with_previous_close(
    bars: DataFrame,
    interval: str,
    chunk_rows: int = CHUNK_ROWS,
    previous: DataFrame | None = None,
) -> DataFrame:
    bars = carry_last(bars, "close", "bar", interval_ms(interval), "prev_close", chunk_rows)
    return or_previous(bars, "prev_close", previous)


def return_columns() -> list[Column]:
    move = ratio(F.col("close"), F.col("open"))
    return [
        (move - F.lit(1.0)).alias("ret"),
        F.ln(move).alias("log_ret"),
        F.col("log_dp_sq").alias("realized_var"),
        F.ln(ratio(F.col("close"), F.col("prev_close"))).alias("close_to_close"),
    ]


def run_structure(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
) -> DataFrame:
    """Runs: longest stretches of trades on one side within a bar.

    Inside a cell all runs but the first and the last are final. Those two are put in
    time order with the edge runs of the other cells and joined where sides agree.
    """
    state = merge_runs(_run_cells(trades, interval, ts_kind, slice_ms))
    return finish(state, *run_columns())


def run_state(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
) -> DataFrame:
    """Bars in a form that can be merged (``resample``): first and last run, and sums over the
    runs between them. A bar of one run has no last one."""
    state = merge_runs(_run_cells(trades, interval, ts_kind, slice_ms))
    return finish(state, *metric_columns("run_state"))


def _run_cells(trades, interval, ts_kind, slice_ms) -> DataFrame:
    """Run state of every slice of every bar."""
    cells = cell_keys(interval, slice_ms)
    by_time = cell_window(cells)
    starts = F.coalesce((F.col("buy") != F.col("prev_buy")).cast("int"), F.lit(1))
    rows = (
        _trade_ticks(trades, interval, ts_kind, slice_ms)
        .withColumn("prev_buy", F.lag("buy").over(by_time))
        .withColumn(
            "run",
            F.sum(starts).over(
                by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    )
    runs = (
        rows.groupBy(*cells, "run")
        .agg(
            F.min("ts").alias("run_ts"),
            F.count(F.lit(1)).alias("length"),
            F.sum("qty").alias("qty"),
            F.max("buy").alias("buy"),
        )
        .withColumn("runs", F.max("run").over(Window.partitionBy(*cells)))
    )
    return runs.groupBy(*cells).agg(F.min("run_ts").alias("first_ts"), *_run_state())


_RUN_PARTS = ("length", "qty", "buy")
_RUN_SUMS = ("inner_runs", "inner_buy_runs", "inner_trades")
_RUN_TOPS = ("inner_length", "inner_qty")


def _run_state(*, merged: bool = False) -> list[Column]:
    """Aggregates over the runs 1 to ``runs`` of a stretch. ``merged`` runs bring along what
    lies inside the cells they come from."""
    head = F.col("run") == 1
    tail = (F.col("run") == F.col("runs")) & ~head
    inner = ~head & ~tail
    length = F.when(inner, F.col("length"))
    sums = [F.count_if(inner), F.count_if(inner & F.col("buy")), F.sum(F.coalesce(length, F.lit(0)))]
    tops = [F.max(length), F.max(F.when(inner, F.col("qty")))]
    if merged:
        sums = [s + F.coalesce(F.sum(n), F.lit(0)) for s, n in zip(sums, _RUN_SUMS, strict=True)]
        tops = [F.greatest(t, F.max(n)) for t, n in zip(tops, _RUN_TOPS, strict=True)]
    return [
        *(F.max(F.when(head, F.col(part))).alias(f"head_{part}") for part in _RUN_PARTS),
        *(F.max(F.when(tail, F.col(part))).alias(f"tail_{part}") for part in _RUN_PARTS),
        *(c.alias(name) for c, name in zip(sums + tops, _RUN_SUMS + _RUN_TOPS, strict=True)),
    ]


def merge_runs(cell: DataFrame) -> DataFrame:
    """Run states of neighbouring stretches of time to one per (exchange, symbol, bar); the
    result is a state again."""

    def edge_run(name: str) -> Column:
        fields = F.struct(*(F.col(f"{name}_{part}").alias(part) for part in _RUN_PARTS))
        return F.when(F.col(f"{name}_length").isNotNull(), fields)

    inside = _RUN_SUMS + _RUN_TOPS
    edges = cell.select(
        *BAR,
        "first_ts",
        *inside,
        F.posexplode(F.array_compact(F.array(edge_run("head"), edge_run("tail")))).alias("pos", "edge"),
    ).select(
        *BAR,
        "first_ts",
        "pos",
        "edge.*",
        *(F.when(F.col("pos") == 0, F.col(name)).alias(name) for name in inside),
    )
    order = Window.partitionBy(*BAR).orderBy("first_ts", "pos")
    # A cell's tail never joins its own head: other runs lie between, or sides differ.
    differs = F.coalesce(
        ((F.col("buy") != F.col("prev_buy")) | (F.col("pos") == 1)).cast("int"), F.lit(1)
    )
    joined = (
        edges.withColumn("prev_buy", F.lag("buy").over(order))
        .withColumn(
            "run",
            F.sum(differs).over(
                order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .groupBy(*BAR, "run")
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.sum("length").alias("length"),
            F.sum("qty").alias("qty"),
            F.max("buy").alias("buy"),
            *(F.sum(name).alias(name) for name in _RUN_SUMS),
            *(F.max(name).alias(name) for name in _RUN_TOPS),
        )
        .withColumn("runs", F.max("run").over(Window.partitionBy(*BAR)))
    )
    return joined.groupBy(*BAR).agg(F.min("first_ts").alias("first_ts"), *_run_state(merged=True))


def run_columns() -> list[Column]:
    """``run_structure`` columns from a run state."""
    tail = F.col("tail_length").isNotNull()
    runs = F.col("inner_runs") + 1 + tail.cast("int")
    buys = F.col("inner_buy_runs") + F.coalesce(F.col("head_buy").cast("int"), F.lit(0))
    buys = buys + F.coalesce(F.col("tail_buy").cast("int"), F.lit(0))
    trades = F.col("head_length") + F.coalesce("tail_length", F.lit(0)) + F.col("inner_trades")
    return [
        runs.alias("run_count"),
        F.greatest("head_length", "tail_length", "inner_length").alias("max_run_length"),
        ratio(trades, runs).alias("mean_run_length"),
        buys.alias("buy_run_count"),
        (runs - buys).alias("sell_run_count"),
        F.greatest("head_qty", "tail_qty", "inner_qty").alias("max_run_volume"),
    ]


def slippage(
    trades: DataFrame,
    quotes: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    previous: DataFrame | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Quantity-weighted effective half-spread against the prevailing mid, in bps.

    A trade at ``p`` against mid ``m`` costs ``sign * (p - m) / m``. Trades whose mid
    is in their own slice are summed directly. For trades before the slice's first
    quote the sums of ``sign*q*p`` and ``sign*q`` are kept; the mid they need, the last
    one of an earlier slice, is the same for all of them and is filled in on the slice
    table. So trades and quotes are scanned, shuffled and sorted once. A quote whose mid
    is null or zero counts as no quote, a trade without price or quantity costs nothing. ``previous`` (exchange, symbol, value) holds the
    last mid before the input, for trades before its first quote.

    ``cuts`` (``ranges.balance``) takes the place of slices of one width. In a millisecond that
    it deals over parts all trades count as open, with the millisecond's own last mid.
    """
    width = slice_width(interval, slice_ms) if cuts is None else cuts.width_ms
    mid = F.nullif((F.col("bid_price") + F.col("ask_price")) / F.lit(2.0), F.lit(0.0))
    null = F.lit(None)
    quote_rows = ticks(
        quotes,
        "quote_id",
        interval,
        ts_kind,
        {
            "kind": F.lit(0),
            "mid": mid,
            "price": null.cast("double"),
            "qty": null.cast("double"),
            "buy": null.cast("boolean"),
        },
        slice_ms,
    ).where(F.col("mid").isNotNull())
    trade_rows = ticks(
        trades,
        "trade_id",
        interval,
        ts_kind,
        {
            "kind": F.lit(1),
            "mid": null.cast("double"),
            "price": "price",
            "qty": "qty",
            "buy": taker_buy(F.col("side")),
        },
        slice_ms,
    )
    rows = quote_rows.unionByName(trade_rows)
    cells = [*SERIES, "slice"]
    if cuts is not None:
        rows = cuts.place(rows).withColumn("slice", F.greatest("slice", "bar"))
        cells.append("part")
    by_time = cell_window(cells, "ts", "kind", "id")
    rows = rows.select(
        "*",
        F.last("mid", ignorenulls=True)
        .over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("m"),
        F.lead("ts").over(by_time).isNull().alias("is_last"),
    )
    trade, known_mid = F.col("kind") == 1, F.col("m").isNotNull()
    last_mid, own_mid = F.max(F.when(F.col("is_last"), F.col("m"))), F.lit(False)
    if cuts is not None:
        known_mid = known_mid & (F.col("parts") == 1)
        quote_order = F.when(~trade, order_key(F.col("ts"), F.col("id"), width))
        last_mid, own_mid = F.max_by("mid", quote_order), F.max("parts") > 1
    met, open_ = trade & known_mid, trade & ~known_mid
    price, qty, m = F.col("price"), F.col("qty"), F.col("m")
    priced = price.isNotNull() & qty.isNotNull()
    sums = []
    for side, of_side, sign in (
        ("buy", F.col("buy") & priced, 1.0),
        ("sell", ~F.col("buy") & priced, -1.0),
    ):
        sums += [
            sum_if(met & of_side, F.lit(sign) * qty * (price - m) / m).alias(f"{side}_cost"),
            sum_if(met & of_side, qty).alias(f"{side}_qty"),
            sum_if(open_ & of_side, F.lit(sign) * qty * price).alias(f"{side}_open_pq"),
            sum_if(open_ & of_side, F.lit(sign) * qty).alias(f"{side}_open_q"),
        ]
    slices = rows.groupBy(*BAR, "slice").agg(
        last_mid.alias("last_mid"),
        own_mid.alias("own_mid"),
        F.count_if(trade).alias("trades"),
        F.count_if(open_).alias("open_trades"),
        *sums,
    )
    slices = carry_last(slices, "last_mid", "slice", width, "seed", chunk_rows)
    slices = or_previous(slices, "seed", previous)
    own = F.when(F.col("own_mid"), F.col("last_mid"))
    slices = slices.withColumn("seed", F.coalesce(own, "seed"))
    seed = F.col("seed")
    known = seed.isNotNull()
    totals = []
    for side, sign in (("buy", 1.0), ("sell", -1.0)):
        late = F.col(f"{side}_open_pq") / seed - F.col(f"{side}_open_q")
        late_qty = F.lit(sign) * F.col(f"{side}_open_q")
        totals += [
            F.sum(F.col(f"{side}_cost") + F.when(known, late).otherwise(0.0)).alias(
                f"{side}_cost"
            ),
            F.sum(F.col(f"{side}_qty") + F.when(known, late_qty).otherwise(0.0)).alias(
                f"{side}_qty"
            ),
        ]
    bars = (
        slices.groupBy(*BAR)
        .agg(
            *totals,
            F.sum(F.when(known, 0).otherwise(F.col("open_trades"))).alias("unmatched_count"),
            F.sum("trades").alias("trades"),
        )
        .where(F.col("trades") > 0)
    )

    def bps(cost: Column, qty_: Column) -> Column:
        return ratio(cost * F.lit(1e4), qty_)

    buy_cost, sell_cost = F.col("buy_cost"), F.col("sell_cost")
    buy_qty, sell_qty = F.col("buy_qty"), F.col("sell_qty")
    return finish(
        bars,
        bps(buy_cost + sell_cost, buy_qty + sell_qty).alias("slippage_bps"),
        bps(buy_cost, buy_qty).alias("buy_slippage_bps"),
        bps(sell_cost, sell_qty).alias("sell_slippage_bps"),
        "unmatched_count",
    )
