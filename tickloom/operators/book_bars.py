"""Bars from top-of-book quotes (l1_*) and order-book snapshots (l2_*).

Names are fixed by the interface, formulas are this project's own. Averages are plain
means over updates unless the name says ``twap`` or ``vwap``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.catalogue import BAR, BOOK_DEPTHS
from tickloom.functions.clock import interval_ms
from tickloom.functions.expr import order_key, ratio
from tickloom.operators.slices import (
    cell_keys,
    cell_window,
    edge_window,
    finish,
    ticks,
)

_TOP = ("bid_price", "ask_price", "bid_size", "ask_size")


def _quote_ticks(quotes, interval, ts_kind, slice_ms=None):
    return ticks(quotes, "quote_id", interval, ts_kind, {c: c for c in _TOP}, slice_ms)


def l1_price(
    quotes: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    slice_ms: int | None = None,
) -> DataFrame:
    """Last bid, ask and mid; time- and size-weighted mid; mean micro-price.

    A mid holds until the next quote or the end of the bar.
    """
    cells = cell_keys(interval, slice_ms)
    by_time = cell_window(cells)
    bid, ask, bid_size, ask_size = map(F.col, _TOP)
    size = bid_size + ask_size
    rows = _quote_ticks(quotes, interval, ts_kind, slice_ms).select(
        "*",
        ((bid + ask) / F.lit(2.0)).alias("mid"),
        ratio(bid * ask_size + ask * bid_size, size).alias("micro"),
        F.lead("ts").over(by_time).alias("next_ts"),
    )
    last = F.col("next_ts").isNull()
    cell = rows.groupBy(*cells).agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.max(F.when(last, bid)).alias("bid"),
        F.max(F.when(last, ask)).alias("ask"),
        F.max(F.when(last, F.col("mid"))).alias("mid"),
        F.sum(F.col("mid") * (F.col("next_ts") - F.col("ts"))).alias("held"),
        F.sum(F.col("mid") * size).alias("mid_size"),
        F.sum(size).alias("size"),
        F.sum("micro").alias("micro"),
        F.count("micro").alias("micro_n"),
    )
    cell = cell.withColumn("next_first", F.lead("first_ts").over(edge_window()))
    final = F.col("next_first").isNull()
    end = F.coalesce(F.col("next_first"), F.col("bar") + interval_ms(interval))
    held = F.coalesce(F.col("held"), F.lit(0.0))
    tail = F.coalesce(F.col("mid") * (end - F.col("last_ts")), F.lit(0.0))
    bars = cell.groupBy(*BAR).agg(
        F.max(F.when(final, F.col("bid"))).alias("bid_price"),
        F.max(F.when(final, F.col("ask"))).alias("ask_price"),
        F.max(F.when(final, F.col("mid"))).alias("mid_price"),
        F.sum(held + tail).alias("held"),
        F.sum(end - F.col("first_ts")).alias("held_ms"),
        F.sum("mid_size").alias("mid_size"),
        F.sum("size").alias("size"),
        F.sum("micro").alias("micro"),
        F.sum("micro_n").alias("micro_n"),
    )
    return finish(
        bars,
        "bid_price",
        "ask_price",
        "mid_price",
        ratio(F.col("held"), F.col("held_ms")).alias("mid_twap"),
        ratio(F.col("mid_size"), F.col("size")).alias("mid_vwap"),
        ratio(F.col("micro"), F.col("micro_n")).alias("micro_price"),
    )


def mid_state(quotes: DataFrame, interval: str, ts_kind: str = "exchange") -> DataFrame:
    """The last valid mid of each bar (null and zero are none), which later bars look back at,
    and the number of quotes."""
    order = order_key(F.col("ts"), F.col("id"), interval_ms(interval))
    mid = F.nullif((F.col("bid_price") + F.col("ask_price")) / F.lit(2.0), F.lit(0.0))
    rows = _quote_ticks(quotes, interval, ts_kind).withColumn("mid", mid)
    bars = rows.groupBy(*BAR).agg(
        F.max_by("mid", F.when(F.col("mid").isNotNull(), order)).alias("last_mid"),
        F.count(F.lit(1)).alias("quotes"),
    )
    return finish(bars, "last_mid", "quotes")


def quote_tally(quotes: DataFrame, interval: str, ts_kind: str = "exchange") -> DataFrame:
    """Wide bar table behind l1_imbalance and l1_liquidity."""
    bid, ask, bid_size, ask_size = map(F.col, _TOP)
    size, mid = bid_size + ask_size, (bid + ask) / F.lit(2.0)
    return (
        _quote_ticks(quotes, interval, ts_kind)
        .groupBy(*BAR)
        .agg(
            F.avg(ratio(bid_size - ask_size, size)).alias("imbalance"),
            F.avg(ratio(bid_size, ask_size)).alias("ratio"),
            F.avg(ratio(bid_size, size)).alias("bid_pct"),
            F.avg(ratio(ask_size, size)).alias("ask_pct"),
            F.avg(ask - bid).alias("spread"),
            F.avg(ratio((ask - bid) * F.lit(1e4), mid)).alias("spread_bps"),
            F.avg(size).alias("depth"),
            F.avg(bid * bid_size + ask * ask_size).alias("dollar_depth"),
        )
    )


def l1_imbalance(quotes: DataFrame, interval: str, ts_kind: str = "exchange") -> DataFrame:
    """Mean bid/ask size imbalance, ratio and shares at the top of the book."""
    return finish(quote_tally(quotes, interval, ts_kind), *l1_imbalance_columns())


def l1_imbalance_columns() -> list[Column]:
    return [F.col(name) for name in ("imbalance", "ratio", "bid_pct", "ask_pct")]


def l1_liquidity(quotes: DataFrame, interval: str, ts_kind: str = "exchange") -> DataFrame:
    """Mean spread (absolute and in bps of mid), depth and dollar depth."""
    return finish(quote_tally(quotes, interval, ts_kind), *l1_liquidity_columns())


def l1_liquidity_columns() -> list[Column]:
    return [F.col(name) for name in ("spread", "spread_bps", "depth", "dollar_depth")]


def _running(term, length: Column, depth: int, known: Column) -> list[Column]:
    """Sums of the first 0 to ``depth`` terms; levels past ``length`` add nothing.

    Depths are known when the plan is built, so sums are plain expressions that code
    generation compiles, each made from the one before. A null level makes the sum null,
    a missing array too.
    """
    sums = [F.when(known, F.lit(0.0))]
    for level in range(depth):
        sums.append(sums[-1] + F.when(length > level, term(level)).otherwise(F.lit(0.0)))
    return sums


def _level_sums(side: str, depth: int) -> tuple[list[Column], list[Column]]:
    """Running sums of size and of price times size on one side."""
    px, size = F.col(f"{side}_px"), F.col(f"{side}_sz")
    sizes = _running(lambda k: F.get(size, F.lit(k)), F.size(size), depth, size.isNotNull())
    cash = _running(
        lambda k: F.get(px, F.lit(k)) * F.get(size, F.lit(k)),
        F.greatest(F.size(px), F.size(size)),
        depth,
        px.isNotNull() & size.isNotNull(),
    )
    return sizes, cash


def book_tally(
    book: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    depths: tuple[int, ...] = BOOK_DEPTHS,
) -> DataFrame:
    """Wide bar table behind l2_imbalance and l2_liquidity.

    Each snapshot becomes one row of sums over its top levels before the shuffle; the
    level arrays go no further.
    """
    values, sums = {}, []
    for side in ("bid", "ask"):
        sizes, cash = _level_sums(side, max(depths))
        for k in depths:
            values[f"{side}_size_{k}"] = sizes[k]
            values[f"{side}_cash_{k}"] = cash[k]
    for k in depths:
        for kind, name in (("size", "imbalance"), ("cash", "dollar_imbalance")):
            bid, ask = F.col(f"bid_{kind}_{k}"), F.col(f"ask_{kind}_{k}")
            sums.append(F.avg(ratio(bid - ask, bid + ask)).alias(f"{name}_{k}"))
        for side in ("bid", "ask"):
            sums.append(F.avg(f"{side}_size_{k}").alias(f"{side}_depth_{k}"))
            sums.append(F.avg(f"{side}_cash_{k}").alias(f"{side}_dollar_{k}"))
    return ticks(book, "quote_id", interval, ts_kind, values).groupBy(*BAR).agg(*sums)


def l2_imbalance(
    book: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    depths: tuple[int, ...] = BOOK_DEPTHS,
) -> DataFrame:
    """Mean size and dollar imbalance over the top levels."""
    bars = book_tally(book, interval, ts_kind, depths=depths)
    return finish(bars, *l2_imbalance_columns(depths))


def l2_imbalance_columns(depths: tuple[int, ...] = BOOK_DEPTHS) -> list[Column]:
    names = ("imbalance", "dollar_imbalance")
    return [F.col(f"{name}_{k}") for k in depths for name in names]


def l2_liquidity(
    book: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    depths: tuple[int, ...] = BOOK_DEPTHS,
) -> DataFrame:
    """Mean size and dollar depth over the top levels, per side."""
    bars = book_tally(book, interval, ts_kind, depths=depths)
    return finish(bars, *l2_liquidity_columns(depths))


def l2_liquidity_columns(depths: tuple[int, ...] = BOOK_DEPTHS) -> list[Column]:
    kinds = ("bid_depth", "ask_depth", "bid_dollar", "ask_dollar")
    return [F.col(f"{kind}_{k}") for k in depths for kind in kinds]
