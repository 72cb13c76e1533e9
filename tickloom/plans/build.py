"""From tick tables to datasets and to the lake."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.catalogue import INTERVAL_MS, SERIES, check_dataset
from tickloom.functions.clock import interval_ms, time_bucket, ts_column
from tickloom.operators import book_bars, deriv_bars, sketches, trade_bars
from tickloom.operators.ranges import Cuts
from tickloom.operators.slices import finish
from tickloom.session import shared_folder
from tickloom.sources.lake import write_lake

MAX_CELL_ROWS = 2_000_000

_SLICED = {
    "vtwap", "impact", "updownticks", "run_structure", "returns", "slippage", "l1_price",
    "path_state", "run_state",
}
_SIZED = {"flow", "trade_size"}
_WIDTHS = ("1m", "15m", "1h")

_BUILDERS = {
    "ohlcv": ("trades", trade_bars.ohlcv),
    "vtwap": ("trades", trade_bars.vtwap),
    "flow": ("trades", trade_bars.flow),
    "trade_size": ("trades", trade_bars.trade_size),
    "impact": ("trades", trade_bars.impact),
    "range": ("trades", trade_bars.price_range),
    "updownticks": ("trades", trade_bars.updownticks),
    "run_structure": ("trades", trade_bars.run_structure),
    "returns": ("trades", trade_bars.returns),
    "slippage": ("trades", trade_bars.slippage),
    "l1_price": ("quotes", book_bars.l1_price),
    "l1_imbalance": ("quotes", book_bars.l1_imbalance),
    "l1_liquidity": ("quotes", book_bars.l1_liquidity),
    "l2_imbalance": ("book", book_bars.l2_imbalance),
    "l2_liquidity": ("book", book_bars.l2_liquidity),
    "basis": ("deriv", deriv_bars.basis),
    "funding": ("deriv", deriv_bars.funding),
    "open_interest": ("deriv", deriv_bars.open_interest),
    "derivative_price": ("deriv", deriv_bars.derivative_price),
    "path_state": ("trades", trade_bars.path_state),
    "run_state": ("trades", trade_bars.run_state),
    "mid_state": ("quotes", book_bars.mid_state),
    "sketch_state": ("trades", sketches.sketch_state),
}


def source_of(dataset: str) -> str:
    """Name of the input a dataset is made from; slippage takes quotes too."""
    return _BUILDERS[check_dataset(dataset)][0]


def sources_of(dataset: str) -> tuple[str, ...]:
    """Names of all inputs of a dataset."""
    return ("trades", "quotes") if dataset == "slippage" else (source_of(dataset),)


@dataclass(frozen=True)
class Sizing:
    """Into which slices to cut the bars of one input."""

    slice_ms: int


def measure(
    df: DataFrame, interval: str, ts_kind: str = "exchange", max_rows: int = MAX_CELL_ROWS
) -> Sizing:
    """Count rows per slice of several widths and pick the widest that is safe.

    One pass over key columns with map-side sums; a single row comes back. The width is
    the largest whose fullest slice has at most ``max_rows`` rows (one second if even a
    minute has more). It decides how work is spread, not how a value is defined: methods
    are the same for every size. Sums of doubles may differ in their last bits, as they do
    with any change in the number of partitions.
    """
    ts, whole = F.col(ts_column(ts_kind)), interval_ms(interval)
    widths = [INTERVAL_MS[name] for name in _WIDTHS if INTERVAL_MS[name] < whole] + [whole]
    counts = df.where(ts.isNotNull()).select(*SERIES, ts.alias("at"))
    rows, peaks = F.count(F.lit(1)), []
    for width in widths:
        # Each level sums the one before, so the input is read and combined once.
        counts = counts.groupBy(*SERIES, time_bucket(F.col("at"), width).alias("at")).agg(
            rows.alias("n"), *peaks
        )
        counts = counts.withColumn(f"peak_{width}", F.col("n"))
        rows = F.sum("n")
        peaks = [F.max(name).alias(name) for name in counts.columns if name.startswith("peak_")]
    found = counts.agg(*peaks).first()
    fitting = [width for width in widths if (found[f"peak_{width}"] or 0) <= max_rows]
    return Sizing(max(fitting) if fitting else min(INTERVAL_MS["1s"], whole))


def _width(dataset: str, sizing: dict[str, Sizing]) -> int | None:
    """Slice width for a dataset: that of its input, for slippage the lesser of its two."""
    sources = sources_of(dataset)
    known = [sizing[name].slice_ms for name in sources if name in sizing]
    return min(known) if len(known) == len(sources) else None


def build(
    dataset: str,
    inputs: dict[str, DataFrame],
    interval: str,
    ts_kind: str = "exchange",
    *,
    limits: tuple[float, float] | None = None,
    sizing: dict[str, Sizing] | None = None,
    previous: DataFrame | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Bars of one dataset; ``inputs`` holds trades, quotes, book and deriv by name.

    ``sizing`` holds measurements of the inputs by name. Slippage mixes trades and quotes
    in its slices and uses a measured width only if both were measured. ``previous`` is for
    returns (last close) and slippage (last mid) of a part of the input. ``cuts``
    (``ranges.balance`` of trades and quotes) cuts slippage by row counts instead of width.
    """
    source, builder = _BUILDERS[check_dataset(dataset)]
    options = {}
    if limits is not None and dataset in _SIZED:
        options["limits"] = limits
    if dataset in _SLICED:
        options["slice_ms"] = _width(dataset, sizing or {})
    if dataset in ("returns", "slippage"):
        options["previous"] = previous
    tables = [inputs[source]]
    if dataset == "slippage":
        tables.append(inputs["quotes"])
        options["cuts"] = cuts
    return builder(*tables, interval, ts_kind, **options)


def write_dataset(
    dataset: str,
    inputs: dict[str, DataFrame],
    root: str,
    interval: str,
    ts_kind: str = "exchange",
    **options,
) -> str:
    bars = build(dataset, inputs, interval, ts_kind, **options)
    return write_lake(bars, root, dataset, interval, ts_kind)


# Datasets cut from one wide bar table: input, its builder, and columns per dataset.
_FAMILIES = (
    (
        "trades",
        trade_bars.trade_tally,
        {
            "ohlcv": trade_bars.ohlcv_columns,
            "flow": trade_bars.flow_columns,
            "trade_size": trade_bars.trade_size_columns,
            "range": trade_bars.range_columns,
        },
    ),
    (
        "trades",
        trade_bars.price_path,
        {
            "vtwap": trade_bars.vtwap_columns,
            "impact": trade_bars.impact_columns,
            "updownticks": trade_bars.updowntick_columns,
            "returns": trade_bars.return_columns,
        },
    ),
    (
        "quotes",
        book_bars.quote_tally,
        {
            "l1_imbalance": book_bars.l1_imbalance_columns,
            "l1_liquidity": book_bars.l1_liquidity_columns,
        },
    ),
    (
        "book",
        book_bars.book_tally,
        {
            "l2_imbalance": book_bars.l2_imbalance_columns,
            "l2_liquidity": book_bars.l2_liquidity_columns,
        },
    ),
    (
        "deriv",
        deriv_bars.deriv_tally,
        {
            "basis": deriv_bars.basis_columns,
            "funding": deriv_bars.funding_columns,
            "open_interest": deriv_bars.open_interest_columns,
            "derivative_price": deriv_bars.derivative_price_columns,
        },
    ),
)


def _wide_options(builder, wanted, limits, sizing: dict[str, Sizing]) -> dict:
    options = {}
    if builder is trade_bars.trade_tally:
        values = {"trade_size": "qty", "range": "price"}
        options["spread"] = tuple(values[name] for name in wanted if name in values)
        if limits is not None:
            options["limits"] = limits
    elif builder is trade_bars.price_path:
        options["slice_ms"] = _width("vtwap", sizing)
    return options


def write_datasets(
    datasets: Sequence[str],
    inputs: dict[str, DataFrame],
    root: str,
    interval: str,
    ts_kind: str = "exchange",
    *,
    limits: tuple[float, float] | None = None,
    sizing: dict[str, Sizing] | None = None,
) -> list[str]:
    """Write several datasets with one pass per group that shares its work.

    Ten trade datasets need five scans of the trades in four groups (the tally group scans
    twice if quantiles are wanted), four derivative datasets one.
    A group's wide bar table is written once to the shared folder (not cached, so it
    survives lost executors) and the datasets are cut from it. ``sizing`` holds the
    measurement of each input by name.
    """
    sizing = sizing or {}
    left = [check_dataset(name) for name in dict.fromkeys(datasets)]
    paths = []
    for source, builder, members in _FAMILIES:
        wanted = [name for name in left if name in members]
        if len(wanted) < 2:
            continue
        options = _wide_options(builder, wanted, limits, sizing)
        wide = builder(inputs[source], interval, ts_kind, **options)
        spark, staged = wide.sparkSession, shared_folder(wide.sparkSession, "bars")
        wide.write.parquet(staged)
        wide = spark.read.schema(wide.schema).parquet(staged)
        for name in wanted:
            bars = wide
            if name == "returns":
                bars = trade_bars.with_previous_close(wide, interval)
            bars = finish(bars, *members[name]())
            paths.append(write_lake(bars, root, name, interval, ts_kind))
            left.remove(name)
    for name in left:
        options = {"limits": limits, "sizing": sizing}
        paths.append(write_dataset(name, inputs, root, interval, ts_kind, **options))
    return paths
