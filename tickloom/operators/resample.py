"""Coarser bars from finer ones, for the datasets whose columns can be merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.catalogue import BAR, SERIES, SIZE_CLASSES, metric_columns
from tickloom.functions.clock import interval_ms, time_bucket
from tickloom.functions.expr import ratio
from tickloom.operators.deriv_bars import open_interest_columns
from tickloom.operators.sketches import merge_sketches
from tickloom.operators.slices import finish
from tickloom.operators.trade_bars import (
    flow_columns,
    impact_columns,
    merge_paths,
    merge_runs,
    path_bars,
    return_columns,
    run_columns,
    updowntick_columns,
    vtwap_columns,
    with_previous_close,
)

MERGEABLE = ("ohlcv", "vtwap", "flow", "open_interest")

#: Datasets that a state table gives at any coarser interval: its merge and their columns.
_FROM_PATH = {
    "vtwap": vtwap_columns,
    "impact": impact_columns,
    "updownticks": updowntick_columns,
    "returns": return_columns,
}
FROM_STATES = {**dict.fromkeys(_FROM_PATH, "path_state"), "run_structure": "run_state"}


def _merge_mids(states: DataFrame) -> DataFrame:
    known = F.when(F.col("last_mid").isNotNull(), F.col("timestamp"))
    return states.groupBy(*BAR).agg(
        F.max_by("last_mid", known).alias("last_mid"), F.sum("quotes").alias("quotes")
    )


_MERGES = {
    "path_state": merge_paths,
    "run_state": merge_runs,
    "mid_state": _merge_mids,
    "sketch_state": merge_sketches,
}


def _merged(states: DataFrame, kind: str, interval: str) -> DataFrame:
    bar = time_bucket(F.col("timestamp"), interval_ms(interval))
    return _MERGES[kind](states.withColumn("bar", bar))


def merge_states(states: DataFrame, kind: str, interval: str) -> DataFrame:
    """States of ``kind`` (a table of ``catalogue.STATES``) merged to the coarser ``interval``.

    The input holds one row per bar, not per trade; it may itself come from a merge.
    """
    if kind not in _MERGES:
        raise ValueError(f"{kind!r} is no state table; one of {', '.join(_MERGES)}")
    return finish(_merged(states, kind, interval), *metric_columns(kind))


def from_states(
    states: DataFrame, dataset: str, interval: str, *, previous: DataFrame | None = None
) -> DataFrame:
    """Bars of ``dataset`` at ``interval`` from finer (or equal) states of ``FROM_STATES``.

    Same bars as from the trades. ``previous`` is for returns: the last close before the states.
    """
    if dataset not in FROM_STATES:
        raise ValueError(f"{dataset!r} has no state; only {', '.join(FROM_STATES)}")
    merged = _merged(states, FROM_STATES[dataset], interval)
    if dataset == "run_structure":
        return finish(merged, *run_columns())
    bars = path_bars(merged, interval)
    if dataset == "returns":
        bars = with_previous_close(bars, interval, previous=previous)
    return finish(bars, *_FROM_PATH[dataset]())


def _first(name: str):
    return F.min_by(name, "timestamp").alias(name)


def _last(name: str):
    return F.max_by(name, "timestamp").alias(name)


def resample(bars: DataFrame, dataset: str, interval: str) -> DataFrame:
    """Bars of ``dataset`` merged to the coarser ``interval``.

    Given states instead of bars, the datasets of ``FROM_STATES`` are made from them. From bars,
    ``vtwap`` keeps only ``vwap`` (a twap cannot be merged) and needs the ``volume`` of each bar
    next to it, which the ohlcv bars hold. Quantiles belong to one bar and cannot be merged.
    """
    if dataset in FROM_STATES and "first_ts" in bars.columns:
        return from_states(bars, dataset, interval)
    grouped = bars.withColumn(
        "bar", time_bucket(F.col("timestamp"), interval_ms(interval))
    ).groupBy(*BAR)
    if dataset == "ohlcv":
        merged = grouped.agg(
            _first("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            _last("close"),
            F.sum("volume").alias("volume"),
        )
        return finish(merged, "open", "high", "low", "close", "volume")
    if dataset == "vtwap":
        if "volume" not in bars.columns:
            raise ValueError("resampling vwap needs the volume of each bar")
        merged = grouped.agg(
            F.sum(F.col("vwap") * F.col("volume")).alias("notional"),
            F.sum("volume").alias("volume"),
        )
        return finish(merged, ratio(F.col("notional"), F.col("volume")).alias("vwap"), "volume")
    if dataset == "flow":
        kinds = ("buy_volume", "sell_volume", "buy_count", "sell_count")
        names = [*kinds, *(f"{kind}_{size}" for size in SIZE_CLASSES for kind in kinds)]
        merged = grouped.agg(*(F.sum(name).alias(name) for name in names))
        return finish(merged, *flow_columns())
    if dataset == "open_interest":
        merged = grouped.agg(
            _first("oi_open"),
            F.max("oi_high").alias("oi_high"),
            F.min("oi_low").alias("oi_low"),
            _last("oi_close"),
            _last("oi_notional"),
        )
        return finish(merged, *open_interest_columns())
    if dataset in FROM_STATES:
        raise ValueError(
            f"{dataset!r} bars cannot be merged; make them from {FROM_STATES[dataset]}"
        )
    raise ValueError(f"{dataset!r} cannot be merged; only {', '.join(MERGEABLE)}")


def vwap_with_volume(vtwap: DataFrame, ohlcv: DataFrame) -> DataFrame:
    """Input for resampling vwap: both bar tables, joined on series and bar."""
    keys = [*SERIES, "timestamp"]
    return vtwap.select(*keys, "vwap").join(ohlcv.select(*keys, "volume"), keys)
