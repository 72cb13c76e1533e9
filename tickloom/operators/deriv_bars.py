"""Bars from derivative ticks: basis, funding, open_interest, derivative_price.

Names are fixed by the interface, formulas are this project's own. Each is one hash
shuffle of map-side partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.catalogue import BAR
from tickloom.functions.clock import interval_ms
from tickloom.functions.expr import first_by, last_by, order_key, ratio
from tickloom.operators.slices import finish, ticks

_OHLC = ("open", "high", "low", "close")


def deriv_tally(deriv: DataFrame, interval: str, ts_kind: str = "exchange") -> DataFrame:
    """Wide bar table behind all four datasets; unused sums are dropped by Catalyst."""
    mark, index = F.col("mark_price"), F.col("index_price")
    rate, held = F.col("funding_rate"), F.col("open_interest")
    names = ("mark_price", "index_price", "funding_rate", "open_interest")
    rows = ticks(deriv, "tick_id", interval, ts_kind, {name: name for name in names})
    order = order_key(F.col("ts"), F.col("id"), interval_ms(interval))
    gap = mark - index
    sums = [
        F.avg(gap).alias("basis_mean"),
        last_by(gap, order).alias("basis_close"),
        last_by(ratio(gap, index) * F.lit(1e4), order).alias("basis_bps_close"),
        last_by(rate, order).alias("funding_close"),
        F.avg(rate).alias("funding_mean"),
        F.min(rate).alias("funding_min"),
        F.max(rate).alias("funding_max"),
        last_by(held * mark, order).alias("oi_notional"),
    ]
    for name, value in (("mark", mark), ("index", index), ("oi", held)):
        sums += [
            first_by(value, order).alias(f"{name}_open"),
            F.max(value).alias(f"{name}_high"),
            F.min(value).alias(f"{name}_low"),
            last_by(value, order).alias(f"{name}_close"),
        ]
    return rows.groupBy(*BAR).agg(*sums)


def basis_columns() -> list[Column]:
    return [F.col(name) for name in ("basis_mean", "basis_close", "basis_bps_close")]


def funding_columns() -> list[Column]:
    rest = [F.col(f"funding_{name}") for name in ("mean", "min", "max")]
    return [F.col("funding_close").alias("funding_rate"), *rest]


def open_interest_columns() -> list[Column]:
    """Also used when resampling."""
    change = (F.col("oi_close") - F.col("oi_open")).alias("oi_change")
    head = [F.col(f"oi_{name}") for name in _OHLC]
    return [*head, change, F.col("oi_notional")]


def derivative_price_columns() -> list[Column]:
    return [F.col(f"{kind}_{name}") for kind in ("mark", "index") for name in _OHLC]


def basis(deriv: DataFrame, interval: str, ts_kind: str = "exchange", **options) -> DataFrame:
    """Mark minus index: mean, last, and last in bps of index."""
    return finish(deriv_tally(deriv, interval, ts_kind, **options), *basis_columns())


def funding(deriv: DataFrame, interval: str, ts_kind: str = "exchange", **options) -> DataFrame:
    """Funding rate: last, mean, lowest and highest."""
    return finish(deriv_tally(deriv, interval, ts_kind, **options), *funding_columns())


def open_interest(
    deriv: DataFrame, interval: str, ts_kind: str = "exchange", **options
) -> DataFrame:
    """Open interest: first, highest, lowest, last, change, and last notional at mark."""
    return finish(deriv_tally(deriv, interval, ts_kind, **options), *open_interest_columns())


def derivative_price(
    deriv: DataFrame, interval: str, ts_kind: str = "exchange", **options
) -> DataFrame:
    """Open, high, low and close of mark and of index price."""
    return finish(deriv_tally(deriv, interval, ts_kind, **options), *derivative_price_columns())
