"""Quantile sketches of bars: bounded in size, mergeable, stored like any bar column.

An explicit choice beside exact quantiles, for bars too large or too many to be ranked again
whenever the interval changes. A KLL sketch of ``k`` keeps every value up to about ``k`` of
them; beyond, a quantile's rank is off by about 1.4 % of the bar's trades (k = 200, 99 %
confidence), and merged sketches keep that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.catalogue import BAR
from tickloom.operators.slices import finish, ticks

K = 200
SKETCHED = ("qty", "price")


def sketch_state(
    trades: DataFrame, interval: str, ts_kind: str = "exchange", *, k: int = K
) -> DataFrame:
    """One sketch of trade quantity and one of price per bar, built before the shuffle. Nulls and
    NaNs are left out; a bar without any value has an empty sketch."""
    rows = ticks(trades, "trade_id", interval, ts_kind, {name: name for name in SKETCHED})
    sketches = [
        F.kll_sketch_agg_double(F.when(~F.isnan(name), F.col(name)), k).alias(f"{name}_sketch")
        for name in SKETCHED
    ]
    return finish(rows.groupBy(*BAR).agg(*sketches), *(f"{name}_sketch" for name in SKETCHED))


def merge_sketches(states: DataFrame, k: int = K) -> DataFrame:
    """Sketches of neighbouring bars to one per (exchange, symbol, bar)."""
    return states.groupBy(*BAR).agg(
        *(F.kll_merge_agg_double(f"{name}_sketch", k).alias(f"{name}_sketch") for name in SKETCHED)
    )


def quantile_of(sketch: Column | str, fraction: float) -> Column:
    """The value whose rank is the fraction of all; one of the values, not between two. Null for
    an empty sketch."""
    filled = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(filled, F.kll_sketch_get_quantile_double(sketch, F.lit(float(fraction))))


def with_quantiles(states: DataFrame, fractions: dict[str, dict[str, float]]) -> DataFrame:
    """Quantile columns ``qty_p50`` and so on next to the keys, from ``fractions`` by value name."""
    found = [
        quantile_of(f"{name}_sketch", point).alias(f"{name}_{label}")
        for name, points in fractions.items()
        for label, point in points.items()
    ]
    rest = [name for name in states.columns if not name.endswith("_sketch")]
    return states.select(*rest, *found)
