"""Small column expressions shared by the bar builders."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, null where the bottom is zero."""
    return top / F.nullif(bottom, F.lit(0.0))


def sum_if(condition: Column, value: Column) -> Column:
    """Sum of ``value`` over matching rows, 0.0 if there are none."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def first_by(value: Column | str, order: Column) -> Column:
    """Value at the lowest order key. Unlike ``first`` it does not depend on row order."""
    return F.min_by(value, order)


def last_by(value: Column | str, order: Column) -> Column:
    return F.max_by(value, order)


def order_key(ts: Column, row_id: Column, width_ms: int) -> Column:
    """Key that orders ticks by time, then id, inside one bar of ``width_ms``.

    Time in the bar and id stand one behind the other in a decimal: a fixed-width buffer,
    so first and last stay in a hash aggregate with map-side sums (a struct key would sort
    all ticks first). Every bigint fits; a null id comes before any other.
    """
    at = F.pmod(ts, F.lit(width_ms)).cast("decimal(9,0)")
    place = row_id.cast("decimal(19,0)") + F.lit(Decimal(2**63 + 1))
    place = F.coalesce(place, F.lit(Decimal(0)))
    return at * F.lit(Decimal(10**20)) + place


def taker_buy(side: Column) -> Column:
    """True for ``buy``, false for ``sell``, null for anything else: it counts for neither."""
    return F.when(side == "buy", True).when(side == "sell", False)
