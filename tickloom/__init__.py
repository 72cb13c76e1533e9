"""Market microstructure bars on Spark."""

from tickloom.plans.endpoints import (
    get_derivative_metrics,
    get_metrics,
    get_ohlcv,
    get_symbols,
    get_twap,
    get_vwap,
)
from tickloom.sources.lake import load, write_lake

__all__ = [
    "get_derivative_metrics",
    "get_metrics",
    "get_ohlcv",
    "get_symbols",
    "get_twap",
    "get_vwap",
    "load",
    "write_lake",
]
