"""Public entry points: one call per kind of dataset, all thin forms of ``load``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources import lake, reports


class PreviewRefused(PermissionError):
    """The request is not in the preview whitelist."""


def _check_preview(preview, dataset, exchange, symbol, *rest) -> None:
    """Every named symbol must be listed with all the other parameters."""
    symbols = [symbol] if isinstance(symbol, str) else list(symbol or [])
    if not symbols or not isinstance(exchange, str):
        raise ValueError("a preview needs one exchange and the symbols by name")
    for name in dict.fromkeys(symbols):
        values = (dataset, exchange, name, *rest)
        request = dict(zip(reports.PREVIEW_KEYS, values, strict=True))
        match = F.lit(True)
        for key, value in request.items():
            match = match & (F.col(key) == F.lit(value))
        if preview.where(match).isEmpty():
            raise PreviewRefused(f"no preview of {request}")


def _fetch(
    spark, root, dataset, timestamp, interval, exchange, symbol, start_date, end_date, preview,
    **options,
):
    lake.check_request(dataset, timestamp, interval, exchange, start_date, end_date)
    if preview is not None:
        _check_preview(
            preview, dataset, exchange, symbol, interval, timestamp, start_date, end_date
        )
    return lake.load(
        spark, root, dataset, timestamp, interval, exchange, symbol, start_date, end_date,
        **options,
    )


def get_ohlcv(
    spark: SparkSession,
    root: str,
    *,
    timestamp: str,
    interval: str,
    exchange: str,
    symbol,
    start_date: date,
    end_date: date,
    preview: DataFrame | None = None,
    **options,
):
    """Open, high, low, close, volume. ``options`` go to ``load`` (sort, output, ...)."""
    return _fetch(
        spark, root, "ohlcv", timestamp, interval, exchange, symbol, start_date, end_date,
        preview, **options,
    )


def get_vwap(
    spark: SparkSession,
    root: str,
    *,
    timestamp: str,
    interval: str,
    exchange: str,
    symbol,
    start_date: date,
    end_date: date,
    preview: DataFrame | None = None,
    **options,
):
    """The ``vtwap`` dataset, which holds both averages."""
    return _fetch(
        spark, root, "vtwap", timestamp, interval, exchange, symbol, start_date, end_date,
        preview, **options,
    )


get_twap = get_vwap


def get_metrics(
    spark: SparkSession,
    root: str,
    *,
    metric: str,
    timestamp: str,
    interval: str,
    exchange: str,
    symbol,
    start_date: date,
    end_date: date,
    preview: DataFrame | None = None,
    **options,
):
    """Trade, top-of-book and order-book metrics.

    Usual names are those of trades and books; like every call here it takes any name
    in the catalogue.
    """
    return _fetch(
        spark, root, metric, timestamp, interval, exchange, symbol, start_date, end_date,
        preview, **options,
    )


def get_derivative_metrics(
    spark: SparkSession,
    root: str,
    *,
    metric: str,
    timestamp: str,
    interval: str,
    exchange: str,
    symbol,
    start_date: date,
    end_date: date,
    preview: DataFrame | None = None,
    **options,
):
    """Basis, funding, open interest and contract prices."""
    return _fetch(
        spark, root, metric, timestamp, interval, exchange, symbol, start_date, end_date,
        preview, **options,
    )


def get_symbols(spark: SparkSession, root: str, exchange: str) -> list[str]:
    """Symbols of an exchange. A list of names, not of rows, so it fits on the driver."""
    rows = reports.list_symbols(spark, root, exchange).orderBy("symbol")
    return [row.symbol for row in rows.collect()]
