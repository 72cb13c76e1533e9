"""Questions about a lake that need no bar values: symbols, month gaps, preview."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalogue import SERIES, check_exchange
from tickloom.sources.lake import check_request, partition_rows

SYMBOL_DATASET = "ohlcv"
PERPETUAL = "perpetual-"
PREVIEW_KEYS = (
    "dataset",
    "exchange",
    "symbol",
    "interval",
    "ts_kind",
    "start_date",
    "end_date",
)


def list_symbols(spark: SparkSession, root: str, exchange: str) -> DataFrame:
    """Symbols of an exchange, from the folder names of its files."""
    check_exchange(exchange)
    rows = partition_rows(spark, root, SYMBOL_DATASET, exchange)
    return rows.where(F.col("exchange") == exchange).select("symbol").distinct()


def with_prefix(symbols: DataFrame, prefix: str = PERPETUAL) -> DataFrame:
    return symbols.where(F.col("symbol").startswith(prefix))


def month_gaps(
    spark: SparkSession,
    root: str,
    dataset: str,
    timestamp: str,
    interval: str,
    exchange: str,
    start_date: date,
    end_date: date,
) -> DataFrame:
    """Months of the range that a known series has no files for.

    A series is known if it has any file in this dataset, clock and interval.
    """
    check_request(dataset, timestamp, interval, exchange, start_date, end_date)
    rows = partition_rows(spark, root, dataset, exchange, interval, timestamp)
    present = rows.select(*SERIES, "year", "month").distinct()
    first, last = start_date.replace(day=1), end_date.replace(day=1)
    step = F.expr("interval 1 month")
    expected = (
        present.select(*SERIES)
        .distinct()
        .select(*SERIES, F.explode(F.sequence(F.lit(first), F.lit(last), step)).alias("day"))
        .select(*SERIES, F.year("day").alias("year"), F.month("day").alias("month"))
    )
    return expected.join(present, [*SERIES, "year", "month"], "left_anti")


def preview_served(requests: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Requests whose whole parameter combination is in the whitelist."""
    return requests.join(whitelist, list(PREVIEW_KEYS), "left_semi")


def preview_refused(requests: DataFrame, whitelist: DataFrame) -> DataFrame:
    return requests.join(whitelist, list(PREVIEW_KEYS), "left_anti")


def last_values(bars: DataFrame, column: str, before: int | None = None) -> DataFrame:
    """exchange, symbol and the latest non-null ``column`` of each series, as ``value``.

    ``before`` (ms) leaves out later bars. With ``close`` of ohlcv bars it is what ``returns``
    takes as ``previous``, with ``mid_price`` of l1_price bars what ``slippage`` takes.
    """
    rows = bars.where(F.col(column).isNotNull())
    if before is not None:
        rows = rows.where(F.col("timestamp") < before)
    return rows.groupBy(*SERIES).agg(F.max_by(column, "timestamp").alias("value"))
