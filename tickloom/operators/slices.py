"""Splitting of bars into time slices, so that no bar has to fit in one task.

Price changes, holding times and runs never cross a bar edge, so the plain plan is a
window per bar. But one bar (a day of a busy symbol) may hold a large share of all
rows. The builders therefore work on *cells*: slices of a bar in time order. Each cell
is reduced to one row with its partial sums and its first and last tick; the pairs of
ticks that straddle two neighbouring cells are added when those few rows are put
together per bar. The result does not depend on the slice width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.catalogue import BAR, SERIES
from tickloom.functions.clock import interval_ms, ntz_from_ms, time_bucket, ts_column

DEFAULT_SLICE_MS = 900_000
CHUNK_ROWS = 4096


def slice_width(interval: str, slice_ms: int | None) -> int:
    """Slice width in use: a divisor of the interval, at most the interval itself."""
    whole = interval_ms(interval)
    width = min(DEFAULT_SLICE_MS if slice_ms is None else slice_ms, whole)
    if width <= 0 or whole % width:
        raise ValueError(f"slice of {width} ms does not divide {interval}")
    return width


def cell_keys(interval: str, slice_ms: int | None) -> list[str]:
    """Grouping keys of one cell; a bar of one slice is its own cell."""
    whole = slice_width(interval, slice_ms) == interval_ms(interval)
    return list(BAR) if whole else [*BAR, "slice"]


def ticks(
    df: DataFrame,
    id_column: str,
    interval: str,
    ts_kind: str,
    values: dict[str, Column | str],
    slice_ms: int | None = None,
) -> DataFrame:
    """Keys ``exchange, symbol, bar, slice, ts, id`` plus the named value columns.

    A tick without exchange, symbol or clock belongs to no series and is left out.
    """
    ts = F.col(ts_column(ts_kind))
    picked = [
        (F.col(value) if isinstance(value, str) else value).alias(name)
        for name, value in values.items()
    ]
    known = ts.isNotNull()
    for name in SERIES:
        known = known & F.col(name).isNotNull()
    return df.where(known).select(
        *SERIES,
        time_bucket(ts, interval_ms(interval)).alias("bar"),
        time_bucket(ts, slice_width(interval, slice_ms)).alias("slice"),
        ts.alias("ts"),
        F.col(id_column).alias("id"),
        *picked,
    )


def cell_window(cells: list[str], *order: str) -> WindowSpec:
    return Window.partitionBy(*cells).orderBy(*(order or ("ts", "id")))


def edge_window() -> WindowSpec:
    """Cells of one bar in time order."""
    return Window.partitionBy(*BAR).orderBy("first_ts")


def finish(bars: DataFrame, *metrics: Column) -> DataFrame:
    """Bar keys in their public form: ``timestamp`` (bar start, ms) and ``time``."""
    return bars.select(
        *SERIES,
        F.col("bar").alias("timestamp"),
        ntz_from_ms(F.col("bar")).alias("time"),
        *metrics,
    )


def carry_last(
    df: DataFrame,
    value: str,
    order: str,
    width_ms: int,
    name: str,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``name``: the last non-null ``value`` strictly before the row in its series.

    ``df`` has one row per series and step of ``width_ms`` (bars or slices). A window
    per series would put a whole series in one task. Here the look-back runs in chunks
    of ``chunk_rows`` steps. Rows it leaves open all lack the same value, the last one
    before their chunk, so only the first and the last row of each chunk go through a
    second window per series, and a third one hands the first row's value to its chunk.
    """
    chunk = F.floor(F.col(order) / F.lit(width_ms * chunk_rows))
    df = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(*SERIES, "_chunk").orderBy(order)
    df = df.withColumn(
        "_seen",
        F.last(value, ignorenulls=True).over(
            inside.rowsBetween(Window.unboundedPreceding, -1)
        ),
    )
    edge = F.lag(order).over(inside).isNull() | F.lead(order).over(inside).isNull()
    df = df.withColumn("_edge", edge).withColumn(
        "_group", F.when(F.col("_edge"), F.lit(0)).otherwise(F.col("_chunk"))
    )
    across = (
        Window.partitionBy(*SERIES, "_edge", "_group")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    upto = F.coalesce(F.col(value), F.col("_seen"))
    df = df.withColumn("_before", F.last(upto, ignorenulls=True).over(across))
    first = F.first("_before").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(name, F.coalesce(F.col("_seen"), first)).drop(
        "_chunk", "_seen", "_edge", "_group", "_before"
    )


def or_previous(df: DataFrame, name: str, previous: DataFrame | None) -> DataFrame:
    """Fill nulls of ``name`` from ``previous`` (exchange, symbol, value): what held before
    the input began. One row per series; zero and null values count as none."""
    if previous is None:
        return df
    value = F.max(F.nullif("value", F.lit(0.0))).alias("_previous")
    seeds = previous.groupBy(*SERIES).agg(value)
    return (
        df.join(seeds, list(SERIES), "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("_previous")))
        .drop("_previous")
    )
