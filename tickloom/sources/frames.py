"""Steps of a load, as functions of DataFrames: concat, range filter, sort."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import day_ms, from_epoch_ms, next_day_ms

log = logging.getLogger(__name__)
TIMESTAMP = "timestamp"


class SchemaMismatch(ValueError):
    """Monthly files of one load have different columns."""


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in df.schema]


def concat(frames: Sequence[DataFrame], schema_mode: str = "strict") -> DataFrame:
    """Stack frames.

    ``strict``: all must have the same columns and types, in the same order.
    ``merge``: missing columns become null.
    """
    if not frames:
        raise ValueError("nothing to concatenate")
    if schema_mode == "strict":
        for other in frames[1:]:
            if _shape(other) != _shape(frames[0]):
                raise SchemaMismatch(f"{_shape(frames[0])} against {_shape(other)}")
        return reduce(DataFrame.union, frames)
    if schema_mode == "merge":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    raise ValueError(f"unknown schema mode {schema_mode!r}")


def has_column(df: DataFrame, column: str) -> bool:
    return column in df.columns


def filter_datetime_range(
    df: DataFrame, start_date: date, end_date: date, column: str = TIMESTAMP
) -> DataFrame:
    """Keep rows of whole UTC days, both ends included; null times are dropped.

    The test is on the raw milliseconds, so that it reaches the Parquet reader.
    """
    ms = F.col(column)
    return df.where((ms >= F.lit(day_ms(start_date))) & (ms < F.lit(next_day_ms(end_date))))


def sort_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


def trim(
    df: DataFrame, start_date: date, end_date: date, order: Sequence[str] | None = (TIMESTAMP,)
) -> DataFrame:
    """Range filter, ``datetime`` column and sort, where a ``timestamp`` column exists.

    Without one the rows come back whole and unfiltered, in month and file order.
    """
    if not has_column(df, TIMESTAMP):
        log.warning("no %r column: range filter and sort are skipped", TIMESTAMP)
        return _file_order(df) if order else df
    df = from_epoch_ms(filter_datetime_range(df, start_date, end_date), TIMESTAMP)
    return sort_by(df, *order) if order else df


def _file_order(df: DataFrame) -> DataFrame:
    months = [name for name in ("year", "month") if name in df.columns]
    place = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    return df.orderBy(*months, *place)
