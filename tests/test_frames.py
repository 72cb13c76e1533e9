import logging
from datetime import date

import pytest

from tickloom.functions.clock import day_ms
from tickloom.sources import frames
from tickloom.sources.lake import load_files


def test_concat_keeps_order(spark):
    a = spark.createDataFrame([(1, 3), (2, 4)], "a bigint, b bigint")
    b = spark.createDataFrame([(5, 7), (6, 8)], "a bigint, b bigint")
    assert [row.a for row in frames.concat([a, b]).collect()] == [1, 2, 5, 6]


def test_concat_strict_refuses_other_columns(spark):
    a = spark.createDataFrame([(1, 3)], "a bigint, b bigint")
    for schema in ("a bigint, c bigint", "a bigint, b double", "b bigint, a bigint"):
        b = spark.createDataFrame([], schema)
        with pytest.raises(frames.SchemaMismatch):
            frames.concat([a, b], "strict")


def test_concat_merge_fills_with_null(spark):
    a = spark.createDataFrame([(1, 3)], "a bigint, b bigint")
    b = spark.createDataFrame([(5, 7)], "a bigint, c bigint")
    rows = [tuple(row) for row in frames.concat([a, b], "merge").collect()]
    assert rows == [(1, 3, None), (5, None, 7)]


def test_concat_of_nothing_and_unknown_mode(spark):
    with pytest.raises(ValueError):
        frames.concat([])
    with pytest.raises(ValueError):
        frames.concat([spark.range(1)], "loose")


def test_range_keeps_the_middle_day(spark):
    days = [date(2024, 1, 1), date(2024, 1, 15), date(2024, 2, 1)]
    df = spark.createDataFrame([(day_ms(day),) for day in days], "timestamp bigint")
    kept = frames.filter_datetime_range(df, date(2024, 1, 10), date(2024, 1, 20)).collect()
    assert [row.timestamp for row in kept] == [day_ms(days[1])]


def test_range_includes_both_days_and_drops_null(spark):
    first, after = day_ms(date(2024, 1, 10)), day_ms(date(2024, 1, 12))
    values = [first - 1, first, after - 1, after, None]
    df = spark.createDataFrame([(value,) for value in values], "timestamp bigint")
    kept = frames.filter_datetime_range(df, date(2024, 1, 10), date(2024, 1, 11)).collect()
    assert sorted(row.timestamp for row in kept) == [first, after - 1]


def test_sort(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "val bigint")
    assert [row.val for row in frames.sort_by(df, "val").collect()] == [1, 2, 3]


def test_has_column(spark):
    df = spark.range(1)
    assert frames.has_column(df, "id")
    assert not frames.has_column(df, "z")


def test_files_without_timestamp_come_back_whole(spark, tmp_path, caplog):
    path = str(tmp_path / "foreign")
    rows = [(10 * month + n, 2024, month) for month in (2, 1) for n in range(3)]
    df = spark.createDataFrame(rows, "v bigint, year int, month int").coalesce(1)
    df.write.partitionBy("year", "month").parquet(path)
    with caplog.at_level(logging.WARNING):
        out = load_files(spark, path, date(2024, 1, 1), date(2024, 1, 1))
    assert "timestamp" in caplog.text
    assert [row.v for row in out.collect()] == [10, 11, 12, 20, 21, 22]
    assert "datetime" not in out.columns


def test_files_with_timestamp_are_trimmed(spark, tmp_path):
    path = str(tmp_path / "foreign")
    stamps = [day_ms(date(2024, 1, day)) for day in (3, 1, 2)]
    spark.createDataFrame([(s,) for s in stamps], "timestamp bigint").write.parquet(path)
    out = load_files(spark, path, date(2024, 1, 2), date(2024, 1, 3)).collect()
    assert [row.timestamp for row in out] == [stamps[2], stamps[0]]
    assert str(out[0].datetime) == "2024-01-02 00:00:00"
