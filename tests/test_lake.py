import re
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

import tickloom
from tickloom.catalogue import DATASETS, lake_schema
from tickloom.functions.clock import day_ms, next_day_ms
from tickloom.plans.build import write_dataset
from tickloom.plans.endpoints import PreviewRefused
from tickloom.sources import lake, reports
from tickloom.sources.frames import SchemaMismatch

A, B = "perpetual-A-USDT:USDT", "spot-B-USDT"
X = "binance-futures"


def bars_of(spark, rows):
    """ohlcv bars from (symbol, timestamp, close)."""
    data = [(X, symbol, ts, 1.0, 9.0, 0.5, float(close), 7.0) for symbol, ts, close in rows]
    return spark.createDataFrame(
        data,
        "exchange string, symbol string, timestamp bigint, open double, high double, "
        "low double, close double, volume double",
    )


@pytest.fixture
def three_months(spark, root):
    stamps = [day_ms(date(2023, 12, 31)), day_ms(date(2024, 1, 1)), next_day_ms(date(2024, 1, 30)),
              day_ms(date(2024, 2, 1))]
    rows = [(A, ts, i) for i, ts in enumerate(stamps)] + [(B, stamps[1], 10)]
    lake.write_lake(bars_of(spark, rows), root, "ohlcv", "1d", "exchange")
    return root


def load(spark, root, symbol=A, start=date(2024, 1, 1), end=date(2024, 1, 31), **options):
    return lake.load(spark, root, "ohlcv", "exchange", "1d", X, symbol, start, end, **options)


def closes(df):
    return [row.close for row in df.collect()]


def test_range_is_inclusive_and_sorted(spark, three_months):
    df = load(spark, three_months)
    assert closes(df) == [1.0, 2.0]
    row = df.first()
    assert str(row.time) == str(row.datetime) == "2024-01-01 00:00:00"
    assert (row.exchange, row.symbol, row.interval, row.ts_kind) == (X, A, "1d", "exchange")


def test_months_are_joined_in_order(spark, three_months):
    df = load(spark, three_months, start=date(2023, 1, 1), end=date(2024, 12, 31))
    assert closes(df) == [0.0, 1.0, 2.0, 3.0]


def test_day_interval_stays_a_string(spark, three_months):
    # A lake holding only 1d: inference would read the folder name as the number 1.0.
    assert load(spark, three_months).first().interval == "1d"


def test_panel_of_symbols(spark, three_months):
    assert closes(load(spark, three_months, symbol=None)) == [1.0, 10.0, 2.0]
    assert closes(load(spark, three_months, symbol=[B])) == [10.0]
    assert closes(load(spark, three_months, symbol=[A, B])) == [1.0, 10.0, 2.0]


def test_plan_prunes_months_and_pushes_the_range(spark, three_months):
    df = load(spark, three_months, sort=False)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    partition = re.search(r"PartitionFilters: (.*)", plan).group(1)
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "year" in partition and "month" in partition and "symbol" in partition
    assert "GreaterThanOrEqual(timestamp" in pushed and "LessThan(timestamp" in pushed
    assert "Exchange" not in plan
    files = load(spark, three_months, symbol=None).inputFiles()
    assert files and all("month=1/" in name for name in files)


def test_only_requested_columns_are_read(spark, three_months):
    df = load(spark, three_months, sort=False).select("close")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "ReadSchema: struct<timestamp:bigint,close:double>" in plan


def test_no_month_gives_no_rows_but_columns(spark, three_months, root):
    df = load(spark, three_months, start=date(2020, 1, 1), end=date(2020, 2, 1))
    assert closes(df) == [] and "close" in df.columns and "datetime" in df.columns
    missing = load(spark, root + "-missing")
    assert closes(missing) == [] and missing.columns == df.columns
    assert lake.empty_result(spark, "flow").schema == lake_schema("flow")


def test_bad_requests(spark, root):
    with pytest.raises(ValueError, match="after end"):
        load(spark, root, start=date(2024, 3, 1), end=date(2024, 1, 1))
    ok = dict(timestamp="exchange", interval="1d", exchange=X, symbol=A,
              start_date=date(2024, 1, 1), end_date=date(2024, 1, 2))
    for change in ({"exchange": "nowhere"}, {"interval": "2d"}, {"timestamp": "local"},
                   {"output": "polars"}):
        with pytest.raises(ValueError):
            tickloom.get_ohlcv(spark, root, **(ok | change))
    with pytest.raises(ValueError):
        tickloom.get_metrics(spark, root, metric="nothing", **ok)
    with pytest.raises(ValueError):
        load(spark, root, schema_mode="loose")


def test_pandas_output(spark, three_months):
    pdf = load(spark, three_months, output="pandas")
    assert isinstance(pdf, pd.DataFrame)
    assert pdf["time"].is_monotonic_increasing and len(pdf) == 2


def test_rewriting_a_month_leaves_the_others(spark, three_months):
    again = bars_of(spark, [(A, day_ms(date(2024, 2, 1)), 99)])
    lake.write_lake(again, three_months, "ohlcv", "1d", "exchange")
    df = load(spark, three_months, start=date(2023, 1, 1), end=date(2024, 12, 31))
    assert closes(df) == [0.0, 1.0, 2.0, 99.0]


def test_rows_are_sorted_inside_files(spark, root):
    rows = [(A, day_ms(date(2024, 1, 1)) + 1000 * ((i * 37) % 100), i) for i in range(100)]
    bars = bars_of(spark, rows).repartition(7).withColumn("exchange", F.lit(X))
    lake.write_lake(bars, root, "ohlcv", "1s", "exchange")
    stamps = [row.timestamp for row in spark.read.parquet(f"{root}/ohlcv").collect()]
    assert stamps == sorted(stamps) and len(stamps) == 100


def test_bars_without_keys_are_refused(spark, root):
    bars = bars_of(spark, [(None, day_ms(date(2024, 1, 1)), 1)])
    with pytest.raises(Exception, match="without exchange"):
        lake.write_lake(bars, root, "ohlcv", "1s", "exchange")


def _add_file(spark, root, month, columns):
    one = spark.range(1).select(
        F.lit(day_ms(date(2024, month, 5))).alias("timestamp"),
        *(F.lit(value).alias(name) for name, value in columns.items()),
    )
    symbol = A.replace(":", "%3A")
    one.write.mode("append").parquet(
        f"{root}/ohlcv/interval=1d/ts_kind=exchange/exchange={X}/year=2024/month={month}/"
        f"symbol={symbol}"
    )


def test_strict_mode(spark, three_months):
    assert closes(load(spark, three_months, schema_mode="strict")) == [1.0, 2.0]
    _add_file(spark, three_months, 1, {"close": 5.0})
    with pytest.raises(SchemaMismatch):
        load(spark, three_months, schema_mode="strict")
    assert closes(load(spark, three_months)) == [1.0, 5.0, 2.0]


def test_strict_mode_refuses_other_types(spark, three_months):
    _add_file(spark, three_months, 2, {"close": "text"})
    with pytest.raises(SchemaMismatch):
        load(spark, three_months, end=date(2024, 2, 28), schema_mode="strict")


def test_merge_mode_keeps_extra_columns(spark, three_months):
    _add_file(spark, three_months, 1, {"close": 5.0, "extra": 8})
    rows = load(spark, three_months, schema_mode="merge").collect()
    assert [(row.close, row.extra) for row in rows] == [(1.0, None), (5.0, 8), (2.0, None)]
    assert "extra" not in load(spark, three_months).columns


def test_symbols(spark, three_months):
    assert tickloom.get_symbols(spark, three_months, X) == [A, B]
    assert tickloom.get_symbols(spark, three_months, "okx-perps") == []
    names = reports.with_prefix(reports.list_symbols(spark, three_months, X))
    assert [row.symbol for row in names.collect()] == [A]
    with pytest.raises(ValueError):
        tickloom.get_symbols(spark, three_months, "nowhere")
    plan = names._sc._jvm.PythonSQLUtils.explainString(names._jdf.queryExecution(), "formatted")
    assert "ReadSchema: struct<path:string>" in plan  # the content is not read


def test_month_gaps(spark, three_months):
    gaps = reports.month_gaps(
        spark, three_months, "ohlcv", "exchange", "1d", X, date(2023, 12, 9), date(2024, 3, 2)
    )
    found = sorted((row.symbol, row.year, row.month) for row in gaps.collect())
    assert found == [(A, 2024, 3), (B, 2023, 12), (B, 2024, 2), (B, 2024, 3)]


def test_preview(spark, three_months):
    keys = ("ohlcv", X, A, "1d", "exchange", date(2024, 1, 1), date(2024, 1, 31))
    schema = ("dataset string, exchange string, symbol string, interval string, "
              "ts_kind string, start_date date, end_date date")
    allowed = spark.createDataFrame([keys, keys], schema)
    call = dict(timestamp="exchange", interval="1d", exchange=X, symbol=A, preview=allowed)
    df = tickloom.get_ohlcv(
        spark, three_months, start_date=date(2024, 1, 1), end_date=date(2024, 1, 31), **call
    )
    assert closes(df) == [1.0, 2.0]
    for start, end in (
        (date(2023, 3, 5), date(2023, 4, 9)),
        (date(2023, 11, 7), date(2024, 1, 31)),
        (date(2024, 1, 1), date(2024, 1, 30)),
    ):
        with pytest.raises(PreviewRefused):
            tickloom.get_ohlcv(spark, three_months, start_date=start, end_date=end, **call)
    with pytest.raises(PreviewRefused):
        tickloom.get_vwap(
            spark, three_months, start_date=date(2024, 1, 1), end_date=date(2024, 1, 31), **call
        )
    call |= {"start_date": date(2024, 1, 1), "end_date": date(2024, 1, 31)}
    with pytest.raises(PreviewRefused):
        tickloom.get_ohlcv(spark, three_months, **(call | {"symbol": [A, B]}))
    both = allowed.unionByName(allowed.withColumn("symbol", F.lit(B)))
    listed = call | {"symbol": [A, B], "preview": both}
    assert closes(tickloom.get_ohlcv(spark, three_months, **listed)) == [1.0, 10.0, 2.0]
    with pytest.raises(ValueError):
        tickloom.get_ohlcv(spark, three_months, **(call | {"symbol": None}))
    other = (*keys[:3], "5m", *keys[4:])
    requests = spark.createDataFrame([keys, other, keys], schema)
    assert reports.preview_served(requests, allowed).count() == 2
    assert reports.preview_refused(requests, allowed).count() == 1


@pytest.mark.parametrize("dataset", DATASETS)
def test_every_dataset_goes_through_the_lake(spark, small, root, dataset):
    write_dataset(dataset, small, root, "1d")
    call = dict(timestamp="exchange", interval="1d", exchange=X, symbol=None,
                start_date=date(2024, 1, 1), end_date=date(2024, 1, 31))
    df = tickloom.get_metrics(spark, root, metric=dataset, output="pandas", **call)
    assert len(df) > 0
    assert df["time"].is_monotonic_increasing
    assert (df["time"] == df["datetime"]).all()


def test_vwap_and_twap_are_one_dataset(spark, small, root):
    write_dataset("vtwap", small, root, "1d")
    call = dict(timestamp="exchange", interval="1d", exchange=X, symbol=None,
                start_date=date(2024, 1, 1), end_date=date(2024, 1, 31), output="pandas")
    pd.testing.assert_frame_equal(
        tickloom.get_vwap(spark, root, **call), tickloom.get_twap(spark, root, **call)
    )


def test_later_loads_keep_what_is_there(spark, root):
    days = [day_ms(date(2024, 1, d)) for d in range(1, 31)]
    write = lambda rows, **o: lake.write_lake(bars_of(spark, rows), root, "ohlcv", "1d", "exchange", **o)
    write([(A, ts, k) for k, ts in enumerate(days[:15])])
    write([(A, ts, k) for k, ts in enumerate(days[15:], start=15)] + [(B, days[0], 50)])
    assert closes(load(spark, root)) == list(map(float, range(30)))
    write([(A, days[3], 99), (A, day_ms(date(2024, 3, 1)), 7)])  # one bar anew, one month new
    assert closes(load(spark, root)) == [0.0, 1.0, 2.0, 99.0, *map(float, range(4, 30))]
    assert closes(load(spark, root, symbol=B)) == [50.0]
    write([])
    assert load(spark, root).count() == 30
    write([(A, days[0], 5)], replace_months=True)
    assert closes(load(spark, root)) == [5.0]
    assert closes(load(spark, root, symbol=B)) == [50.0]


def test_names_come_from_files_not_bars(spark, root):
    odd = "perpetual-C+D/E USDT:1%"
    rows = [(s, day_ms(date(2024, m, d)), d) for s in (A, odd) for m in (1, 2) for d in range(1, 29)]
    lake.write_lake(bars_of(spark, rows), root, "ohlcv", "1d", "exchange")
    listed = lake.partition_rows(spark, root, "ohlcv", X)
    files = spark.read.parquet(f"{root}/ohlcv").inputFiles()
    assert listed.count() == len(files) < len(rows)
    assert {r.symbol for r in reports.list_symbols(spark, root, X).collect()} == {A, odd}
    assert {(r.interval, r.year, r.month) for r in listed.collect()} == {("1d", 2024, 1), ("1d", 2024, 2)}


def test_last_values(spark):
    bars = bars_of(spark, [(A, 1, 3), (A, 2, 4), (B, 9, 5)])
    found = {r.symbol: r.value for r in reports.last_values(bars, "close", before=9).collect()}
    assert found == {A: 4.0}
