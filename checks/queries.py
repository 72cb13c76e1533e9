"""Registered queries: every operator run over the whole ``events`` table."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.settings import (
    FINE_DATASETS,
    FINE_INTERVALS,
    FIRST_DAY,
    GROUPS,
    LAST_DAY,
    LATE_DATASETS,
    LIMITS,
    MEASURED_ROWS,
    PART_CUT,
    SIZED_GROUP,
    SLICE_FROM,
    SLICE_SYMBOL,
    SLICE_TO,
    nudge,
)
from tickloom import get_derivative_metrics, get_metrics, get_ohlcv, get_symbols, get_twap, get_vwap
from tickloom.catalogue import (
    DATASETS,
    DERIVATIVE_METRICS,
    INTERVAL_MS,
    L1_METRICS,
    L2_METRICS,
    TRADE_METRICS,
    metric_columns,
)
from tickloom.functions.clock import DAY_MS, from_epoch_ms, time_bucket
from tickloom.operators.asof import asof_mid
from tickloom.operators.ranges import balance
from tickloom.operators.resample import FROM_STATES, merge_states, resample, vwap_with_volume
from tickloom.operators.sketches import with_quantiles
from tickloom.operators.trade_bars import QUANTILES
from tickloom.plans.build import (
    build,
    measure,
    source_of,
    sources_of,
    write_dataset,
    write_datasets,
)
from tickloom.plans.late import LOOKS_BACK, rebuild
from tickloom.session import shared_folder
from tickloom.sources import frames, lake, market, reports
from tickloom.streaming.bars import (
    close_open_bars,
    stream_flow,
    stream_ohlcv,
    stream_resample,
    stream_to_lake,
    write_stream,
)

EXCHANGE = market.EVENT_EXCHANGE
KEYS = ["exchange", "symbol", "timestamp"]


def rounded(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Values rounded for comparison; ``+ 0.0`` turns a negative zero into zero."""
    kinds = dict(df.dtypes)

    def shown(name: str):
        if kinds[name] != "double":
            return F.col(name)
        digits, amount = nudge(name)
        return (F.round(F.col(name) + F.lit(amount), digits) + F.lit(0.0)).alias(name)

    return df.select(*keys, *map(shown, names))


def _text(name: str, pattern: str = "yyyy-MM-dd HH:mm:ss.SSS"):
    return F.date_format(name, pattern).alias(name)


def tick_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    events = market.read_events(spark, folder)
    return {
        "trades": market.trades(events),
        "quotes": market.quotes(events),
        "book": market.book(events),
        "deriv": market.deriv(events),
    }


# Datasets --------------------------------------------------------------------------


def dataset_bars(spark, folder, *, dataset, interval="4h", ts_kind="exchange"):
    bars = build(dataset, tick_tables(spark, folder), interval, ts_kind, limits=LIMITS)
    return rounded(bars, KEYS, metric_columns(dataset))


def measured(spark, folder, *, dataset):
    """Bars in slices that a measurement of the inputs chose, small enough to be cut."""
    tables = tick_tables(spark, folder)
    names = ("trades", "quotes") if dataset == "slippage" else (source_of(dataset),)
    sizing = {name: measure(tables[name], "4h", max_rows=MEASURED_ROWS) for name in names}
    bars = build(dataset, tables, "4h", limits=LIMITS, sizing=sizing)
    return rounded(bars, KEYS, metric_columns(dataset))


def in_parts(spark, folder, *, dataset):
    """Bars of the ticks before and from a day on; the second part is told what held before."""
    tables = tick_tables(spark, folder)
    cut = F.col("exchange_ts") < PART_CUT
    early = {name: df.where(cut) for name, df in tables.items()}
    late = {name: df.where(~cut) for name, df in tables.items()}
    if dataset == "returns":
        previous = reports.last_values(build("ohlcv", early, "4h"), "close")
    else:
        previous = reports.last_values(build("l1_price", early, "4h"), "mid_price")
    bars = build(dataset, early, "4h").unionByName(
        build(dataset, late, "4h", previous=previous)
    )
    return rounded(bars, KEYS, metric_columns(dataset))


def _written(spark, folder, dataset, interval, ts_kind="exchange") -> str:
    root = shared_folder(spark, "lake")
    tables = tick_tables(spark, folder)
    write_dataset(dataset, tables, root, interval, ts_kind, limits=LIMITS)
    return root


def through_lake(spark, folder, *, call, dataset, metric=None):
    """Daily bars by arrival time, written and fetched with a public entry point."""
    root = _written(spark, folder, dataset, "1d", "true")
    if dataset in ("ohlcv", "vtwap") and metric is None:
        call = partial(call)
    else:
        call = partial(call, metric=metric)
    df = call(
        spark,
        root,
        timestamp="true",
        interval="1d",
        exchange=None,
        symbol=None,
        start_date=FIRST_DAY,
        end_date=LAST_DAY,
    )
    keys = ["exchange", "symbol", "interval", "ts_kind", "timestamp", _text("datetime")]
    return rounded(df, keys, metric_columns(dataset))


def symbols_of(spark, folder):
    root = _written(spark, folder, "ohlcv", "1d")
    names = get_symbols(spark, root, EXCHANGE)
    return reports.list_symbols(spark, root, EXCHANGE).where(F.col("symbol").isin(names))


def shared_pass(spark, folder, *, datasets, sized=False):
    """Datasets of one group, written with one pass and read back side by side."""
    root = shared_folder(spark, "lake")
    tables = tick_tables(spark, folder)
    sizing = {}
    if sized:
        names = {name for dataset in datasets for name in sources_of(dataset)}
        sizing = {name: measure(tables[name], "4h", max_rows=MEASURED_ROWS) for name in names}
    write_datasets(datasets, tables, root, "4h", "exchange", limits=LIMITS, sizing=sizing)
    parts, names = None, []
    for dataset in datasets:
        columns = {name: f"{dataset}_{name}" for name in metric_columns(dataset)}
        part = lake.load(
            spark, root, dataset, "exchange", "4h", None, None, FIRST_DAY, LAST_DAY, sort=False
        )
        part = rounded(part, KEYS, list(columns)).withColumnsRenamed(columns)
        names += columns.values()
        parts = part if parts is None else parts.join(part, KEYS)
    return parts.select(*KEYS, *names)


# Lake ------------------------------------------------------------------------------

OHLCV = metric_columns("ohlcv")


def load_dataset(spark, folder):
    root = _written(spark, folder, "ohlcv", "4h")
    df = get_ohlcv(
        spark,
        root,
        timestamp="exchange",
        interval="4h",
        exchange=EXCHANGE,
        symbol=SLICE_SYMBOL,
        start_date=SLICE_FROM,
        end_date=SLICE_TO,
    )
    keys = ["exchange", "symbol", "interval", "ts_kind", "timestamp", _text("time")]
    return rounded(df, [*keys, _text("datetime")], OHLCV)


def month_pruning(spark, folder):
    """Whole months of the range 10 to 20 January: pruned by month, not yet by day."""
    root = _written(spark, folder, "ohlcv", "4h")
    df = lake.scan_months(
        spark, root, "ohlcv", "exchange", "4h", None, None, date(2024, 1, 10),
        date(2024, 1, 20),
    )
    return rounded(df, [*KEYS, "year", "month"], OHLCV)


def read_events(spark, folder):
    df = lake.read_parquet(spark, f"{folder}/events.parquet")
    return df.select("event_id", "user_id", "event_type", "value", "props", _text("ts"))


def _typed(spark, folder):
    events = market.read_events(spark, folder)
    types = ("signup", "error", "view", "purchase", "click")
    return [events.where(F.col("event_type") == name) for name in types]


def concat_strict(spark, folder):
    df = frames.concat(_typed(spark, folder), "strict")
    return df.select("event_id", "event_type", "value")


def concat_merge(spark, folder):
    """All five event types, each with columns of its own."""
    signup, error, view, purchase, click = _typed(spark, folder)
    user = F.col("user_id").cast("double").alias("user_id")
    keys = ("event_id", "event_type")
    return frames.concat(
        [
            signup.select(*keys, "value"),
            error.select(*keys, user),
            view.select(*keys, user, "value"),
            purchase.select(*keys, "props", "value"),
            click.select(*keys, "props"),
        ],
        "merge",
    )


def lake_strict(spark, folder):
    root = _written(spark, folder, "ohlcv", "4h")
    df = lake.load(
        spark, root, "ohlcv", "exchange", "4h", None, None, FIRST_DAY, LAST_DAY,
        schema_mode="strict",
    )
    return rounded(df, KEYS, OHLCV)


def lake_merge(spark, folder):
    """Files of a later load hold one more column; it is null for the others."""
    root = shared_folder(spark, "lake")
    bars = build("ohlcv", tick_tables(spark, folder), "4h")
    path = lake.write_lake(
        bars.where(F.col("timestamp") < PART_CUT), root, "ohlcv", "4h", "exchange"
    )
    late = bars.where(F.col("timestamp") >= PART_CUT)
    late.select(
        "*",
        F.col("timestamp").cast("double").alias("stamp"),
        F.year("time").alias("year"),
        F.month("time").alias("month"),
    ).write.mode("append").partitionBy("exchange", "year", "month", "symbol").parquet(path)
    df = lake.load(
        spark, root, "ohlcv", "exchange", "4h", None, None, FIRST_DAY, LAST_DAY,
        schema_mode="merge",
    )
    return rounded(df, [*KEYS, "stamp"], OHLCV)


def _stamped(spark, folder):
    trades = tick_tables(spark, folder)["trades"]
    return trades.select("trade_id", F.col("exchange_ts").alias("timestamp"))


def epoch_column(spark, folder):
    df = from_epoch_ms(_stamped(spark, folder))
    return df.select("trade_id", "timestamp", _text("datetime"))


def range_filter(spark, folder):
    return frames.filter_datetime_range(
        _stamped(spark, folder), date(2024, 1, 10), date(2024, 1, 20)
    )


def sorted_rows(spark, folder):
    return frames.sort_by(_stamped(spark, folder), "timestamp")


def no_timestamp(spark, folder):
    """Foreign monthly files without ``timestamp``: all rows, in month and file order."""
    path = shared_folder(spark, "foreign")
    events = market.read_events(spark, folder)
    events.select(
        "event_id", "value", F.year("ts").alias("year"), F.month("ts").alias("month")
    ).write.partitionBy("year", "month").parquet(path)
    df = lake.load_files(spark, path, date(2024, 1, 10), date(2024, 1, 20))
    return df.select("event_id", "value", "year", "month")


def empty_months(spark, folder):
    root = _written(spark, folder, "ohlcv", "4h")
    df = lake.load(
        spark, root, "ohlcv", "exchange", "4h", EXCHANGE, None, date(2023, 1, 1), date(2023, 2, 1)
    )
    return df.select(*KEYS, *OHLCV)


def symbol_list(spark, folder):
    root = _written(spark, folder, "ohlcv", "4h")
    return reports.list_symbols(spark, root, EXCHANGE)


def symbol_prefix(spark, folder):
    trades = tick_tables(spark, folder)["trades"]
    return reports.with_prefix(trades).select("trade_id", "symbol")


def preview_fetch(spark, folder):
    """A fetch through the preview check: one listed symbol."""
    root = _written(spark, folder, "ohlcv", "4h")
    request = ("ohlcv", EXCHANGE, SLICE_SYMBOL, "4h", "exchange", SLICE_FROM, SLICE_TO)
    kinds = "dataset string, exchange string, symbol string, interval string, ts_kind string"
    listed = spark.createDataFrame([request], f"{kinds}, start_date date, end_date date")
    df = get_ohlcv(
        spark,
        root,
        timestamp="exchange",
        interval="4h",
        exchange=EXCHANGE,
        symbol=SLICE_SYMBOL,
        start_date=SLICE_FROM,
        end_date=SLICE_TO,
        preview=listed,
    )
    return rounded(df, KEYS, OHLCV)


def preview_requests(spark, folder):
    """One request per event, and the distinct combinations of those of value 60 up."""
    events = market.read_events(spark, folder)
    k = F.get_json_object("props", "$.k").cast("int")
    names = F.array(*map(F.lit, DATASETS))
    intervals = F.array(*map(F.lit, INTERVAL_MS))
    requests = events.select(
        F.col("event_id").alias("request_id"),
        F.element_at(names, k % len(DATASETS) + 1).alias("dataset"),
        F.lit(EXCHANGE).alias("exchange"),
        F.concat(F.lit("perpetual-S"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
        F.element_at(intervals, k % len(INTERVAL_MS) + 1).alias("interval"),
        F.when(k % 2 == 0, "exchange").otherwise("true").alias("ts_kind"),
        F.trunc(F.col("ts").cast("date"), "week").alias("start_date"),
        F.date_add(F.trunc(F.col("ts").cast("date"), "week"), 7).alias("end_date"),
        "value",
    )
    whitelist = requests.where(F.col("value") >= 60).select(*reports.PREVIEW_KEYS).distinct()
    return requests.drop("value"), whitelist


def _requests_out(df):
    return df.select(
        "request_id",
        "dataset",
        "symbol",
        "interval",
        "ts_kind",
        _text("start_date", "yyyy-MM-dd"),
        _text("end_date", "yyyy-MM-dd"),
    )


def preview_served(spark, folder):
    return _requests_out(reports.preview_served(*preview_requests(spark, folder)))


def preview_refused(spark, folder):
    return _requests_out(reports.preview_refused(*preview_requests(spark, folder)))


def month_gaps(spark, folder):
    root = _written(spark, folder, "ohlcv", "4h")
    return reports.month_gaps(
        spark, root, "ohlcv", "exchange", "4h", EXCHANGE, date(2023, 12, 15), date(2024, 2, 10)
    )


def panel(spark, folder):
    root = _written(spark, folder, "ohlcv", "4h")
    df = lake.load(
        spark, root, "ohlcv", "exchange", "4h", None, None, date(2024, 1, 3), date(2024, 3, 10)
    )
    return rounded(df, KEYS, OHLCV)


def lake_in_parts(spark, folder):
    """Bars written in two loads that share a month, the second with some bars again."""
    root = shared_folder(spark, "lake")
    bars = build("ohlcv", tick_tables(spark, folder), "4h")
    day = 86_400_000
    stale = bars.withColumn("volume", F.lit(-1.0))
    for part in (
        bars.where(F.col("timestamp") < PART_CUT - day).unionByName(
            stale.where(F.col("timestamp").between(PART_CUT - day, PART_CUT))
        ),
        bars.where(F.col("timestamp") >= PART_CUT - day),
    ):
        lake.write_lake(part, root, "ohlcv", "4h", "exchange")
    df = spark.read.parquet(f"{root}/ohlcv")
    keys = ["exchange", "symbol", "interval", "ts_kind", "year", "month", "timestamp"]
    return rounded(df, [*keys, _text("time")], OHLCV)


def lake_deltas(spark, folder, *, compacted):
    """A month load, then deltas: half of the bars stale, then all bars from a day on."""
    root = shared_folder(spark, "lake")
    bars = build("ohlcv", tick_tables(spark, folder), "4h")
    target = (root, "ohlcv", "4h", "exchange")
    lake.write_lake(bars.where(F.col("timestamp") < PART_CUT), *target)
    stale = bars.withColumn("volume", F.lit(-1.0))
    early = F.col("timestamp") < PART_CUT - DAY_MS
    lake.write_lake(stale.where(~early), *target, delta=True)
    lake.write_lake(bars.where(~early), *target, delta=True)
    if compacted:
        lake.compact(spark, *target)
    df = lake.load(
        spark, root, "ohlcv", "exchange", "4h", None, None, FIRST_DAY, LAST_DAY, sort=False
    )
    return rounded(df, KEYS, OHLCV)


def late_ticks(spark, folder, *, dataset):
    """Bars of most ticks first; the rest come late, in no order of time, in two loads."""
    root, tables = shared_folder(spark, "lake"), tick_tables(spark, folder)
    target = (root, "4h", "exchange")
    ids = {"trades": "trade_id", "quotes": "quote_id"}
    turn = {name: F.pmod(F.col(id_), F.lit(50)) for name, id_ in ids.items()}
    parts = [lambda n: turn[n] > 1, lambda n: turn[n] == 1, lambda n: turn[n] == 0]
    loaded = {name: tables[name].where(parts[0](name)) for name in sources_of(dataset)}
    for first in (*LOOKS_BACK.get(dataset, ())[:1], dataset):
        write_dataset(first, loaded, root, "4h", limits=LIMITS)
    for part in parts[1:]:
        late = {name: tables[name].where(part(name)) for name in loaded}
        loaded = {name: df.unionByName(late[name]) for name, df in loaded.items()}
        rebuild(dataset, loaded, late, *target, limits=LIMITS)
    df = lake.load(
        spark, root, dataset, "exchange", "4h", None, None, FIRST_DAY, LAST_DAY, sort=False
    )
    return rounded(df, KEYS, metric_columns(dataset))


def lake_files(spark, folder):
    root = _written(spark, folder, "ohlcv", "4h")
    df = spark.read.parquet(f"{root}/ohlcv")
    keys = ["exchange", "symbol", "interval", "ts_kind", "year", "month", "timestamp"]
    return rounded(df, [*keys, _text("time")], OHLCV)


# As-of, buckets, resampling, streaming ------------------------------------------------


def time_buckets(spark, folder):
    """Trades per bar for all eight intervals, one map-side combined aggregate each."""
    trades = tick_tables(spark, folder)["trades"]
    found = None
    for name, width in INTERVAL_MS.items():
        bar = time_bucket(F.col("exchange_ts"), width)
        counts = (
            trades.groupBy(*KEYS[:2], bar.alias("timestamp"))
            .agg(F.count(F.lit(1)).alias("trades"))
            .withColumn("interval", F.lit(name))
        )
        found = counts if found is None else found.unionByName(counts)
    return found


def daily_bucket(spark, folder):
    trades = tick_tables(spark, folder)["trades"]
    bar = time_bucket(F.col("true_ts"), DAY_MS)
    return trades.select("trade_id", bar.alias("timestamp"))


def asof(spark, folder, *, ts_kind="exchange", **options):
    tables = tick_tables(spark, folder)
    df = asof_mid(tables["trades"], tables["quotes"], ts_kind, **options)
    return rounded(df, ["trade_id", "exchange", "symbol"], ["price", "mid"])


def balanced_asof(spark, folder, *, ts_kind="exchange"):
    """As-of join over blocks that are cut where more than a few rows lie."""
    tables = tick_tables(spark, folder)
    ticks = [tables["trades"], tables["quotes"]]
    cuts = balance(ticks, ts_kind, DAY_MS, target_rows=MEASURED_ROWS)
    df = asof_mid(*ticks, ts_kind, cuts=cuts)
    return rounded(df, ["trade_id", "exchange", "symbol"], ["price", "mid"])


def balanced_slippage(spark, folder):
    tables = tick_tables(spark, folder)
    cuts = balance([tables["trades"], tables["quotes"]], width_ms=DAY_MS, target_rows=MEASURED_ROWS)
    bars = build("slippage", tables, "4h", cuts=cuts)
    return rounded(bars, KEYS, metric_columns("slippage"))


def resampled(spark, folder, *, dataset):
    tables = tick_tables(spark, folder)
    fine = build(dataset, tables, "4h", limits=LIMITS)
    if dataset == "vtwap":
        fine = vwap_with_volume(fine, build("ohlcv", tables, "4h"))
        return rounded(resample(fine, dataset, "1d"), KEYS, ["vwap", "volume"])
    return rounded(resample(fine, dataset, "1d"), KEYS, metric_columns(dataset))


def from_stored_states(spark, folder, *, dataset, interval):
    """1-minute states, written to the lake and merged: to hours, and from hours to days."""
    kind = FROM_STATES[dataset]
    root = _written(spark, folder, kind, "1m")
    states = lake.load(
        spark, root, kind, "exchange", "1m", None, None, FIRST_DAY, LAST_DAY, sort=False
    )
    if interval == "1d":
        states = merge_states(states, kind, "1h")
    return rounded(resample(states, dataset, interval), KEYS, metric_columns(dataset))


def sketched_quantiles(spark, folder):
    """4-hour sketches through the lake, merged to days. Few trades a day: sketches keep all."""
    root = _written(spark, folder, "sketch_state", "4h")
    states = lake.load(
        spark, root, "sketch_state", "exchange", "4h", None, None, FIRST_DAY, LAST_DAY, sort=False
    )
    days = with_quantiles(merge_states(states, "sketch_state", "1d"), QUANTILES)
    names = [f"{value}_{name}" for value, points in QUANTILES.items() for name in points]
    return rounded(days, KEYS, names)


def _event_stream(spark, folder):
    # As a glob, so that a single file and a folder of files both work.
    return spark.readStream.schema(market.read_events(spark, folder).schema).parquet(
        f"{folder}/{{events.parquet}}"
    )


def streamed_to_lake(spark, folder, *, dataset):
    """A stream into the lake, its tail closed by the batch form: every bar is there."""
    root, trades = shared_folder(spark, "lake"), market.trades(_event_stream(spark, folder))
    options = {"interval": "4h", "delay": "30 minutes"}
    if dataset == "flow":
        bars = stream_flow(trades, limits=LIMITS, **options)
    else:
        bars = stream_ohlcv(trades, **options)
    target = (root, dataset, "4h", "exchange")
    stream_to_lake(bars, *target, shared_folder(spark, "state")).awaitTermination()
    close_open_bars(build(dataset, tick_tables(spark, folder), "4h", limits=LIMITS), *target)
    df = lake.load(
        spark, root, dataset, "exchange", "4h", None, None, FIRST_DAY, LAST_DAY, sort=False
    )
    return rounded(df, KEYS, metric_columns(dataset))


def streamed(spark, folder, *, dataset, ts_kind="exchange", fine=None):
    """Closed bars of a stream over the events file, with a 30-minute watermark.

    ``fine``: made from the stream's own bars of that interval."""
    source = _event_stream(spark, folder)
    options = {"interval": "4h", "ts_kind": ts_kind, "delay": "30 minutes"}
    if fine is not None:
        bars = stream_resample(market.trades(source), dataset, fine, limits=LIMITS, **options)
    elif dataset == "flow":
        bars = stream_flow(market.trades(source), limits=LIMITS, **options)
    else:
        bars = stream_ohlcv(market.trades(source), **options)
    out = shared_folder(spark, "stream")
    write_stream(bars, f"{out}/bars", f"{out}/state").awaitTermination()
    df = spark.read.schema(bars.schema).parquet(f"{out}/bars")
    return rounded(df, KEYS, metric_columns(dataset))


def registry():
    found = {
        "L1_load_dataset": load_dataset,
        "L2_month_pruning": month_pruning,
        "L2b_read_parquet": read_events,
        "L3_concat_strict": concat_strict,
        "L3_concat_merge": concat_merge,
        "L3_lake_strict": lake_strict,
        "L3_lake_merge": lake_merge,
        "L4_from_epoch_ms": epoch_column,
        "L5_filter_datetime_range": range_filter,
        "L6_sort_by": sorted_rows,
        "L7_has_column": no_timestamp,
        "L8_empty_result": empty_months,
        "L9_list_symbols": symbol_list,
        "L10_symbol_prefix": symbol_prefix,
        "L11_preview_served": preview_served,
        "L11_preview_refused": preview_refused,
        "L12_month_gaps": month_gaps,
        "L13_panel": panel,
        "L14_write_lake": lake_files,
        "L14_write_in_parts": lake_in_parts,
        "L14_load_deltas": partial(lake_deltas, compacted=False),
        "L14_compacted_deltas": partial(lake_deltas, compacted=True),
        "L11_preview_fetch": preview_fetch,
        "B9_returns_in_parts": partial(in_parts, dataset="returns"),
        "B10_slippage_in_parts": partial(in_parts, dataset="slippage"),
        "get_ohlcv": partial(through_lake, call=get_ohlcv, dataset="ohlcv"),
        "get_vwap": partial(through_lake, call=get_vwap, dataset="vtwap"),
        "get_twap": partial(through_lake, call=get_twap, dataset="vtwap"),
        "get_symbols": symbols_of,
        "X1_time_bucket": time_buckets,
        "X1_time_bucket_true": daily_bucket,
        "X2_asof_join": asof,
        "X2_asof_join_true": partial(asof, ts_kind="true"),
        "X2_asof_balanced_true": partial(balanced_asof, ts_kind="true"),
        "X2b_asof_day_seeded": balanced_asof,
        "B10_slippage_balanced": balanced_slippage,
        "X3_resample_ohlcv": partial(resampled, dataset="ohlcv"),
        "X3_resample_vwap": partial(resampled, dataset="vtwap"),
        "X3_resample_flow": partial(resampled, dataset="flow"),
        "X3_resample_open_interest": partial(resampled, dataset="open_interest"),
        "X3_sketch_quantiles": sketched_quantiles,
        "X4_stream_ohlcv": partial(streamed, dataset="ohlcv"),
        "X4_stream_ohlcv_true": partial(streamed, dataset="ohlcv", ts_kind="true"),
        "X4_stream_flow": partial(streamed, dataset="flow"),
        "X4_stream_resample_ohlcv": partial(streamed, dataset="ohlcv", fine="1m"),
        "X4_stream_resample_flow": partial(streamed, dataset="flow", ts_kind="true", fine="1h"),
        "X4_stream_to_lake_ohlcv": partial(streamed_to_lake, dataset="ohlcv"),
        "X4_stream_to_lake_flow": partial(streamed_to_lake, dataset="flow"),
        **{
            f"L14_write_datasets_{name}": partial(shared_pass, datasets=datasets)
            for name, datasets in GROUPS.items()
        },
        "L14_write_datasets_sized": partial(shared_pass, datasets=SIZED_GROUP, sized=True),
    }
    for number, dataset in enumerate(DATASETS, start=1):
        found[f"B{number}_{dataset}"] = partial(dataset_bars, dataset=dataset)
        found[f"measured_{dataset}"] = partial(measured, dataset=dataset)
    for dataset in LATE_DATASETS:
        found[f"L14_late_{dataset}"] = partial(late_ticks, dataset=dataset)
    for dataset in FROM_STATES:
        for interval in ("1h", "1d"):
            found[f"X3_states_{dataset}_{interval}"] = partial(
                from_stored_states, dataset=dataset, interval=interval
            )
    for interval in FINE_INTERVALS:
        for dataset in FINE_DATASETS:
            found[f"{dataset}_{interval}"] = partial(dataset_bars, dataset=dataset, interval=interval)
    for metric in (*TRADE_METRICS, *L1_METRICS, *L2_METRICS):
        found[f"get_metrics_{metric}"] = partial(
            through_lake, call=get_metrics, dataset=metric, metric=metric
        )
    for metric in DERIVATIVE_METRICS:
        found[f"get_derivative_metrics_{metric}"] = partial(
            through_lake, call=get_derivative_metrics, dataset=metric, metric=metric
        )
    return found
