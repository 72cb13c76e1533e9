"""Late ticks: which stored bars they change, and a rebuild of those bars alone.

A tick changes the bar it falls into. Two datasets look back further, so later bars change too:
``returns`` up to the next bar that ends with a price, ``slippage`` up to the next bar that holds
a valid quote. What those bars look back at comes from a state table in the lake: the path
state (last price of a bar) and the mid state (last mid of a bar), which are brought up to date
first. Ticks are read for the bars that change, within their span of time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.catalogue import BAR, SERIES, metric_columns
from tickloom.functions.clock import interval_ms, time_bucket, ts_column
from tickloom.operators.resample import from_states
from tickloom.operators.slices import carry_last
from tickloom.plans.build import build, sources_of
from tickloom.session import shared_folder
from tickloom.sources.lake import EARLIEST, LATEST, scan_months, write_lake

#: State table and its value at the end of a bar, by dataset that looks back at it.
LOOKS_BACK = {"returns": ("path_state", "last_price"), "slippage": ("mid_state", "last_mid")}


def touched_bars(late: DataFrame, interval: str, ts_kind: str = "exchange") -> DataFrame:
    """exchange, symbol, bar of the bars that ticks fall into."""
    ts = F.col(ts_column(ts_kind))
    known = ts.isNotNull()
    for name in SERIES:
        known = known & F.col(name).isNotNull()
    bar = time_bucket(ts, interval_ms(interval)).alias("bar")
    return late.where(known).select(*SERIES, bar).distinct()


def followers(touched: DataFrame, index: DataFrame, interval: str) -> DataFrame:
    """Bars of ``index`` (exchange, symbol, bar, value) that look back at a touched bar: those
    behind it up to and including the next one with a value of its own."""
    marked = index.groupBy(*BAR).agg(F.max(F.col("value").isNotNull()).alias("ends"))
    marked = marked.join(touched.withColumn("hit", F.lit(True)), list(BAR), "full")
    mark = F.when(F.col("hit"), 1).when(F.col("ends"), 0)
    marked = marked.withColumn("mark", mark)
    found = carry_last(marked, "mark", "bar", interval_ms(interval), "before")
    return found.where((F.col("before") == 1) & F.col("hit").isNull()).select(*BAR)


def ticks_of(ticks: DataFrame, bars: DataFrame, interval: str, ts_kind: str) -> DataFrame:
    """The ticks inside ``bars`` (exchange, symbol, bar). Their span is a plain filter on the
    clock, which reaches the reader."""
    span = bars.agg(F.min("bar").alias("first"), F.max("bar").alias("last")).first()
    ts = F.col(ts_column(ts_kind))
    if span.first is None:
        return ticks.where(F.lit(False))
    width = interval_ms(interval)
    inside = ticks.where((ts >= span.first) & (ts < span.last + width))
    keyed = inside.withColumn("bar", time_bucket(ts, width))
    return keyed.join(bars, list(BAR), "left_semi").select(ticks.columns)


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    spark, path = df.sparkSession, shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stored(spark, root, dataset, interval, ts_kind) -> DataFrame:
    rows = scan_months(spark, root, dataset, ts_kind, interval, None, None, EARLIEST, LATEST)
    return rows.withColumn("bar", F.col("timestamp"))


def changed_bars(
    dataset: str,
    late: dict[str, DataFrame],
    root: str,
    interval: str,
    ts_kind: str = "exchange",
) -> DataFrame:
    """exchange, symbol, bar of the bars of ``dataset`` that the late ticks change.

    ``late`` holds late ticks by input name; inputs without any may be missing. For datasets
    that look back, the lake holds their state table with the late ticks already in it.
    """
    names = [name for name in sources_of(dataset) if name in late]
    if not names:
        raise ValueError(f"no late ticks for {dataset}; it takes {', '.join(sources_of(dataset))}")
    touched = {name: touched_bars(late[name], interval, ts_kind) for name in names}
    every = reduce(DataFrame.unionByName, touched.values()).distinct()
    # Late trades don't move a mid, so only late quotes reach further.
    looked = touched.get("quotes") if dataset == "slippage" else touched.get("trades")
    if dataset not in LOOKS_BACK or looked is None:
        return every
    spark = every.sparkSession
    state, column = LOOKS_BACK[dataset]
    index = _stored(spark, root, state, interval, ts_kind).select(*BAR, F.col(column).alias("value"))
    if dataset == "slippage":
        bars = _stored(spark, root, dataset, interval, ts_kind)
        nothing = F.lit(None).cast("double").alias("value")
        index = index.unionByName(bars.select(*BAR, nothing))
        index = index.unionByName(every.select(*BAR, nothing))
    return every.unionByName(followers(looked, index, interval)).distinct()


def _slippage(inputs, bars, root, interval, ts_kind, **options) -> DataFrame:
    """Slippage of ``bars``: their ticks, and a quote just before each of them that says what
    mid held there."""
    spark = bars.sparkSession
    mids = _stored(spark, root, "mid_state", interval, ts_kind).select(*BAR, "last_mid")
    steps = mids.unionByName(bars.select(*BAR, F.lit(None).cast("double").alias("last_mid")))
    steps = steps.groupBy(*BAR).agg(F.max("last_mid").alias("last_mid"))
    held = carry_last(steps, "last_mid", "bar", interval_ms(interval), "mid")
    held = held.join(bars, list(BAR), "left_semi").where(F.col("mid").isNotNull())
    at, null = F.col("bar") - 1, F.lit(None)
    quotes = inputs["quotes"]
    before = held.select(
        null.cast("bigint").alias("quote_id"),
        *SERIES,
        at.alias("exchange_ts"),
        at.alias("true_ts"),
        F.col("mid").alias("bid_price"),
        F.col("mid").alias("ask_price"),
        null.cast("double").alias("bid_size"),
        null.cast("double").alias("ask_size"),
    )
    inside = ticks_of(quotes, bars, interval, ts_kind).select(before.columns)
    tables = {
        "trades": ticks_of(inputs["trades"], bars, interval, ts_kind),
        "quotes": inside.unionByName(before),
    }
    return build("slippage", tables, interval, ts_kind, **options)


def rebuild(
    dataset: str,
    inputs: dict[str, DataFrame],
    late: dict[str, DataFrame],
    root: str,
    interval: str,
    ts_kind: str = "exchange",
    **options,
) -> DataFrame:
    """Bring the stored bars of ``dataset`` up to date and return which bars were rebuilt.

    ``inputs`` hold all ticks by name, the late ones among them; ``late`` holds the late ones
    alone. The bars are written as a delta. A state table that the dataset looks back at is
    brought up to date first and has to be in the lake for what was loaded before. Late ticks of
    one bar may come in any order and in several loads; the same late ticks again change
    nothing. ``options`` are those of ``build``. No late tick gives no bar.
    """
    state = LOOKS_BACK.get(dataset, (None,))[0]
    if state is not None and any(name in late for name in sources_of(state)):
        rebuild(state, inputs, late, root, interval, ts_kind)
    bars = _kept(changed_bars(dataset, late, root, interval, ts_kind), "changed")
    if dataset == "returns":
        states = _stored(bars.sparkSession, root, "path_state", interval, ts_kind)
        states = states.join(bars.select(*SERIES).distinct(), list(SERIES), "left_semi")
        found = from_states(states.drop("bar"), dataset, interval)
        found = found.withColumn("bar", F.col("timestamp")).join(bars, list(BAR), "left_semi")
    elif dataset == "slippage":
        found = _slippage(inputs, bars, root, interval, ts_kind, **options)
    else:
        tables = {n: ticks_of(inputs[n], bars, interval, ts_kind) for n in sources_of(dataset)}
        found = build(dataset, tables, interval, ts_kind, **options)
    write_lake(
        found.select(*SERIES, "timestamp", *metric_columns(dataset)),
        root, dataset, interval, ts_kind, delta=True,
    )
    return bars

