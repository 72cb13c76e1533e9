"""ohlcv and flow bars from a stream of trades.

Tumbling windows on the chosen clock with a watermark: a bar is emitted once the
watermark passes its end, trades later than the delay may be dropped. State is one row
per open bar; partial sums are built before the shuffle, so a busy symbol is no problem.
Lag-based datasets need ordered rows and stay batch.
"""

from __future__ import annotations

import time
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.catalogue import SERIES, SIZE_CLASSES
from tickloom.functions.clock import interval_ms, ntz_from_ms, ts_column
from tickloom.functions.expr import first_by, last_by, order_key, sum_if, taker_buy
from tickloom.operators.slices import finish
from tickloom.operators.trade_bars import SIZE_LIMITS, _size_class, flow_columns, ohlcv_columns
from tickloom.sources.lake import month_span, scan_months, write_lake


def _windowed(trades: DataFrame, interval: str, ts_kind: str, delay: str):
    # Watermarks need TIMESTAMP; from milliseconds it is an instant in any session zone.
    clock = F.col(ts_column(ts_kind))
    timed = trades.withColumns({"event_time": F.timestamp_millis(clock), "ts": clock})
    length = f"{interval_ms(interval)} milliseconds"
    return timed.withWatermark("event_time", delay).groupBy(
        *SERIES, F.window("event_time", length).alias("span")
    )


def _bars(df: DataFrame) -> DataFrame:
    return df.withColumn("bar", F.unix_millis(F.col("span.start"))).drop("span")


def _ohlcv_sums(interval: str) -> list[Column]:
    order = order_key(F.col("ts"), F.col("trade_id"), interval_ms(interval))
    return [
        first_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        last_by("price", order).alias("close"),
        F.sum("qty").alias("volume"),
    ]


def _flow_sums(limits: tuple[float, float]) -> list[Column]:
    buy, qty = taker_buy(F.col("side")), F.col("qty")
    every = {"": F.lit(True)} | {f"_{name}": c for name, c in _size_class(limits).items()}
    sums = []
    for suffix, inside in every.items():
        for side, on in (("buy", buy & inside), ("sell", ~buy & inside)):
            sums.append(sum_if(on, qty).alias(f"{side}_volume{suffix}"))
            sums.append(F.count_if(on).alias(f"{side}_count{suffix}"))
    return sums


def stream_ohlcv(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    delay: str = "1 hour",
) -> DataFrame:
    bars = _windowed(trades, interval, ts_kind, delay).agg(*_ohlcv_sums(interval))
    return finish(_bars(bars), *ohlcv_columns())


def stream_flow(
    trades: DataFrame,
    interval: str,
    ts_kind: str = "exchange",
    *,
    delay: str = "1 hour",
    limits: tuple[float, float] = SIZE_LIMITS,
) -> DataFrame:
    bars = _windowed(trades, interval, ts_kind, delay).agg(*_flow_sums(limits))
    return finish(_bars(bars), *flow_columns())


_FIRST, _LAST = F.min_by, F.max_by
#: How columns of a coarser bar come from finer ones; ``at`` orders the finer bars.
_STREAM_MERGES = {
    "ohlcv": {"open": _FIRST, "high": F.max, "low": F.min, "close": _LAST, "volume": F.sum},
    "flow": dict.fromkeys(
        (
            f"{side}_{kind}{size}"
            for size in ("", *(f"_{name}" for name in SIZE_CLASSES))
            for kind in ("volume", "count")
            for side in ("buy", "sell")
        ),
        F.sum,
    ),
}


def stream_resample(
    trades: DataFrame,
    dataset: str,
    fine: str,
    interval: str,
    ts_kind: str = "exchange",
    *,
    delay: str = "1 hour",
    limits: tuple[float, float] = SIZE_LIMITS,
) -> DataFrame:
    """``ohlcv`` or ``flow`` bars at ``interval`` from the stream's own ``fine`` bars.

    Two watermarked aggregates in one query: trades to fine bars, and closed fine bars to
    coarse ones. Both use the one watermark of the trades, so a coarse bar is emitted once it
    passes that bar's end, as with ``stream_ohlcv``. State is one row per open bar of either
    size; a coarse bar takes one row per fine bar, not per trade.
    """
    if dataset not in _STREAM_MERGES:
        raise ValueError(f"{dataset!r} has no streaming merge; ohlcv or flow")
    if interval_ms(interval) % interval_ms(fine) or interval_ms(interval) <= interval_ms(fine):
        raise ValueError(f"{interval} bars do not consist of {fine} bars")
    sums = _ohlcv_sums(fine) if dataset == "ohlcv" else _flow_sums(limits)
    bars = _windowed(trades, fine, ts_kind, delay).agg(*sums)
    bars = bars.withColumn("at", F.unix_millis(F.col("span.start")))
    length = f"{interval_ms(interval)} milliseconds"
    coarse = bars.groupBy(*SERIES, F.window(F.window_time("span"), length).alias("span")).agg(
        *(
            (how(name, "at") if how in (_FIRST, _LAST) else how(name)).alias(name)
            for name, how in _STREAM_MERGES[dataset].items()
        )
    )
    columns = ohlcv_columns() if dataset == "ohlcv" else flow_columns()
    return finish(_bars(coarse), *columns)


def _triggered(writer, trigger: dict | None):
    return writer.trigger(**({"availableNow": True} if trigger is None else trigger))


def write_stream(bars: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append closed bars as Parquet. The checkpoint makes a restart exact.

    ``trigger`` holds arguments of ``DataStreamWriter.trigger``; all available data and then
    stop unless given.
    """
    writer = (
        bars.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


def stream_to_lake(
    bars: DataFrame,
    root: str,
    dataset: str,
    interval: str,
    ts_kind: str,
    checkpoint: str,
    trigger: dict | None = None,
):
    """Write closed bars into the lake that ``load`` reads.

    Each batch is a delta, so no month is read or rewritten; ``lake.compact`` folds them in. A
    batch that runs again after a failure replaces its own delta. Names begin with the time the
    stream was started here, so a restarted stream comes after what was written before.
    """
    started = f"{time.time_ns():020d}"

    def store(batch: DataFrame, number: int) -> None:
        write_lake(
            batch, root, dataset, interval, ts_kind, delta=True,
            load_name=f"{started}-batch{number:09d}",
        )

    writer = (
        bars.writeStream.outputMode("append")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, trigger).start()


def close_open_bars(
    bars: DataFrame, root: str, dataset: str, interval: str, ts_kind: str
) -> str:
    """Write the bars that a stopped stream left open behind its watermark.

    ``bars`` are the batch form over the same trades. Bars in the lake stay as the stream
    emitted them; only those it has not closed are added. Of the lake only keys are read, in the
    months between the first and the last of ``bars``.
    """
    stamp = ntz_from_ms(F.col("timestamp"))
    dated = bars.withColumns({"year": F.year(stamp), "month": F.month(stamp)})
    months = month_span(dated.select("year", "month"))
    if not months:
        return write_lake(bars, root, dataset, interval, ts_kind, delta=True)
    first, last = (date(year, month, 1) for year, month in (months[0], months[-1]))
    keys = [*SERIES, "timestamp"]
    closed = scan_months(
        bars.sparkSession, root, dataset, ts_kind, interval, None, None, first, last
    )
    bars = bars.join(closed.select(*keys), keys, "left_anti")
    return write_lake(bars, root, dataset, interval, ts_kind, delta=True)
