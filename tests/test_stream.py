from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import same
from tickloom.plans.build import build
from tickloom.sources import lake
from tickloom.streaming.bars import (
    close_open_bars,
    stream_flow,
    stream_ohlcv,
    stream_resample,
    stream_to_lake,
    write_stream,
)

HOURS4 = 14_400_000


@pytest.mark.parametrize("make", [stream_ohlcv, stream_flow])
@pytest.mark.parametrize("kind", ["exchange", "true"])
def test_stream_equals_batch_for_closed_bars(spark, small, tmp_path, make, kind):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    small["trades"].repartition(1).write.parquet(source)
    stream = spark.readStream.schema(small["trades"].schema).parquet(source)
    bars = make(stream, "4h", kind, delay="20 minutes")
    write_stream(bars, out, str(tmp_path / "state")).awaitTermination()
    last = small["trades"].agg(F.max(f"{kind}_ts")).first()[0] - 20 * 60_000
    batch = build("ohlcv" if make is stream_ohlcv else "flow", small, "4h", kind)
    closed = batch.where(F.col("timestamp") + HOURS4 <= last)
    assert 0 < closed.count() < batch.count()
    same(spark.read.schema(bars.schema).parquet(out), closed)


def test_restart_continues(spark, small, tmp_path):
    """Two files in two runs with one checkpoint give the bars of one run."""
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    trades = small["trades"]
    middle = trades.agg(F.expr("percentile_approx(exchange_ts, 0.5)")).first()[0]
    run = None
    for part in (trades.where(F.col("exchange_ts") <= middle),
                 trades.where(F.col("exchange_ts") > middle)):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(trades.schema).parquet(source)
        run = stream_ohlcv(stream, "4h", delay="20 minutes")
        write_stream(run, out, state).awaitTermination()
    last = trades.agg(F.max("exchange_ts")).first()[0] - 20 * 60_000
    closed = build("ohlcv", small, "4h").where(F.col("timestamp") + HOURS4 <= last)
    same(spark.read.schema(run.schema).parquet(out), closed)


def test_late_trades_and_the_tail(spark, small, tmp_path):
    """Trades later than the watermark are dropped by the stream; closing adds open bars only."""
    source, root, state = (str(tmp_path / name) for name in ("in", "lake", "state"))
    trades = small["trades"]
    last = trades.agg(F.max("exchange_ts")).first()[0]
    late = trades.where(F.col("exchange_ts") < last - 10 * HOURS4).limit(5)
    target = (root, "ohlcv", "4h", "exchange")
    for part in (trades.exceptAll(late), late):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(trades.schema).parquet(source)
        bars = stream_ohlcv(stream, "4h", delay="20 minutes")
        stream_to_lake(bars, *target, state, {"availableNow": True}).awaitTermination()
    load = lambda: lake.load(spark, root, "ohlcv", "exchange", "4h", None, None, date(2023, 1, 1), date(2025, 1, 1))
    batch = build("ohlcv", {"trades": trades.exceptAll(late)}, "4h")
    end = F.col("timestamp") + HOURS4 <= last - 20 * 60_000
    same(load().select(batch.columns), batch.where(end))
    close_open_bars(batch, *target)
    close_open_bars(batch, *target)
    same(load().select(batch.columns), batch)


@pytest.mark.parametrize("dataset", ["ohlcv", "flow"])
def test_bars_of_bars_over_a_restart(spark, small, tmp_path, dataset):
    """Hours made of the stream's own minutes, in two runs of one checkpoint."""
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    trades = small["trades"]
    middle = trades.agg(F.expr("percentile_approx(exchange_ts, 0.5)")).first()[0]
    for early in (True, False):
        part = trades.where((F.col("exchange_ts") <= middle) == early)
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(trades.schema).parquet(source)
        bars = stream_resample(stream, dataset, "1m", "4h", delay="20 minutes")
        write_stream(bars, out, state).awaitTermination()
    last = trades.agg(F.max("exchange_ts")).first()[0] - 20 * 60_000
    closed = build(dataset, small, "4h").where(F.col("timestamp") + HOURS4 <= last)
    same(spark.read.schema(bars.schema).parquet(out), closed)


def test_bars_of_bars_need_a_merge_and_a_multiple(small):
    for dataset, fine, coarse in (("returns", "1m", "1h"), ("ohlcv", "1h", "1m"), ("flow", "1h", "1h")):
        with pytest.raises(ValueError):
            stream_resample(small["trades"], dataset, fine, coarse)
