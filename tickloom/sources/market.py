"""Tick tables (trades, quotes, book, derivative ticks) from an ``events`` table.

Any table with the columns in ``catalogue.TRADES/QUOTES/BOOK/DERIV`` works as builder
input; this module derives such tables from the generated ``events`` data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalogue import EXCHANGES
from tickloom.functions.clock import ms_from_ntz

# How an event becomes a tick.
EVENT_EXCHANGE = "binance-futures"
EVENT_MONTHS = 4
EVENT_MONTH_MS = 31 * 86_400_000
LAG_STEP = 7919
LAG_LIMIT_MS = 900_000
QUOTE_EVENTS = ("signup", "error", "view")
DERIV_EVENTS = ("purchase", "click")
BOOK_LEVELS = 10


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _ticks(events: DataFrame, id_name: str) -> list[Column]:
    # One month of events, dealt over four months and three exchanges.
    month = (F.col("event_id") % EVENT_MONTHS) * EVENT_MONTH_MS
    ms = ms_from_ntz(F.col("ts")) + month
    user = F.col("user_id")
    exchanges = F.array(*map(F.lit, EXCHANGES))
    return [
        F.col("event_id").alias(id_name),
        F.get(exchanges, (user % len(EXCHANGES)).cast("int")).alias("exchange"),
        F.concat(
            F.lit("perpetual-S"), (user % 5).cast("string"), F.lit("-USDT:USDT")
        ).alias("symbol"),
        ms.alias("exchange_ts"),
        (ms + (F.col("event_id") * LAG_STEP) % LAG_LIMIT_MS).alias("true_ts"),
    ]


def trades(events: DataFrame) -> DataFrame:
    return events.select(
        *_ticks(events, "trade_id"),
        F.col("value").alias("price"),
        (_k() + 1).cast("double").alias("qty"),
        F.when(F.col("event_id") % 3 == 0, "sell").otherwise("buy").alias("side"),
    )


def quotes(events: DataFrame) -> DataFrame:
    half = (F.lit(1) + _k() % 5) / F.lit(100.0)
    return events.where(F.col("event_type").isin(*QUOTE_EVENTS)).select(
        *_ticks(events, "quote_id"),
        (F.col("value") + F.lit(1.0) - half).alias("bid_price"),
        (F.col("value") + F.lit(1.0) + half).alias("ask_price"),
        (F.lit(1) + F.col("user_id") % 50).cast("double").alias("bid_size"),
        (F.lit(1) + (F.col("event_id") * 7) % 50).cast("double").alias("ask_size"),
    )


def book(events: DataFrame) -> DataFrame:
    def ladder(best: str, step: float) -> Column:
        return F.array(
            *(F.col(best) + F.lit(step) * F.lit(float(i)) for i in range(BOOK_LEVELS))
        )

    return quotes(events).select(
        "quote_id",
        "exchange",
        "symbol",
        "exchange_ts",
        "true_ts",
        ladder("bid_price", -0.01).alias("bid_px"),
        ladder("bid_size", 1.0).alias("bid_sz"),
        ladder("ask_price", 0.01).alias("ask_px"),
        ladder("ask_size", 2.0).alias("ask_sz"),
    )


def deriv(events: DataFrame) -> DataFrame:
    mark = F.col("value") + F.lit(1.0)
    shift = _k() - 50
    return events.where(F.col("event_type").isin(*DERIV_EVENTS)).select(
        *_ticks(events, "tick_id"),
        mark.alias("mark_price"),
        (mark * (F.lit(1.0) - shift / F.lit(10000.0))).alias("index_price"),
        (shift / F.lit(1000000.0)).alias("funding_rate"),
        (F.col("user_id") * 10 + _k()).cast("double").alias("open_interest"),
    )
