"""As-of join (backward): each trade with the mid of the last quote at or before it.

Ties within a millisecond go to the highest quote id; quotes with a null mid are
skipped; a trade before any quote gets a null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.catalogue import SERIES
from tickloom.functions.clock import time_bucket, ts_column
from tickloom.functions.expr import order_key
from tickloom.operators.ranges import Cuts, balance
from tickloom.operators.slices import CHUNK_ROWS, DEFAULT_SLICE_MS, carry_last

_SLICE = [*SERIES, "slice"]
_CELL = [*_SLICE, "part"]
# Trades that belong to no series are spread over so many slices; they match nothing.
_SCATTER = 1024


def asof_mid(
    trades: DataFrame,
    quotes: DataFrame,
    ts_kind: str = "exchange",
    *,
    slice_ms: int = DEFAULT_SLICE_MS,
    chunk_rows: int = CHUNK_ROWS,
    cuts: Cuts | None = None,
) -> DataFrame:
    """All trade columns plus ``mid``.

    Time is cut into slices of about equally many rows (``cuts``, see ``ranges.balance``; if
    not given, blocks of ``slice_ms`` are counted now). The window runs per (exchange, symbol,
    slice), so neither a busy symbol nor a busy second is one task. Trades and quotes are
    shuffled once: the window and a table with the last mid of each slice both read that
    shuffle. The table is carried forward over the slices and joined back on the slice, for
    trades before their slice's first quote. In a millisecond that is dealt over parts every
    trade takes the millisecond's last quote, or else that of an earlier slice, from the table.

    A quote whose mid is null or zero counts as no quote. A trade without exchange, symbol
    or clock belongs to no series and gets a null; a quote without one is left out.
    """
    if cuts is None:
        cuts = balance([trades, quotes], ts_kind, slice_ms)
    width = cuts.width_ms
    clock = F.col(ts_column(ts_kind))
    known = clock.isNotNull()
    for name in SERIES:
        known = known & F.col(name).isNotNull()
    mid = F.nullif((F.col("bid_price") + F.col("ask_price")) / F.lit(2.0), F.lit(0.0))
    row = F.struct(*trades.columns)
    scattered = F.pmod(F.xxhash64("trade_id"), F.lit(_SCATTER)) * width
    # Keys that can't be null: a join on them adds no filter that would split the shuffle.
    cell = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in SERIES]
    keys = [*cell, F.coalesce(F.when(known, clock).otherwise(scattered), F.lit(0)).alias("ts")]
    traded = trades.select(
        *keys,
        F.when(known, F.lit(1)).otherwise(F.lit(2)).alias("kind"),
        F.col("trade_id").alias("id"),
        F.lit(None).cast("double").alias("mid"),
        row.alias("trade"),
    )
    quoted = (
        quotes.where(known)
        .withColumn("trade_id", F.lit(0))
        .select(
            *keys,
            F.lit(0).alias("kind"),
            F.col("quote_id").alias("id"),
            mid.alias("mid"),
            F.lit(None).cast(traded.schema["trade"].dataType).alias("trade"),
        )
        .where(F.col("mid").isNotNull())
    )
    rows = cuts.place(quoted.unionByName(traded)).repartition(*map(F.col, _CELL))
    order = order_key(F.col("ts"), F.col("id"), width)
    # Counting trades keeps both branches on the same columns, hence one shuffle.
    slices = rows.groupBy(*_SLICE).agg(
        F.max_by("mid", F.when(F.col("kind") == 0, order)).alias("last_mid"),
        F.count("trade").alias("n"),
        F.max("parts").alias("parts"),
    )
    seeds = carry_last(slices, "last_mid", "slice", width, "seed", chunk_rows)
    own = F.when(F.col("parts") > 1, F.col("last_mid"))
    seeds = seeds.withColumn("seed", F.coalesce(own, "seed"))
    seeds = seeds.where((F.col("n") > 0) & F.col("seed").isNotNull()).select(
        *_SLICE,
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        "seed",
    )
    before = (
        Window.partitionBy(*_CELL)
        .orderBy("ts", "kind", "id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        rows.withColumn("mid", F.last("mid", ignorenulls=True).over(before))
        .where(F.col("kind") > 0)
        .join(seeds, _CELL, "left")
    )
    whole = F.when(F.col("parts") == 1, F.col("mid"))
    found = F.when(F.col("kind") == 1, F.coalesce(whole, "seed"))
    return matched.select("trade.*", found.alias("mid"))
