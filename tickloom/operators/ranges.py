"""Cutting time so that every piece holds about equally many rows.

A fixed slice width is either too wide for a busy second or too narrow for a quiet month. Here
time is first divided into blocks of a fixed width. Blocks with more rows than wanted are cut
where cumulative counts per millisecond pass multiples of the wanted number, and a millisecond
with more rows than that becomes a range of its own, dealt over parts by row id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.catalogue import SERIES
from tickloom.functions.clock import DAY_MS, time_bucket, ts_column
from tickloom.session import shared_folder

#: Ranges made per shuffle partition if no number of rows is given.
RANGES_PER_TASK = 8
#: No more ranges than this are cut, whatever the input, so the table of cuts stays below
#: 4 x that many entries (two longs each).
MOST_RANGES = 250_000
_BLOCK = [*SERIES, "block"]


@dataclass(frozen=True)
class Cuts:
    """Blocks of ``width_ms`` and the cuts inside the busy ones.

    ``table``: exchange, symbol, block and the sorted array ``cuts`` of (start, parts); None if
    no block is busy. ``longest`` is the largest number of cuts in a block.
    """

    width_ms: int
    table: DataFrame | None = None
    longest: int = 0

    def place(self, rows: DataFrame) -> DataFrame:
        """Add ``slice`` (start of the range), ``part`` and ``parts`` to rows with exchange,
        symbol, ts and id.

        All rows of one slice and part are neighbours in time. Parts are above one only in a
        slice of a single millisecond. Rows that were not counted are placed too.
        """
        block = time_bucket(F.col("ts"), self.width_ms)
        if self.table is None:
            return rows.withColumns({"slice": block, "part": F.lit(0), "parts": F.lit(1)})
        rows = rows.withColumn("block", block)
        # Bounded by MOST_RANGES, see there.
        rows = rows.join(F.broadcast(self.table), _BLOCK, "left")
        last = _last_cut(self.longest)
        cut = F.when(F.col("cuts").isNotNull() & (last >= 0), F.get("cuts", last))
        rows = rows.withColumn("cut", cut)
        start = F.col("cut.start")
        at_start = F.col("ts") == start
        parts = F.coalesce(F.when(at_start, F.col("cut.parts")), F.lit(1))
        # Behind a millisecond that is dealt over parts, rows begin a slice of their own.
        start = F.when((F.col("cut.parts") > 1) & ~at_start, start + 1).otherwise(start)
        rows = rows.withColumns({"slice": F.coalesce(start, "block"), "parts": parts})
        part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
        return rows.withColumn("part", part).drop("block", "cuts", "cut")


def _last_cut(longest: int) -> Column:
    """Index of the last cut at or before ``ts``, -1 if there is none: a binary search."""
    powers = [1 << k for k in reversed(range(max(longest, 1).bit_length()))]

    def step(at: Column, power: Column) -> Column:
        after = F.get(F.col("cuts"), at + power)["start"]
        return F.when(after <= F.col("ts"), at + power).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, powers)), F.lit(-1), step)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    spark, path = df.sparkSession, shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def balance(
    frames: Sequence[DataFrame],
    ts_kind: str = "exchange",
    width_ms: int = 900_000,
    target_rows: int | None = None,
) -> Cuts:
    """Cuts for the ticks of all ``frames`` together.

    One pass over key columns counts blocks, with map-side sums. Only if some hold more than
    ``target_rows`` (by default an eighth of an even share of a shuffle partition) a second
    pass counts milliseconds in those. A range holds at most twice ``target_rows``; a part of a
    millisecond about ``target_rows``. Ticks without exchange, symbol or clock are not counted.
    """
    if not 0 < width_ms <= DAY_MS:
        raise ValueError(f"blocks of {width_ms} ms; a day at most")
    ts = F.col(ts_column(ts_kind))
    known = ts.isNotNull()
    for name in SERIES:
        known = known & F.col(name).isNotNull()
    block = time_bucket(F.col("ts"), width_ms).alias("block")
    ticks = reduce(
        DataFrame.unionByName,
        (df.where(known).select(*SERIES, ts.alias("ts")) for df in frames),
    )
    spark = ticks.sparkSession
    blocks = _stored(ticks.groupBy(*SERIES, block).agg(F.count(F.lit(1)).alias("n")), "blocks")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_TASK
    target = -(-total // ranges) if target_rows is None else target_rows
    target = max(target, -(-total // MOST_RANGES), 1)
    # At most total / target blocks.
    busy = blocks.where(F.col("n") > target).select(*_BLOCK)
    if busy.isEmpty():
        return Cuts(width_ms)
    stamps = (
        ticks.select("*", block)
        .join(F.broadcast(busy), _BLOCK, "left_semi")
        .groupBy(*_BLOCK, "ts")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Cumulative counts by second, then by millisecond within it: no window holds more than a
    # block's seconds or a second's milliseconds.
    stamps = _stored(stamps.withColumn("second", time_bucket(F.col("ts"), 1000)), "stamps")
    upto = Window.unboundedPreceding, -1
    seconds = stamps.groupBy(*_BLOCK, "second").agg(F.sum("n").alias("m"))
    by_second = Window.partitionBy(*_BLOCK).orderBy("second").rowsBetween(*upto)
    seconds = seconds.withColumn("before", F.coalesce(F.sum("m").over(by_second), F.lit(0))).drop("m")
    by_ms = Window.partitionBy(*_BLOCK, "second").orderBy("ts").rowsBetween(*upto)
    inside = F.coalesce(F.sum("n").over(by_ms), F.lit(0))
    placed = stamps.withColumn("inside", inside).join(seconds, [*_BLOCK, "second"])
    alone = F.col("n") > target
    cuts = (
        placed.groupBy(
            *_BLOCK,
            F.floor((F.col("before") + F.col("inside")) / target).alias("number"),
            F.when(alone, F.col("ts")).alias("stamp"),
        )
        .agg(
            F.min("ts").alias("start"),
            F.max(F.when(alone, F.ceil(F.col("n") / target)).otherwise(1)).cast("int").alias("parts"),
        )
        .groupBy(*_BLOCK)
        .agg(F.array_sort(F.collect_list(F.struct("start", "parts"))).alias("cuts"))
    )
    cuts = _stored(cuts, "cuts")
    return Cuts(width_ms, cuts, cuts.agg(F.max(F.size("cuts"))).first()[0])
