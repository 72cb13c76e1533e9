"""Exact quantiles per group without holding a group in one task.

``percentile`` keeps every distinct value of a group in memory. Here equal values are
counted first (with a map-side combine), then the counts are put in coarse value bins;
running sums over the few bins show which bins hold the wanted ranks, and only the
values in those bins are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.sketches import K, quantile_of

# Bins per factor e. Logarithms of doubles lie within +-746, so 400,000 keeps the bins
# of positive values above zero.
_PER_E = 512
_SHIFT = 400_000


def _bin(value: Column) -> Column:
    """Whole number that never falls as the value rises; NaN comes last, as in a sort.

    ``ln`` is semi-monotonic by the Java specification, so rounding cannot swap bins.
    """

    def size(x: Column) -> Column:
        return F.floor(F.least(F.ln(x) * F.lit(float(_PER_E)), F.lit(1e6))) + _SHIFT

    return F.when(value > 0, size(value)).when(value < 0, -size(-value)).otherwise(F.lit(0))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, fractions: dict[str, float]
) -> DataFrame:
    """One row per group with the interpolated quantiles; nulls are left out.

    Counts are moved once to the bins' own partitioning. Bin totals, the join and the
    ranking all use it, and both branches read the same shuffle; the null filters are
    spelled out because the join would otherwise add them to one branch only.
    """
    rows = df.select(*keys, _bin(F.col(value)).alias("_bin"), F.col(value).alias("_v"))
    for name in rows.columns:
        rows = rows.where(F.col(name).isNotNull())
    counts = (
        rows.groupBy(*rows.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .repartition(*(F.col(name) for name in (*keys, "_bin")))
    )
    group = Window.partitionBy(*keys)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    bins = (
        counts.groupBy(*keys, "_bin")
        .agg(F.sum("_n").alias("_bin_n"), F.max("_v").alias("_top"))
        .withColumn("_upto", F.sum("_bin_n").over(group.orderBy("_bin").rowsBetween(*so_far)))
        .withColumn("_total", F.sum("_bin_n").over(group))
        .withColumn("_before", F.col("_upto") - F.col("_bin_n"))
    )

    def spot(fraction: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(fraction))

    wanted = F.lit(False)
    for fraction in fractions.values():
        wanted = wanted | (
            (F.col("_before") <= F.ceil(spot(fraction)))
            & (F.col("_upto") > F.floor(spot(fraction)))
        )
    # Reading _v here too keeps both branches on the same columns, hence one shuffle.
    wanted = wanted & F.col("_top").isNotNull()
    targets = bins.where(wanted).select(*keys, "_bin", "_before", "_total")
    in_bin = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(*so_far)
    ranked = counts.join(targets, [*keys, "_bin"]).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(in_bin)
    )
    picks = [F.max("_total").alias("_total")]
    for name, fraction in fractions.items():
        for end, rank in (("lo", F.floor), ("hi", F.ceil)):
            reached = F.col("_upto") > rank(spot(fraction))
            picks.append(F.min(F.when(reached, F.col("_v"))).alias(f"_{name}_{end}"))
    found = ranked.groupBy(*keys).agg(*picks)
    out = []
    for name, fraction in fractions.items():
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        part = spot(fraction) - F.floor(spot(fraction))
        out.append((low + (high - low) * part).alias(name))
    return found.select(*keys, *out)


def quantile_aggregates(
    value: str, fractions: dict[str, float], method: str, accuracy: int = 10_000
) -> list[Column]:
    """Quantiles inside an ordinary ``agg``.

    ``approx``: bounded memory, rank error at most rows / ``accuracy``. ``sketch``: the KLL
    sketch that ``sketches`` stores, a fixed few KB a bar.
    """
    points = F.array(*(F.lit(float(f)) for f in fractions.values()))
    if method == "sketch":
        sketch = F.kll_sketch_agg_double(F.when(~F.isnan(value), F.col(value)), F.lit(K))
        return [quantile_of(sketch, f).alias(name) for name, f in fractions.items()]
    if method != "approx":
        raise ValueError(f"unknown quantile method {method!r}")
    found = F.percentile_approx(value, points, accuracy)
    return [found.getItem(i).alias(name) for i, name in enumerate(fractions)]
