"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / quality`` (``u`` depends on its id and
text alone). A source whose target is ``e`` times its size and a rest gives every document
``e`` times (the complete epochs) and then documents in key order until their running
size is nearest to the rest. Built-in functions only.

A source may hold a third of all rows, so no source is sorted in one task. Keys fall into
buckets of a hundredth of an octave: at most 0.26 % of a source in each whatever the
qualities are. Bucket totals are summed with a map-side combine, run through a window of
at most ``BUCKETS`` rows per source, and only buckets are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, stage, uniform

#: Weights by position of the source, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix in terms of all words.
SHARE = 1.5
#: No source is taken more often than this.
MOST_EPOCHS = 2
#: Characters that lower a document's quality.
SYMBOLS = "#*$%&|<>"
LOW, HIGH, STEPS = -10, 6, 100
BUCKETS = (HIGH - LOW) * STEPS + 1


def quality_weight(text: Column) -> Column:
    """Words over words and symbols, 0.05 at least: 1 for prose, 1/2 for a symbol a word."""
    n = count_words(text).cast("double")
    symbols = F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0))
    return F.greatest(F.coalesce(F.try_divide(n, n + symbols), F.lit(1.0)), F.lit(0.05))


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """Adds ``target`` to one row per ``source`` with ``source_size``.

    Sources in code point order, null last, take ``weights`` in turn. Where a target
    would exceed ``most_epochs`` times its source it stops there and the excess goes to
    the others by weight. The level is found in closed form: with sources in order of
    size over weight, it is the highest of the levels that hold if all before a source
    are full. One row per source passes through one window.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    sizes = sizes.withColumn("weight", F.get(listed, turn))
    everything = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source"
    )
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    here_on = everything.rowsBetween(0, Window.unboundedFollowing)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum(F.col("source_size") * most_epochs).over(before), F.lit(0))
    level = (F.sum("source_size").over(whole) * F.lit(share) - full) / F.sum("weight").over(here_on)
    return (
        sizes.withColumn("level", level)
        .withColumn("level", F.max("level").over(whole))
        .select(
            "source",
            "source_size",
            F.least(
                (F.col("source_size") * most_epochs).cast("double"),
                F.col("weight") * F.col("level"),
            ).alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_epochs: int = MOST_EPOCHS,
    seed: str = "mix",
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source; other columns are ignored).

    Returns doc_id, source, size (words), source_size, target, epochs (how often the
    whole source is taken), copies (how often this document is) and taken (size x copies).

    Null text has size 0; null sources form a source of their own; a null doc_id is one
    more id. Keys depend on id and text, so rows of one id (null too) are spread like any
    others; equal rows share a key and are interchangeable. No document is taken more than
    ``most_epochs`` times. ``extra`` names expressions over ``docs`` to return as well. An empty table gives no rows. A source's taken words miss its target
    by at most half of the document at the cut.
    """
    row = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit(" "),
        F.coalesce(F.col("text"), F.lit("")),
    )
    slim = stage(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"),
            count_words(F.col("text")).alias("size"),
            (-F.ln(uniform(row, seed)) / quality_weight(F.col("text"))).alias("key"),
            *[value.alias(name) for name, value in (extra or {}).items()],
        ),
        "mix",
    )
    octave = F.floor(F.log2("key") * STEPS).cast("int")
    slim = slim.withColumn(
        "bucket", F.greatest(F.least(octave, F.lit(HIGH * STEPS)), F.lit(LOW * STEPS))
    )
    sizes = slim.groupBy("name").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size")
    )
    goal = targets(sizes, weights, share, most_epochs)
    goal = goal.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"), "source_size", "target"
    )
    earlier = (
        Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        slim.groupBy("name", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
        .select(
            "name",
            "bucket",
            F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset"),
        )
        .join(goal, "name")
    )
    within = (
        Window.partitionBy("name", "bucket")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.coalesce(
        F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)
    ).cast("int")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    fits = F.col("before") * 2 + F.col("size") <= F.col("rest") * 2
    chosen = (fits & (F.col("epochs") < most_epochs)).cast("int")
    return (
        slim.join(offsets, ["name", "bucket"])
        .withColumn("before", before)
        .withColumn("epochs", epochs)
        .withColumn("rest", rest)
        .withColumn("copies", F.col("epochs") + chosen)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "epochs",
            "copies",
            (F.col("size") * F.col("copies")).cast("long").alias("taken"),
            *(extra or {}),
        )
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS symbols,
    ('0x' || md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || coalesce(text, ''))[1:13])::BIGINT
      AS bits
  FROM documents),
k AS (
  SELECT doc_id, source, size::BIGINT AS size,
    -ln((bits + 0.5) / 4503599627370496.0)
      / greatest(CASE WHEN size + symbols = 0 THEN 1.0 ELSE size::DOUBLE / (size + symbols) END, 0.05)
      AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM k GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
t AS (
  SELECT source, source_size,
    least(2.0::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM l),
p AS (
  SELECT k.*, t.source_size, t.target, floor(t.target / t.source_size) AS epochs,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
  (size * (epochs + CASE WHEN 2 * before + size <= 2 * (target - epochs * source_size)
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
