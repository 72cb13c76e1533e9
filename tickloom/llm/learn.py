"""What the two classifiers share: the held-out rule, training rows and sparse sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier is fitted on at most.
MOST_ROWS = 8000
#: One document in so many is held out.
FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text (null: empty) modulo ``FOLDS``; 0 is held out."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, most: int = MOST_ROWS
) -> DataFrame:
    """text and y of at most ``most`` labelled rows that are not held out.

    They are those with the smallest hash of their id; rows without a label, and labels
    other than 0 and 1, don't count. An id counts once, with its least label and the least
    of its texts. The bound holds at every size of the input, however often ids repeat.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .where(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.min(F.col(label).cast("double")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    once = rows.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("text", "y")


def row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` (rows, or rows of a matrix) ending at ``ends``."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    starts = np.concatenate([[0], ends[:-1]])
    return total[ends] - total[starts]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def in_batches(
    score: Callable[[list], dict[str, np.ndarray | pa.Array]], schema: pa.Schema, most: int = 1000
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function: the first column as it is, then what ``score`` makes of texts."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, most):
                part = batch.slice(k, most)
                found = score(part.column(1).to_pylist())
                columns = [part.column(0), *(found[name] for name in schema.names[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        c if isinstance(c, pa.Array) else pa.array(c, type=field.type)
                        for c, field in zip(columns, schema, strict=True)
                    ],
                    schema=schema,
                )

    return apply
