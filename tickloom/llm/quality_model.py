"""Quality classifier: a factorisation machine on words, structure and length.

A document is a sparse vector: its distinct words hashed into ``BUCKETS``, each with
weight 1 / sqrt(number of distinct words), and one indicator per statistic of its
structure (and its length, the only metadata used) for the interval the value lies in.
score = sigmoid(w0 + sum w_i x_i + sum over factors of ((sum v_i x_i)^2 - sum v_i^2 x_i^2) / 2):
pairwise interactions of rank ``RANK`` in time linear in the document. Fitted on the driver on
at most ``learn.MOST_ROWS`` labelled rows; every document is scored in Arrow batches.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import learn
from .common import ship

BUCKETS = 1 << 15
RANK = 8
INTERVALS = 12
EPOCHS = 12
BATCH = 128
RATE = 0.1
DECAY = 1e-5
THRESHOLD = 0.3
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
STATISTICS = 12
_bucket_of: dict[str, int] = {}


def _bucket(word: str) -> int:
    if len(_bucket_of) > 300_000:
        _bucket_of.clear()
    found = _bucket_of[word] = zlib.crc32(word.encode()) % BUCKETS
    return found


def describe(text: str | None) -> tuple[list[int], list[float]]:
    """Buckets of the distinct words, and the statistics; null counts as empty."""
    text = text or ""
    words = text.split()
    distinct = set(words)
    raw = text.encode()
    n, size = max(len(words), 1), max(len(raw), 1)
    lines = [line for line in text.split("\n") if line]
    get = _bucket_of.get
    buckets = [b if (b := get(w)) is not None else _bucket(w) for w in distinct]
    statistics = [
        len(words),
        len(text),
        len(raw) / n,
        (len(raw) - len(raw.translate(None, SYMBOLS))) / n,
        raw.count(b"!") / n,
        (len(raw) - len(raw.translate(None, UPPER))) / size,
        (len(raw) - len(raw.translate(None, DIGITS))) / size,
        (raw.count(b".") + raw.count(b",")) / n,
        len(distinct) / n,
        len(set(zip(words, words[1:], words[2:], strict=False))) / n,
        len(lines) / n,
        1 - len(set(lines)) / max(len(lines), 1),
    ]
    return buckets, statistics


def _vectors(described, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices, values and row ends of sparse vectors."""
    counts = np.array([len(b) for b, _ in described])
    statistics = np.array([s for _, s in described], dtype=np.float64)
    place = np.stack(
        [np.searchsorted(cuts[k], statistics[:, k], side="right") for k in range(STATISTICS)], 1
    )
    extra = BUCKETS + np.arange(STATISTICS) * INTERVALS + place
    words = np.fromiter(chain.from_iterable(b for b, _ in described), np.int64, counts.sum())
    starts = np.cumsum(counts) - counts
    at = np.repeat(starts + counts, STATISTICS)
    index = np.insert(words, at, extra.ravel())
    value = np.insert(
        np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts), at, np.full(extra.size, 0.5)
    )
    return index, value, np.cumsum(counts + STATISTICS)


class Machine:
    """A fitted factorisation machine."""

    def __init__(self, cuts: np.ndarray):
        size = BUCKETS + STATISTICS * INTERVALS
        self.cuts, self.bias = cuts, 0.0
        self.linear = np.zeros(size, dtype=np.float32)
        noise = np.random.default_rng(7).normal(0, 0.05, (size, RANK))
        self.factors = noise.astype(np.float32)

    def forward(self, index, value, ends):
        parts = self.factors[index] * value[:, None]
        sums = learn.row_sums(parts, ends)
        squares = learn.row_sums((parts * parts).sum(1), ends)
        linear = learn.row_sums(self.linear[index] * value, ends)
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), parts, sums

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        vectors = _vectors([describe(t) for t in texts], self.cuts)
        return learn.sigmoid(self.forward(*vectors)[0])


def fit(texts: list[str | None], y: np.ndarray) -> Machine:
    """AdaGrad on the log loss. Without rows the score is 1/2; with one class, near it."""
    described = [describe(t) for t in texts]
    statistics = np.array([s for _, s in described] or np.zeros((1, STATISTICS)))
    quantiles = np.linspace(0, 1, INTERVALS + 1)[1:-1]
    machine = Machine(np.quantile(statistics, quantiles, axis=0).T)
    if not len(texts):
        return machine
    rate = (y.sum() + 0.5) / (len(y) + 1)
    machine.bias = float(np.log(rate / (1 - rate)))
    seen = [1e-6, np.full_like(machine.linear, 1e-6), np.full_like(machine.factors, 1e-6)]
    random = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(y)), -(-len(y) // BATCH)):
            index, value, ends = _vectors([described[k] for k in rows], machine.cuts)
            z, parts, sums = machine.forward(index, value, ends)
            error = (learn.sigmoid(z) - y[rows]) / len(rows)
            row = np.repeat(np.arange(len(rows)), np.diff(ends, prepend=0))
            e = error[row] * value
            near = np.unique(index, return_inverse=True)
            touched, where = near[0], near[1]
            gradient = np.bincount(where, e, len(touched)) + DECAY * machine.linear[touched]
            pull = e[:, None] * (sums[row] - parts)
            by_factor = np.stack(
                [np.bincount(where, pull[:, f], len(touched)) for f in range(RANK)], 1
            )
            by_factor += DECAY * machine.factors[touched]
            seen[0] += error.sum() ** 2
            seen[1][touched] += gradient**2
            seen[2][touched] += by_factor**2
            machine.bias -= RATE * error.sum() / np.sqrt(seen[0])
            machine.linear[touched] -= RATE * gradient / np.sqrt(seen[1][touched])
            machine.factors[touched] -= RATE * by_factor / np.sqrt(seen[2][touched])
    return machine


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    threshold: float = THRESHOLD,
    most_rows: int = learn.MOST_ROWS,
) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Needs doc_id and text of ``docs``, doc_id and ``label`` of ``labels``; other columns are
    never read. Null and empty texts are scored as texts without words; a null doc_id is
    held out; repeated rows get a row each; an empty table gives none.
    """
    ship(docs.sparkSession)
    rows = learn.training_rows(docs, labels, label, most_rows).toPandas()
    rows = rows.sort_values(["text", "y"], ignore_index=True)
    machine = fit([None if t != t else t for t in rows["text"]], rows["y"].to_numpy())
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    score = lambda texts: {"score": machine.score(texts)}
    return (
        docs.select("doc_id", "text")
        .mapInArrow(learn.in_batches(score, to_arrow_schema(schema)), schema)
        .select(
            "doc_id",
            (learn.fold(F.col("doc_id")) == 0).alias("held_out"),
            "score",
            (F.col("score") >= threshold).cast("int").alias("predicted"),
        )
    )
