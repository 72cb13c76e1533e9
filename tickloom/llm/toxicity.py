"""Toxicity by multiple-instance learning: sentences in documents, labels on documents only.

A sentence has probability sigmoid(b + sum of the weights of its distinct words); a document
is toxic if any sentence is (noisy-or: 1 - product of (1 - p)). The gradient of the document's
log loss reaches every sentence through its own share of the noisy-or, so blame settles on the
sentences that explain the label, which are then located. Fitted on the driver on at most
``learn.MOST_ROWS`` labelled rows; every whole text is scored in Arrow batches.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import learn
from .common import ship

EPOCHS = 40
BATCH = 32
RATE = 0.3
#: Pull of word weights towards 0 (L1), per document of a batch.
SHRINK = 4e-4
THRESHOLD = 0.5
#: Bias before training: long documents have many sentences.
START = -6.0
#: Other ASCII than letters and digits separates words; these also end sentences.
ENDS = b".!?\n"
_TABLE = bytes(
    10 if c in ENDS else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def sentences(text: str | None) -> list[bytes]:
    """Sentences of the text in lower case (A-Z), as UTF-8 with blanks for punctuation.

    Lengths are those of the original bytes, so a sentence begins where those before it
    and one byte for each of their ends have gone.
    """
    return (text or "").encode().lower().translate(_TABLE).split(b"\n")


class Model:
    """Weights of words and the bias."""

    def __init__(self, weights: dict[bytes, float], bias: float):
        self.weights, self.bias = weights, bias

    def sentence_scores(self, found: list[bytes]) -> np.ndarray:
        known, weights = self.weights.keys(), self.weights
        z = np.full(len(found), self.bias)
        for k, sentence in enumerate(found):
            words = known & set(sentence.split())
            if words:
                z[k] += sum(weights[w] for w in sorted(words))
        return learn.sigmoid(z)

    def score(self, texts: list[str | None]) -> dict[str, np.ndarray | pa.Array]:
        names = ("score", "sentence", "sentence_start", "sentence_end", "sentence_score")
        rows: dict[str, list] = {name: [] for name in names}
        for text in texts:
            found = sentences(text)
            p = self.sentence_scores(found)
            worst = int(np.argmax(p))
            start = sum(map(len, found[:worst])) + worst
            raw = (text or "").encode()
            first = len(raw[:start].decode(errors="ignore"))
            length = len(raw[start : start + len(found[worst])].decode(errors="ignore"))
            score = float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))
            for name, x in zip(
                names, (score, worst, first, first + length, float(p[worst])), strict=True
            ):
                rows[name].append(x)
        return {name: np.array(x) for name, x in rows.items()}


def fit(texts: list[str | None], y: np.ndarray) -> Model:
    """AdaGrad with proximal L1 on the noisy-or log loss.

    Only words of at least 3 documents (and one in a thousand) get a weight. Without rows of
    both classes the score is that of the bias alone.
    """
    if not len(texts) or y.min() == y.max():
        return Model({}, START)
    in_docs: dict[bytes, int] = {}
    for text in texts:
        for word in {w for s in sentences(text) for w in s.split()}:
            in_docs[word] = in_docs.get(word, 0) + 1
    least = max(3, len(texts) // 1000)
    number = {w: k for k, w in enumerate(sorted(w for w, n in in_docs.items() if n >= least))}
    del in_docs
    docs = []  # word numbers of all sentences, and how many each sentence has
    for text in texts:
        index = [sorted({number[w] for w in s.split() if w in number}) for s in sentences(text)]
        lengths = np.array([len(i) for i in index], dtype=np.int32)
        docs.append((lengths, np.fromiter(chain.from_iterable(index), np.int32, lengths.sum())))
    weights, bias = np.zeros(len(number)), START
    seen, seen_bias = np.full(len(number), 1e-8), 1e-8
    random = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(y)), -(-len(y) // BATCH)):
            counts = np.concatenate([docs[k][0] for k in rows])
            index = np.concatenate([docs[k][1] for k in rows])
            doc = np.repeat(np.arange(len(rows)), [len(docs[k][0]) for k in rows])
            sentence = np.repeat(np.arange(len(counts)), counts)
            z = bias + np.bincount(sentence, weights[index], len(counts))
            p = np.minimum(learn.sigmoid(z), 1 - 1e-12)
            clean = np.bincount(doc, np.log1p(-p), len(rows))
            toxic = -np.expm1(clean)
            odds = np.exp(clean) / np.maximum(toxic, 1e-12)
            blame = np.where(y[rows] == 1, -odds, 1.0)[doc] * p / len(rows)
            gradient = np.bincount(index, blame[sentence], len(weights))
            seen += gradient**2
            step = RATE / np.sqrt(seen)
            weights -= step * gradient
            weights = np.sign(weights) * np.maximum(np.abs(weights) - step * SHRINK, 0)
            slope = blame.sum()
            seen_bias += slope**2
            bias -= RATE * slope / np.sqrt(seen_bias)
    return Model({w: float(weights[k]) for w, k in number.items() if weights[k]}, float(bias))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    threshold: float = THRESHOLD,
    most_rows: int = learn.MOST_ROWS,
) -> DataFrame:
    """doc_id, held_out, score, predicted and the worst sentence of every row of ``docs``.

    ``sentence`` is its number from 0, ``sentence_start`` and ``sentence_end`` are its place in
    characters, ``sentence_score`` its probability. Needs doc_id and text of ``docs``, doc_id
    and ``label`` of ``labels``; other columns are never read. Null and empty texts are one
    empty sentence; a null doc_id is held out; repeated rows get a row each; an empty table
    gives none; of equally bad sentences the first counts.
    """
    ship(docs.sparkSession)
    rows = learn.training_rows(docs, labels, label, most_rows).toPandas()
    rows = rows.sort_values(["text", "y"], ignore_index=True)
    model = fit([None if t != t else t for t in rows["text"]], rows["y"].to_numpy())
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("score", T.DoubleType()),
            T.StructField("sentence", T.LongType()),
            T.StructField("sentence_start", T.LongType()),
            T.StructField("sentence_end", T.LongType()),
            T.StructField("sentence_score", T.DoubleType()),
        ]
    )
    scored = docs.select("doc_id", "text").mapInArrow(
        learn.in_batches(model.score, to_arrow_schema(schema)), schema
    )
    return scored.select(
        "doc_id",
        (learn.fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "sentence",
        "sentence_start",
        "sentence_end",
        "sentence_score",
    )
