import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import learn, quality_model, toxicity

MIDDLE = "/root/testdata/sf0.1"


def accuracy(found, labels, name):
    pairs = found.where("held_out").join(labels, "doc_id").select("score", "predicted", name).toPandas()
    y = pairs[name].to_numpy()
    rank = pairs["score"].rank().to_numpy()
    n = y.sum()
    auc = (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))
    return (pairs["predicted"] == y).mean(), auc, y.mean()


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels")]


def test_quality_held_out(tables):
    docs, labels = tables
    found = quality_model.classify(docs, labels, most_rows=1500).cache()
    right, auc, rate = accuracy(found, labels, "quality")
    assert right > 0.95 > rate and auc > 0.98
    assert found.count() == docs.count()
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_toxicity_held_out(tables):
    docs, labels = tables
    found = toxicity.classify(docs, labels, most_rows=1500).cache()
    right, auc, _ = accuracy(found, labels, "toxic")
    assert right > 0.92 and auc > 0.85
    worst = found.where("predicted = 1").join(docs, "doc_id").limit(20).collect()
    assert worst
    for r in worst:
        sentence = r.text[r.sentence_start : r.sentence_end]
        assert sentence and not any(c in sentence for c in ".!?\n")


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(tables):
    docs, labels = (t.where("doc_id < 600") for t in tables)
    changed = labels.withColumn(
        "quality", F.when(learn.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    one = quality_model.classify(docs, labels).orderBy("doc_id").collect()
    two = quality_model.classify(other, changed).orderBy("doc_id").collect()
    assert one == two
    for r in one:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_training_rows_are_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, "b"), (3, "c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1), (4, 1), (6, 0)], "doc_id bigint, y int")
    kept = [d for d in (1, 2, 3) if zlib.crc32(str(d).encode()) % 5]
    found = learn.training_rows(docs, labels, "y").collect()
    expected = {1: ("text 0", 0.0), 2: ("b", 1.0), 3: ("c", 1.0)}
    assert sorted(tuple(r) for r in found) == sorted(expected[d] for d in kept) and 1 in kept
    assert learn.training_rows(docs, labels, "y", most=1).count() <= 1


@pytest.mark.parametrize("model", [quality_model, toxicity])
def test_edges(spark, frame, rows, model):
    name = "quality" if model is quality_model else "toxic"
    labels = spark.createDataFrame(
        [(k, k % 2, (k + 1) % 2, "x") for k in range(3, 50)] + [(None, 1, 1, "x"), (3, None, 7, "x")],
        "doc_id bigint, quality int, toxic int, text string",
    )
    found = model.classify(frame(rows), labels).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 for r in found)
    assert model.classify(frame([]), labels).count() == 0
    nothing = model.classify(frame(rows), labels.limit(0), name).collect()
    assert len(nothing) == len(rows)


def test_sum_of_squares_identity():
    machine = quality_model.fit(["a b c d", "x y z # $"] * 10, np.array([1.0, 0.0] * 10))
    index, value, ends = quality_model._vectors([quality_model.describe("a b x")], machine.cuts)
    score = machine.forward(index, value, ends)[0][0]
    v, x = machine.factors[index].astype(float), value
    pairs = sum(
        v[i] @ v[j] * x[i] * x[j] for i in range(len(x)) for j in range(i + 1, len(x))
    )
    assert score == pytest.approx(machine.bias + (machine.linear[index] * x).sum() + pairs, abs=1e-4)


def test_noisy_or():
    model = toxicity.Model({b"bad": 9.0}, -6.0)
    text = "Fine words. É very bad. Good"
    found = model.score([text, None])
    p = learn.sigmoid(np.array([-6.0, 3.0, -6.0]))
    assert found["score"][0] == pytest.approx(1 - np.prod(1 - p))
    assert text[found["sentence_start"][0] : found["sentence_end"][0]].strip() == "É very bad"
    assert found["score"][1] == pytest.approx(learn.sigmoid(np.array([-6.0]))[0])
