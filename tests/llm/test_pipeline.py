"""The pipeline's stages against plain versions on a small table."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import mixing, quality
from tickloom.llm.common import stage

from .conftest import prose
from .test_dedup import least_labels, shingle_set
from .test_lines import without_runs

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    columns = docs.columns
    good = {r.doc_id for r in quality.judge(docs).where("kept").select("doc_id").collect()}
    one = stage(corpus_pipeline.quality_rules(spark, docs, SMALL), "one")
    assert {r.doc_id for r in one.collect()} == good and one.columns == columns

    two = stage(corpus_pipeline.line_dedup(spark, one, SMALL), "two")
    before = [(r.doc_id, r.text, None) for r in one.orderBy("doc_id").collect()]
    size = {doc: text.count("\n") + 1 for doc, text, _ in before}
    texts = {doc: text for doc, text, gone in without_runs(before) if gone < size[doc]}
    assert len(texts) < len(before) and any(texts.get(doc, text) != text for doc, text, _ in before)
    assert {r.doc_id: r.text for r in two.collect()} == texts and two.columns == columns
    assert all(r.n_chars == len(r.text) for r in two.collect())

    three = stage(corpus_pipeline.ngram_jaccard(spark, two, SMALL), "three")
    sets = {d: shingle_set(t, 5) for d, t in texts.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    label = least_labels(sets, links)
    assert {r.doc_id for r in three.collect()} == {d for d, c in label.items() if d == c}

    four = stage(corpus_pipeline.mix_sources(spark, three, SMALL), "four")
    plan = {r.doc_id: r.copies for r in mixing.mix(three).collect()}
    assert Counter(r.doc_id for r in four.collect()) == Counter(plan)
    assert four.columns == columns

    five = corpus_pipeline.best_fit_packing(spark, four, SMALL)
    assert Counter(r.doc_id for r in five.where("piece = 0").collect()) == Counter(plan)


def test_rows_of_one_id_are_documents_of_their_own(spark, frame):
    one, two, three = (prose(900 + k, 60, 10**6) for k in range(3))
    near = " ".join(["changed", *one.split()[1:]])
    docs = [(1, one, "a"), (1, two, "a"), (None, near, "a"), (None, three, "a"), (None, three, "b")]
    found = corpus_pipeline.ngram_jaccard(spark, frame(docs), SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter([(1, one), (1, two), (None, three)])
    found = corpus_pipeline.mix_sources(spark, frame([(1, one, "a"), (1, "", "a")]), SMALL).collect()
    assert max(Counter(r.text for r in found).values()) <= 2


def test_columns_of_the_input_stay(spark, frame):
    names = ["row_number", "near", "of_id", "of_text", "times", "copy", "__gone", "n_lines"]
    docs = frame([(k, prose(950 + k, 60, 10**6), "ab"[k % 2]) for k in range(8)])
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(k))
    for name, function in corpus_pipeline.STAGES[:-1]:
        found = function(spark, docs, SMALL)
        assert found.columns == docs.columns
        rows = {tuple(r) for r in found.select(names).collect()}
        assert rows == {tuple(range(len(names)))} or name == "quality_rules" and not rows


def test_odd_rows(spark, frame, rows):
    docs = frame([*rows, (None, "no id " + rows[10][1], "a")])
    for _, function in corpus_pipeline.STAGES:
        found = stage(function(spark, docs, SMALL), "stage").count()
        empty = function(spark, docs.limit(0), SMALL)
        assert found > 0 and empty.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules"
