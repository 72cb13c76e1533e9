"""Mixing, quality rules and license scan: built-in functions against plain Python."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tickloom.llm import licenses, mixing, quality, queries

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KEYED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def level_by_level(sizes, weights):
    """Targets by resharing the excess until none is above."""
    goal, full, rest = {}, set(), 1.5 * sum(sizes.values())
    while len(full) < len(sizes):
        free = {s: weights[s] for s in sizes if s not in full}
        share = {s: rest * w / sum(free.values()) for s, w in free.items()}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return goal | share
        for s in over:
            goal[s] = 2.0 * sizes[s]
            rest -= goal[s]
        full |= over
    return goal


def test_mix_reaches_targets(frame, rows):
    found = mixing.mix(frame(rows)).collect()
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    assert Counter((r.doc_id, r.size) for r in found) == Counter(
        (d, n) for (d, _, _), n in zip(rows, size, strict=True)
    )
    sizes, largest, taken = Counter(), Counter(), Counter()
    for (_, _, s), n in zip(rows, size, strict=True):
        sizes[s] += n
        largest[s] = max(largest[s], n)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    goal = level_by_level(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    for r in found:
        assert r.target == pytest.approx(goal[r.source])
        assert r.source_size == sizes[r.source]
        assert r.epochs <= r.copies <= 2
        assert r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= largest[s]
    again = mixing.mix(frame(list(reversed(rows))).repartition(3)).collect()
    pick = lambda got: Counter((r.doc_id, r.size, r.taken) for r in got)
    assert pick(found) == pick(again)


def test_better_documents_are_taken_more_often(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "good words all along").otherwise("bad## w#rds #ll #l#ng").alias("text"),
        F.lit("s").alias("source"),
    )
    found = mixing.mix(docs, share=0.5)
    share = {r.even: r.n for r in found.groupBy((F.col("doc_id") % 2).alias("even")).agg(F.avg("copies").alias("n")).collect()}
    assert share[0] > share[1] + 0.1
    assert found.agg(F.sum("taken")).first()[0] == pytest.approx(8000, abs=4)


def test_empty_tables(frame):
    docs = frame([])
    assert mixing.mix(docs).count() == 0
    assert quality.judge(docs).count() == 0
    assert licenses.digest(licenses.scan(docs)).count() == 0
    only_blank = [r.taken for r in mixing.mix(frame([(1, None, None), (2, "", "a")])).collect()]
    assert only_blank == [0, 0]


def counts_of(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for k in range(len(words) - 4):
        at[tuple(words[k : k + 5])].append(k)
    covered = {k + j for ks in at.values() if len(ks) > 1 for k in ks for j in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts(frame, rows):
    more = [(30, "a b c d e " * 3 + "x\n\nx\n x\n$5 & #1|", "a"), (31, "a a a a a a", "a")]
    found = quality.judge(frame(rows + more)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    expected = Counter((d, *counts_of(t)) for d, t, _ in rows + more)
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_each_rule_rejects(frame):
    good = "The house is on the hill and it was built in the year of the great storm there"
    texts = {
        "good": good,
        "symbols": good.replace(" ", "# "),
        "long words": " ".join(f"{w}{'x' * 20}{k}" for k, w in enumerate(good.split())),
        "no stop words": " ".join(f"zz{k}" for k in range(40)),
        "few words": "the of and",
        "lines": "\n".join([good, *["of the same"] * 9]),
        "null": None,
    }
    docs = frame([(k, t, "s") for k, t in enumerate(texts.values())])
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {0}
    assert quality.keep_good(docs).columns == docs.columns


@pytest.mark.parametrize("name", ["op1_mixing", "op2_quality_rules", "op5_license_scan"])
def test_sql_gives_the_same(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    expected = connection.execute(queries.sql_texts()[name])
    columns = sorted(c[0] for c in expected.description)
    place = {c[0]: k for k, c in enumerate(expected.description)}
    rows = sorted((tuple(r[place[c]] for c in columns) for r in expected.fetchall()), key=repr)
    found = queries.registry()[name](spark, SMALL)
    assert sorted(found.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == rows


PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


def base_places(text):
    words = KEYED.findall(low(text))
    found = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    return len(words), found


def test_license_base_places(frame, rows):
    more = [
        (60, "mit mit license license MIT\nLicense" + " mit license" * 3000, "a"),
        (61, "GNU General Public License gnu general public licence gnu general public", "a"),
        (62, "CC/BY ccby ccé by cc by-sa K cc\x7fby", "a"),
        (63, "apachelicense apache license apache-license", "a"),
    ]
    found = licenses.digest(licenses.scan(frame(rows + more))).collect()
    expected = Counter()
    for d, t, _ in rows + more:
        n, places = base_places(t)
        starts = [k for k, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        expected[d, n, len(starts), min(starts, default=None), max(starts, default=None), labels] += 1
    assert expected == Counter(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found
    )
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")


def test_license_templates(frame):
    texts = [
        "licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0",
        "Licensed under CC BY-NC 4.0",
        "Permission is hereby granted, free of charge, to any person",
        "permission is hereby granted to nobody",
        "the license is public and general",
    ]
    found = licenses.digest(licenses.scan(frame([(k, t, "s") for k, t in enumerate(texts)])))
    labels = [r.labels for r in found.orderBy("doc_id").collect()]
    assert labels == ["gpl,gpl-3.0", "apache,apache-2.0", "cc-by,cc-by-nc", "mit", "", ""]


def test_no_python_in_plans(spark):
    for name in ("op1_mixing", "op2_quality_rules", "op5_license_scan"):
        plan = queries.registry()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
