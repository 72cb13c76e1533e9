"""License scan with a positional index of rare tokens. Built-in functions only.

The index is small: each template is a row of words, and a word's postings are the
(template, offset) pairs where it stands. One projection turns a text into its word count
and its hits, the (word, place) pairs of words that any key phrase or template holds;
hits are written once, texts are read once. Over all documents the document frequency of
each indexed word is counted (at most one row per word of the vocabulary reaches the
driver). For each template the word of its key phrase with the highest IDF is looked up
among a file's hits; the postings of the other words are intersected at their relative
places; the key phrase must stand complete.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stage
from .quality import STOP_WORDS

#: What separates words in a text that is not lower-cased yet.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Least share of a template's IDF weight that must stand in place.
LEAST_SHARE = 0.7


class Template(NamedTuple):
    """``key`` must stand complete in the text where ``words`` has it."""

    label: str
    words: str
    key: str
    base: bool = False


TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
    Template("gpl-3.0", "gnu general public license version 3", "public license version 3"),
    Template("gpl-2.0", "gnu general public license version 2", "public license version 2"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("apache-2.0", "apache license version 2 0", "license version 2 0"),
    Template("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template("mpl", "mozilla public license version", "mozilla public license"),
    Template("mit", "permission is hereby granted free of charge to any person", "hereby granted"),
    Template("bsd", "redistribution and use in source and binary forms", "binary forms"),
)


def _vocabulary(templates: Sequence[Template]) -> list[str]:
    found = {w for t in templates for w in t.key.split()}
    return sorted(found | {w for t in templates for w in t.words.split()} - set(STOP_WORDS))


def hits(text: Column, vocabulary: Sequence[str]) -> Column:
    """Struct of n_words and hits, an array of (w, i): indexed word and its place.

    Lower-casing is for A-Z alone: a letter beyond ASCII whose lower case is an ASCII one
    changes the number of bytes and does not match.
    """
    known = F.array(*[F.lit(w) for w in vocabulary])

    def one(word: Column, place: Column) -> Column:
        low = F.lower(word)
        there = low.isin(*vocabulary) & (F.octet_length(low) == F.octet_length(word))
        return F.when(
            there,
            F.struct(
                (F.array_position(known, low) - 1).cast("int").alias("w"), place.alias("i")
            ),
        )

    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")
    return let(
        words,
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.filter(F.transform(ws, one), lambda h: h.isNotNull()).alias("hits"),
        ),
    )


def _places(found: Column, template: Template, vocabulary: list[str], idf: list[float]) -> Column:
    """Array of (label, base, start, share) for the places of one template among hits."""
    key, words = template.key.split(), template.words.split()
    at = next(k for k in range(len(words)) if words[k : k + len(key)] == key)
    number = {w: k for k, w in enumerate(vocabulary)}
    rare = max(range(len(key)), key=lambda k: idf[number[key[k]]])
    posted = {number[w] * 256 + k: idf[number[w]] for k, w in enumerate(words) if w in number}
    codes = F.array(*[F.lit(c) for c in posted])
    weights = F.array(*[F.lit(w) for w in posted.values()])

    def complete(j: Column) -> Column:
        here = F.get(found, j)
        ok = here["w"] == number[key[rare]]
        for k, word in enumerate(key):
            if k != rare:
                other = F.get(found, j + (k - rare))
                ok = ok & (other["w"] == number[word]) & (other["i"] == here["i"] + (k - rare))
        return F.coalesce(ok, F.lit(False))

    def place(j: Column) -> Column:
        start = F.get(found, j)["i"] - (at + rare)
        low = F.greatest(j - len(words), F.lit(0))
        near = F.slice(found, low + 1, 2 * len(words) + 1)
        return let(
            start,
            lambda s: F.struct(
                F.lit(template.label).alias("label"),
                F.lit(template.base).alias("base"),
                (s + at).alias("start"),
                (
                    F.aggregate(
                        F.array_intersect(
                            F.transform(
                                F.filter(near, lambda h: (h["i"] >= s) & (h["i"] < s + len(words))),
                                lambda h: h["w"] * 256 + (h["i"] - s),
                            ),
                            codes,
                        ),
                        F.lit(0.0),
                        lambda a, c: a + F.get(weights, (F.array_position(codes, c) - 1).cast("int")),
                    )
                    / F.lit(sum(posted.values()))
                ).alias("share"),
            ),
        )

    places = F.transform(F.filter(F.sequence(F.lit(0), F.size(found) - 1), complete), place)
    return F.filter(places, lambda p: p["share"] >= LEAST_SHARE)


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words and places (label, base, start of the key phrase, share) of each row.

    Needs doc_id and text; other columns are ignored. A null or empty text has no words
    and no places. Repeated rows and null ids get a row each, and an empty table none.
    """
    vocabulary = _vocabulary(templates)
    slim = stage(
        docs.select("doc_id", hits(F.col("text"), vocabulary).alias("h")).select("doc_id", "h.*"),
        "licenses",
    )
    total = slim.count()
    frequency = dict(
        slim.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w"))
        .groupBy("w")
        .count()
        .collect()
    )
    idf = [math.log(1 + (total + 1) / (frequency.get(k, 0) + 1)) for k in range(len(vocabulary))]
    places = let(
        F.col("hits"),
        lambda h: F.flatten(F.array(*[_places(h, t, vocabulary, idf) for t in templates])),
    )
    return slim.select(
        "doc_id",
        "n_words",
        F.when(F.size("hits") > 0, places).otherwise(F.array()).alias("places"),
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Per document: the base phrases' places, and labels and score of all templates."""
    base = F.filter("places", lambda p: p["base"])
    joined = lambda places: F.array_join(
        F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ","
    )
    starts = F.transform("base", lambda p: p["start"].cast("long"))
    return scanned.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined("base").alias("base_labels"),
        joined("places").alias("labels"),
        F.coalesce(
            F.array_max(F.transform("places", lambda p: F.least(F.round(p["share"], 9), F.lit(1.0)))),
            F.lit(0.0),
        ).alias("score"),
    )


def _sql(templates: Sequence[Template] = TEMPLATES) -> str:
    vocabulary = _vocabulary(templates)
    parts, keys, heads = [], [], []
    for number, t in enumerate(templates):
        words, key = t.words.split(), t.key.split()
        at = next(k for k in range(len(words)) if words[k : k + len(key)] == key)
        heads.append(f"({number}, '{t.label}', {str(t.base).lower()}, {at}, {len(key)})")
        parts += [f"({number}, {k}, '{w}')" for k, w in enumerate(words) if w in vocabulary]
        keys += [f"({number}, {at + k}, '{w}')" for k, w in enumerate(key)]
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    listed = ", ".join(f"'{w}'" for w in vocabulary)
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
hits AS (SELECT * FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM w)
  WHERE word IN ({listed})),
idf AS (
  SELECT word, ln(1 + ((SELECT count(*) FROM w) + 1.0::DOUBLE) / (count(DISTINCT doc_id) + 1)) AS idf
  FROM (SELECT unnest([{listed}]) AS word) LEFT JOIN hits USING (word) GROUP BY word),
heads(t, label, base, lead_words, n) AS (VALUES {", ".join(heads)}),
keys(t, off, word) AS (VALUES {", ".join(keys)}),
parts(t, off, word) AS (VALUES {", ".join(parts)}),
found AS (
  SELECT doc_id, t, start FROM (
    SELECT doc_id, t, i - off AS start, count(*) AS matched
    FROM hits JOIN keys USING (word) GROUP BY doc_id, t, i - off) JOIN heads USING (t)
  WHERE matched = n),
whole AS (SELECT t, sum(idf) AS idf FROM parts JOIN idf USING (word) GROUP BY t),
shares AS (
  SELECT found.doc_id, found.t, start, sum(idf.idf) / any_value(whole.idf) AS share
  FROM found JOIN parts ON parts.t = found.t
    JOIN hits ON hits.doc_id = found.doc_id AND hits.word = parts.word AND hits.i = start + parts.off
    JOIN idf ON idf.word = parts.word JOIN whole ON whole.t = found.t
  GROUP BY found.doc_id, found.t, start),
places AS (SELECT doc_id, label, base, start + lead_words AS start, share
  FROM shares JOIN heads USING (t) WHERE share >= {LEAST_SHARE}),
summed AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(least(round(share, 9), 1.0)) AS score
  FROM places GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN summed USING (doc_id)
"""


SQL = _sql()
