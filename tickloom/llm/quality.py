"""Quality rules: a threshold table compiled into one projection.

The metrics of a text are one expression over its word and line arrays; a row of
``RULES`` becomes one comparison on them. No user functions, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, WORD, let

#: Frequent function words of the four languages, all lower case.
STOP_WORDS = tuple(
    """the of and to in a is that for it was on with as be by this are or an
    de la que el en y los las un una por con para del se su al es lo no
    der die das und ist den von zu mit sich des auf im ein eine nicht dem
    le les et du des est dans pour qui sur par au ne pas ce il elle""".split()
)
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


class Rule(NamedTuple):
    """``metric`` must lie within ``low`` and ``high`` (None leaves a side open) in texts of
    ``words`` words or more."""

    metric: str
    low: float | None
    high: float | None
    words: int = 0


RULES = (
    Rule("n_words", 10, None),
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbol_ratio", None, 0.3),
    Rule("stop_word_ratio", 0.05, None, words=30),
    Rule("dup_line_ratio", None, 0.4),
    Rule("repeat_word_ratio", None, 0.2),
)
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_stop_words",
    "n_repeat_words",
)


def _repeat_words(words: Column, window: int) -> Column:
    """Words inside windows that stand at least twice in the text.

    Windows are compared by 64-bit hashes of word hashes. Where none repeats nothing is
    sorted; else (hash, place) pairs are, so a long text costs n log n.
    """

    def grams(hashes: Column) -> Column:
        last = F.size(hashes) - (window - 1)
        parts = lambda i: [F.get(hashes, i + k) for k in range(window)]
        return F.when(
            last > 0, F.transform(F.slice(hashes, 1, F.greatest(last, F.lit(0))), lambda x, i: F.xxhash64(*parts(i)))
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            places,
            start,
            lambda a, i: F.struct(
                (a["n"] + i + window - F.greatest(i, a["end"])).alias("n"),
                (i + window).alias("end"),
            ),
            lambda a: a["n"],
        )

    def repeated(hashes: Column) -> Column:
        pairs = F.sort_array(
            F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        )

        def places(p: Column) -> Column:
            same = lambda k, other: F.coalesce(
                F.get(p, k)["h"] == F.get(p, other)["h"], F.lit(False)
            )
            twice = F.filter(
                F.sequence(F.lit(0), F.size(p) - 1), lambda k: same(k, k - 1) | same(k, k + 1)
            )
            return F.sort_array(F.transform(twice, lambda k: F.get(p, k)["i"]))

        return covered(let(pairs, places))

    return let(
        let(F.transform(words, lambda w: F.xxhash64(w)), grams),
        lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(repeated(g)),
    )


def metrics(text: Column) -> Column:
    """Struct of ``COUNTS`` (long) of a text; null and blank texts count as empty."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        glued = F.array_join(words, "")
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
        stops = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
        line_counts = let(
            lines,
            lambda x: F.struct(
                F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")
            ),
        )
        values = {
            "n_words": F.size(words),
            "word_chars": F.length(glued),
            "n_symbols": F.length(glued) - F.length(F.regexp_replace(glued, SYMBOLS, "")),
            "n_stop_words": F.size(F.filter(words, lambda w: w.isin(stops))),
            "n_repeat_words": _repeat_words(words, WINDOW),
        }
        return let(
            line_counts,
            lambda c: F.struct(
                *[
                    (
                        c["n"]
                        if name == "n_lines"
                        else c["dup"]
                        if name == "n_dup_lines"
                        else values[name]
                    )
                    .cast("long")
                    .alias(name)
                    for name in COUNTS
                ]
            ),
        )

    return let(F.array_remove(F.split(text, BLANK), ""), of)


def ratios(m: Column) -> dict[str, Column]:
    """What rules may name, from a struct of counts; null where a divisor is 0."""
    per_word = lambda name: F.try_divide(m[name].cast("double"), m["n_words"])
    return {name: m[name] for name in COUNTS} | {
        "mean_word_chars": per_word("word_chars"),
        "symbol_ratio": per_word("n_symbols"),
        "stop_word_ratio": per_word("n_stop_words"),
        "repeat_word_ratio": per_word("n_repeat_words"),
        "dup_line_ratio": F.try_divide(m["n_dup_lines"].cast("double"), m["n_lines"]),
    }


def verdict(m: Column, rules: Sequence[Rule] = RULES) -> Column:
    """True if every rule holds. A ratio without a divisor breaks its rule."""
    known = ratios(m)
    holds = F.lit(True)
    for rule in rules:
        short = m["n_words"] < rule.words
        if rule.low is not None:
            holds = holds & (short | F.coalesce(known[rule.metric] >= rule.low, F.lit(False)))
        if rule.high is not None:
            holds = holds & (short | F.coalesce(known[rule.metric] <= rule.high, F.lit(False)))
    return holds


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (m["n_repeat_words"] * 100 > m["n_words"] * 20)


def judged(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct of the counts, base_failed and kept, computed in one expression."""
    return let(
        metrics(text),
        lambda m: F.struct(
            *[m[name].alias(name) for name in COUNTS],
            base_failed(m).alias("base_failed"),
            (~base_failed(m) & verdict(m, rules)).alias("kept"),
        ),
    )


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of ``docs``.

    Needs doc_id and text; other columns are ignored. A null text has no words and
    fails; repeated rows and null ids get a row each; an empty table gives none.
    """
    return docs.select("doc_id", judged(F.col("text"), rules).alias("q")).select("doc_id", "q.*")


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return docs.where(judged(F.col("text"), rules)["kept"])


def _sql() -> str:
    stops = ", ".join(f"'{w}', '{w.capitalize()}'" for w in STOP_WORDS)
    known = {
        "n_words": "n_words",
        "mean_word_chars": "word_chars::DOUBLE / nullif(n_words, 0)",
        "symbol_ratio": "n_symbols::DOUBLE / nullif(n_words, 0)",
        "stop_word_ratio": "n_stop_words::DOUBLE / nullif(n_words, 0)",
        "repeat_word_ratio": "n_repeat_words::DOUBLE / nullif(n_words, 0)",
        "dup_line_ratio": "n_dup_lines::DOUBLE / nullif(n_lines, 0)",
    }
    holds = " AND ".join(
        f"(n_words < {r.words} OR coalesce({known[r.metric]} {op} {limit}, false))"
        for r in RULES
        for op, limit in ((">=", r.low), ("<=", r.high))
        if limit is not None
    )
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (SELECT doc_id, i, ws[i:i + 4] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM r) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(array_to_string(ws, ''), '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    len(list_filter(ws, lambda x: x IN ({stops}))) AS n_stop_words,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND {holds} AS kept
FROM b
"""


SQL = _sql()
