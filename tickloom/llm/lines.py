"""Line dedup: content-defined chunks of lines that repeat anywhere in the corpus go.

A hash rolls over every two neighbouring lines. A rule reads it modulo ``RULES``, counted from
the rule's own number: 0 opens a chunk before and closes it after these two lines, 1 opens one
before them, 2 closes one after them. A chunk runs from an opening to the next closing, with no
opening between, so whether lines are a chunk depends on these lines alone: after an inserted
or deleted line, and between any neighbours, both texts are cut alike. Chunks of all rules are
candidates. Under the ``RULES`` rules together each two lines in a row are the smallest chunk
of one of them, so no repeated run is missed; with fewer rules there are fewer candidates.

A chunk that repeats is extended line by line over its neighbours, to the left and to the
right, as far as the next chunk that would lie in the longer run (with all rules that is the
next line, and nothing is left to extend). Lines in a row that some document has before, in
order of doc_id, text hash, then line, go. A line goes only if an earlier line equals it, so by
induction over that order each text of a line stays somewhere.

How it is spread:
1. Keys of chunks (a rolled hash of their lines) are counted with a map-side combine.
2. Chunks and their extensions, 44 bytes each and no text, meet the repeated keys in a semi join
   of two written tables, which Spark can split at a hot key. The first place of each is found.
3. Documents get the list of their repeated places and are written so, once.
4. Byte comparison: each line of a repeated place goes with its hash, each text once a batch, and
   each place's key with a second rolled hash. If two different ones have one hash, all is done
   again with another hash function. Then the written documents are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import parts, ship, stage, unused

#: Boundary rules: as many as the rolled hash has remainders.
RULES = 4
_A, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd: they have inverses modulo 2^64


def _hash(data: bytes, turn: int = 0, size: int = 8) -> int:
    digest = hashlib.blake2b(data, digest_size=size, salt=turn.to_bytes(8, "little")).digest()
    return int.from_bytes(digest, "little")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(_A)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_B)
    return h ^ (h >> np.uint64(32))


class Rolled:
    """Sums from which the key of any lines in a row follows, wherever these stand."""

    def __init__(self, h: np.ndarray, factor: int):
        self.powers = np.full(len(h) + 1, factor, dtype=np.uint64)
        self.inverse = np.full(len(h) + 1, pow(factor, -1, 1 << 64), dtype=np.uint64)
        self.powers[0] = self.inverse[0] = 1
        self.powers, self.inverse = np.cumprod(self.powers), np.cumprod(self.inverse)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(h) * self.powers[:-1])])

    def keys(self, first: np.ndarray, lines: np.ndarray) -> np.ndarray:
        found = (self.sums[first + lines] - self.sums[first]) * self.inverse[first]
        return _mixed(found + lines.astype(np.uint64) * np.uint64(_B)).view(np.int64)


def chunks(h: np.ndarray, text: np.ndarray, rules: int = RULES) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of each chunk of the first ``rules`` rules, in order, each once.

    ``h`` are hashes of lines (uint64), ``text`` numbers their texts.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(h) < 2:
        return none, none
    rolled = _mixed(h[:-1] * np.uint64(_A) + h[1:]) % np.uint64(RULES)
    inside = text[1:] == text[:-1]
    first, last = [none], [none]
    for rule in range(rules):
        kind = np.where(inside, (rolled.astype(np.int64) - rule) % RULES, -1)
        events = np.flatnonzero(kind < 3)  # -1 is the end of a text
        kinds = kind[events]
        both = events[kinds == 0]
        long = np.flatnonzero((kinds[:-1] == 1) & (kinds[1:] == 2))
        first += [both, events[long]]
        last += [both + 1, events[long + 1] + 1]
    found = np.unique(np.stack([np.concatenate(first), np.concatenate(last)]), axis=1)
    return found[0], found[1]


def extended(
    text: np.ndarray, first: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks and their extensions to either side: number of the chunk, first and last line."""
    n = len(text)
    ends, starts = np.full(n, n), np.full(n, -1)
    np.minimum.at(ends, first, last)
    np.maximum.at(starts, last, first)
    every = np.arange(len(first))
    found = [(every, first, last)]
    for side in (-1, 1):
        on, at = every, (first if side < 0 else last)
        while len(on):
            at = at + side
            ok = (at >= 0) & (at < n)
            on, at = on[ok], at[ok]
            ok = text[at] == text[first[on]]
            ok &= (ends[at] > last[on]) if side < 0 else (starts[at] < first[on])
            on, at = on[ok], at[ok]
            found.append((on, at, last[on]) if side < 0 else (on, first[on], at))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _lines(texts: list[str | None], turn: int, size: int):
    """All lines, their hashes, the number of each one's text, and where each text starts."""
    split = [t.encode().split(b"\n") if t and "\n" in t else [] for t in texts]
    counts = np.array([len(x) for x in split], dtype=np.int64)
    lines = [x for s in split for x in s]
    h = np.fromiter((_hash(x, turn, size) for x in lines), np.uint64, len(lines))
    return lines, h, np.repeat(np.arange(len(texts)), counts), np.cumsum(counts) - counts


def _keys(turn: int, size: int, rules: int, schema: pa.Schema):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            _, h, text, _ = _lines(batch.column(0).to_pylist(), turn, size)
            first, last = chunks(h, text, rules)
            found = Rolled(h, _A).keys(first, last + 1 - first)
            yield pa.RecordBatch.from_arrays([pa.array(found)], schema=schema)

    return apply


def _places(turn: int, size: int, rules: int, schema: pa.Schema):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            _, h, text, start = _lines(batch.column(1).to_pylist(), turn, size)
            first, last = chunks(h, text, rules)
            rolled = Rolled(h, _A)
            keys = rolled.keys(first, last + 1 - first)
            chunk, first, last = extended(text, first, last)
            row = text[first]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    batch.column(2).take(pa.array(row)),
                    pa.array((first - start[row]).astype(np.int32)),
                    pa.array((last + 1 - first).astype(np.int32)),
                    pa.array(keys[chunk]),
                    pa.array(rolled.keys(first, last + 1 - first)),
                ],
                schema=schema,
            )

    return apply


def _proof(turn: int, size: int, schema: pa.Schema):
    """Hash and bytes of the lines of repeated places; key and second key of the places."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            lines, h, text, start = _lines(batch.column(0).to_pylist(), turn, size)
            spans = batch.column(1)
            row = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy())
            flat = spans.flatten()
            first = flat.field("first").to_numpy().astype(np.int64) + start[row]
            n = flat.field("lines").to_numpy().astype(np.int64)
            keys, second = flat.field("key").to_numpy(), Rolled(h, _B).keys(first, n)
            edge = np.zeros(len(h) + 1, dtype=np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + n, -1)
            used = np.flatnonzero(np.cumsum(edge[:-1]))
            found = {(False, int(h[k]) - (1 << 63), lines[k]) for k in used.tolist()}
            found |= {
                (True, key, x.to_bytes(8, "little", signed=True))
                for key, x in zip(keys.tolist(), second.tolist(), strict=True)
            }
            place, key, raw = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.bool_()), pa.array(key, pa.int64()), pa.array(raw, pa.binary())],
                schema=schema,
            )

    return apply


def _cut(schema: pa.Schema, at: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts, n_lines, n_removed = [], [], []
            spans_of = batch.column(batch.num_columns - 1).to_pylist()
            for text, spans in zip(batch.column(at).to_pylist(), spans_of, strict=True):
                lines = text.split("\n") if text else []
                drop = np.zeros(len(lines), dtype=bool)
                for span in spans or []:
                    if span["gone"]:
                        drop[span["first"] : span["first"] + span["lines"]] = True
                n_lines.append(len(lines))
                n_removed.append(int(drop.sum()))
                if n_removed[-1]:
                    text = "\n".join(x for x, d in zip(lines, drop, strict=True) if not d)
                texts.append(text)
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, schema.field(at).type)
            columns += [pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return apply


def repeated_places(docs: DataFrame, turn: int = 0, size: int = 8, rules: int = RULES) -> DataFrame:
    """doc_id, mark, first, lines, key and gone of all places of lines in a row that repeat.

    ``mark`` is a hash of the whole text: it tells rows of one id apart. ``gone`` is false for
    the first place alone.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    long, integer = T.LongType(), T.IntegerType()
    keys = T.StructType([T.StructField("chunk", long)])
    rows = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("mark", long),
            T.StructField("first", integer),
            T.StructField("lines", integer),
            T.StructField("chunk", long),
            T.StructField("key", long),
        ]
    )
    counted = texts.select("text").mapInArrow(_keys(turn, size, rules, to_arrow_schema(keys)), keys)
    counted = counted.groupBy("chunk").count().where("count > 1").select("chunk")
    counted = stage(counted, "chunks")
    found = texts.mapInArrow(_places(turn, size, rules, to_arrow_schema(rows)), rows)
    found = stage(found.join(counted, "chunk", "left_semi").drop("chunk"), "places")
    place = F.struct("doc_id", "mark", "first")
    origins = found.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("origin"))
    # Written first: a join of two plain tables is one that Spark can split at a hot key.
    origins = stage(origins.where("n > 1").drop("n"), "origins")
    gone = ~place.eqNullSafe(F.col("origin"))
    return found.join(origins, "key").withColumn("gone", gone).drop("origin")


NAMES = ("n_lines", "n_removed")


def dedup_lines(
    docs: DataFrame, size: int = 8, names: tuple[str, str] = NAMES, rules: int = RULES
) -> DataFrame:
    """All columns of ``docs`` with repeated lines cut from ``text``, then n_lines, n_removed.

    Needs doc_id and text. A null text stays null and an empty one empty, with 0 lines. Every
    later occurrence of two or more lines in a row goes (with fewer than all ``RULES`` rules:
    those that hold a chunk of one of the first ``rules``); one line alone never does. The
    first occurrence stays (in order of doc_id, a hash of the text, line). Rows equal in doc_id
    (null too) and text count as one document and keep or lose the same lines; rows of one id
    with different texts are documents of their own. The two counts have the
    names ``names``; columns of ``docs`` so named are replaced. An empty table gives no rows.
    ``size`` is the number of bytes of a line's hash at the first try.
    """
    ship(docs.sparkSession)
    docs = docs.drop(*names)
    of_id, of_text, spans_of = (unused(docs, x) for x in ("of_id", "of_text", "spans"))
    of_row = docs["doc_id"].eqNullSafe(F.col(of_id)) & (F.xxhash64("text") == F.col(of_text))
    span = F.struct("first", "lines", "key", "gone")
    proof = T.StructType(
        [
            T.StructField("place", T.BooleanType()),
            T.StructField("key", T.LongType()),
            T.StructField("raw", T.BinaryType()),
        ]
    )
    turn = 0
    while True:
        spans = (
            repeated_places(docs, turn, size, rules)
            .groupBy(F.col("doc_id").alias(of_id), F.col("mark").alias(of_text))
            .agg(F.collect_set(span).alias(spans_of))
        )
        marked = stage(docs.join(spans, of_row, "left").drop(of_id, of_text), "marked")
        collided = (
            marked.where(F.col(spans_of).isNotNull())
            .select("text", spans_of)
            .mapInArrow(_proof(turn, size, to_arrow_schema(proof)), proof)
            .groupBy("place", "key")
            .agg(F.min("raw").alias("low"), F.max("raw").alias("high"))
            .where("low != high")
        )
        if collided.isEmpty():
            break
        turn, size = turn + 1, 8
    out = T.StructType([*docs.schema.fields, *[T.StructField(x, T.LongType()) for x in names]])
    at = docs.schema.names.index("text")
    return marked.mapInArrow(_cut(to_arrow_schema(out), at), out)


#: The same rows for a table whose doc_ids differ: neighbouring lines looked up in all before.
SQL = """
WITH texts AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS raw FROM documents WHERE text <> ''
), split AS (
    SELECT doc_id, unnest(raw) AS line, generate_subscripts(raw, 1) AS k FROM texts
), pairs AS (
    SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY k) AS next FROM split
), found AS (
    SELECT *, next IS NOT NULL
        AND row_number() OVER (PARTITION BY line, next ORDER BY doc_id NULLS FIRST, k) > 1 AS again
    FROM pairs
), marked AS (
    SELECT *, again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY k), false) AS gone
    FROM found
), cut AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
        string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone) AS kept
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed,
    sha256(CASE WHEN c.n_removed > 0 THEN coalesce(c.kept, '') ELSE d.text END) AS kept_sha256
FROM documents d LEFT JOIN cut c ON d.doc_id IS NOT DISTINCT FROM c.doc_id
"""
