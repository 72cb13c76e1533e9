"""Removal of repeated byte strings with a column-wise multi-document BWT and common prefixes.

Every byte that a ``LENGTH``-byte string covers goes if that string also starts anywhere else.
Inserting one symbol of every document a round, as a whole-collection construction does, costs
rounds times collection; it is affordable here because the collection is first cut, exactly,
into short pieces that already stand under each other:

1. The anchor of a window of ``LENGTH`` bytes is its ``GRAM``-byte string of least hash (the
   last of equals). Equal windows have equal anchors at equal offsets, so neighbouring windows
   with one anchor form a segment, and only segments at equal anchors can share windows.
2. Anchors that occur once have no repeated window. Where all segments at an anchor are equal
   (copies), all their windows repeat. Both are counts with a map-side combine.
3. The distinct segments at any other anchor are aligned at it and sorted column by column
   from the right: each round inserts one symbol of each segment, reads it from a file in the
   order of the rounds, and updates the order (the collection BWT is the column read in that
   order) and the common prefixes of neighbours. A window repeats if the common prefix with a
   neighbour reaches ``LENGTH``.
4. An anchor with more than ``HOT`` distinct segments is split: each segment into runs of
   ``STEPS[k]`` windows, told apart by the bytes that all windows of a run contain; runs are
   counted as in 2 and sorted as in 3, and runs that are still hot are split into single
   windows, for which counting alone decides.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import passages
from .common import parts, ship, stage

LENGTH = 400
GRAM = 32
#: Bytes of texts whose anchors are found together.
AT_ONCE = 1 << 20
#: Distinct segments at one anchor that are sorted in one task at most.
HOT = 1000
#: Windows of a run at each level of splitting.
STEPS = (24, 1)
#: Segments of a task, about.
UNIT = 6000
_PLACES = np.uint64((1 << 24) - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_BYTES = np.random.default_rng(32).integers(1 << 63, size=256, dtype=np.uint64)


def _grams(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at each place; GRAM is 32 here: five doublings."""
    h, width = _BYTES[raw], 1
    for odd in _ODD:
        h = h[:-width] * odd + h[width:]
        width *= 2
    h ^= h >> np.uint64(29)
    h *= _ODD[0]
    h ^= h >> np.uint64(32)
    return h


def segments(texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, first window, last window, anchor, anchor's hash) of all segments of the texts.

    Places are within the text. Texts shorter than ``LENGTH`` have none.
    """
    long = [k for k, t in enumerate(texts) if len(t) >= LENGTH]
    start = 0
    while start < len(long):
        end, size = start, 0
        while end < len(long) and (end == start or size + len(texts[long[end]]) <= AT_ONCE):
            size += len(texts[long[end]])
            end += 1
        part, start = long[start:end], end
        lengths = np.array([len(texts[k]) for k in part])
        begins = np.cumsum(lengths) - lengths
        g = _grams(np.frombuffer(b"".join(texts[k] for k in part), dtype=np.uint8))
        for piece in range(0, size - LENGTH + 1, 1 << 23):  # places below fit 24 bits
            stop = min(piece + (1 << 23), size - LENGTH + 1)
            here = g[piece : stop + LENGTH - GRAM]
            place = np.arange(len(here), dtype=np.uint64)
            low = (here & ~_PLACES) | (_PLACES - place)
            width = 1
            while width * 2 <= LENGTH - GRAM + 1:
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            rest = LENGTH - GRAM + 1 - width
            if rest:
                low = np.minimum(low[:-rest], low[rest:])
            anchor = (_PLACES - (low & _PLACES)).astype(np.int64) + piece
            window = np.arange(piece, stop)
            owner = np.searchsorted(begins, window, side="right") - 1
            valid = window + LENGTH <= begins[owner] + lengths[owner]
            change = np.ones(len(window) + 1, dtype=bool)
            change[1:-1] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
            change[1:-1] |= owner[1:] != owner[:-1]
            edges = np.flatnonzero(change)
            first, last = edges[:-1], edges[1:] - 1
            first, last = first[valid[first]], last[valid[first]]
            own = owner[first]
            at = begins[own]
            p = anchor[first]
            yield from zip(
                [part[k] for k in own.tolist()],
                (window[first] - at).tolist(),
                (window[last] - at).tolist(),
                (p - at).tolist(),
                g[p].view(np.int64).tolist(),
                strict=True,
            )


def _digest(raw: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(raw, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]


def _find(schema: pa.Schema):
    """doc_id, mark, first, last, off (anchor behind first), gram, h1, h2 of every segment."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts = _texts(batch)
            rows: list[list] = [[] for _ in range(7)]
            for k, first, last, anchor, gram in segments(texts):
                h1, h2 = _digest(texts[k][first : last + LENGTH])
                row = (k, first, last, anchor - first, gram, h1, h2)
                for column, x in zip(rows, row, strict=True):
                    column.append(x)
            row = pa.array(rows[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    batch.column(2).take(row),
                    *(pa.array(x, pa.int64()) for x in rows[1:]),
                ],
                schema=schema,
            )

    return apply


def _fetch(schema: pa.Schema):
    """key (the anchor's hash), h1, h2, off and raw of the segments named next to each text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows: list[list] = [[] for _ in range(5)]
            for text, wanted in zip(_texts(batch), batch.column(2).to_pylist(), strict=True):
                for x in wanted:
                    raw = text[x["first"] : x["last"] + LENGTH]
                    row = (x["gram"], x["h1"], x["h2"], x["off"], raw)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in rows[:4]), pa.array(rows[4], pa.binary())],
                schema=schema,
            )

    return apply


def repeated_windows(raws: list[bytes], offs: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Which windows of aligned strings repeat within their group.

    ``offs`` is the place of the anchor in each string, ``groups`` is sorted. Row i, column o
    of the result: the window that starts o bytes before the anchor of string i.
    """
    left = LENGTH - GRAM
    n, width = len(raws), left + LENGTH
    symbols = np.full((n, width), 256, dtype=np.uint16)
    for k, raw in enumerate(raws):
        at = left - int(offs[k])
        symbols[k, at : at + len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    hits = np.zeros((n, left + 1), dtype=bool)
    order, common = np.arange(n), np.zeros(n + 1, dtype=np.int64)
    group = np.asarray(groups, dtype=np.int64)
    with tempfile.TemporaryFile() as columns:
        columns.write(np.ascontiguousarray(symbols.T[::-1]).tobytes())
        del symbols
        columns.seek(0)
        for column in range(width - 1, -1, -1):
            symbol = np.frombuffer(columns.read(2 * n), dtype=np.uint16)[order]
            key = group[order] * 512 + symbol
            moved = np.argsort(key, kind="stable")
            key = key[moved]
            same = np.flatnonzero((key[1:] == key[:-1]) & (key[1:] & 511 != 256)) + 1
            fresh = np.zeros(n + 1, dtype=np.int64)
            if len(same):
                spans = np.stack([moved[same - 1] + 1, moved[same] + 1], 1).ravel()
                fresh[same] = np.minimum.reduceat(common, spans)[::2] + 1
            order, common = order[moved], fresh
            if column <= left:
                reach = np.maximum(common[:-1], common[1:]) >= LENGTH
                hits[order[reach], left - column] = True
    return hits


def _ranges(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _sort(group: pd.DataFrame) -> pd.DataFrame:
    """h1, h2 and ranges (low, high) of offsets whose windows repeat."""
    group = group.drop_duplicates(["key", "h1", "h2"]).sort_values(
        ["key", "h1", "h2"], ignore_index=True
    )
    codes = np.unique(group["key"].to_numpy(), return_inverse=True)[1]
    hits = repeated_windows(group["raw"].tolist(), group["off"].to_numpy(), codes)
    rows = [
        (h1, h2, low, high)
        for h1, h2, hit in zip(group["h1"], group["h2"], hits, strict=True)
        if hit.any()
        for low, high in _ranges(hit)
    ]
    return pd.DataFrame(rows, columns=["h1", "h2", "low", "high"]).astype("int64")


def _split(step: int, schema: pa.Schema):
    """Runs of ``step`` windows: key (hash of the bytes they share), h1, h2, off, raw, low, high
    and the segment (p1, p2) they come from."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rows: list[list] = [[] for _ in range(9)]
            for p1, p2, off, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                least = off - (len(raw) - LENGTH)  # offsets run from the last window's
                for run in range(least // step, off // step + 1):
                    low, high = max(least, run * step), min(off, run * step + step - 1)
                    part = raw[off - high : off - low + LENGTH]
                    at = off - run * step
                    core = _digest(raw[at : at - step + 1 + LENGTH])[0] ^ run
                    h1, h2 = _digest(part)
                    for column, x in zip(
                        rows, (core, h1, h2, high, low, high, p1, p2, part), strict=True
                    ):
                        column.append(x)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in rows[:8]), pa.array(rows[8], pa.binary())],
                schema=schema,
            )

    return apply


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


def _resolve(distinct: DataFrame, level: int = 0) -> DataFrame:
    """h1, h2, low, high: repeated windows of the distinct segments (key, h1, h2, off, raw)."""
    sizes = distinct.groupBy("key").count()
    busy = sizes.where(F.col("count") > HOT).select("key")
    calm = distinct.join(busy, "key", "left_anti")
    units = max(1, -(-distinct.count() // UNIT))
    ranges = T.StructType(_longs("h1", "h2", "low", "high"))
    found = (
        calm.withColumn("unit", F.pmod(F.xxhash64("key"), F.lit(units)))
        .groupBy("unit")
        .applyInPandas(_sort, ranges)
    )
    busy = stage(busy, "hot")
    if busy.isEmpty():
        return found
    schema = T.StructType(
        [
            *_longs("key", "h1", "h2", "off", "low", "high", "p1", "p2"),
            T.StructField("raw", T.BinaryType()),
        ]
    )
    hot = distinct.join(busy, "key").select("h1", "h2", "off", "raw")
    runs = stage(hot.mapInArrow(_split(STEPS[level], to_arrow_schema(schema)), schema), "runs")
    counted = runs.groupBy("key", "h1", "h2").agg(F.count("*").alias("n"))
    keys = counted.groupBy("key").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
    counted = stage(counted.join(keys.where("all > 1"), "key"), "counted")
    twice = runs.join(counted.where("n > 1").select("key", "h1", "h2"), ["key", "h1", "h2"])
    twice = twice.select(F.col("p1").alias("h1"), F.col("p2").alias("h2"), "low", "high")
    if STEPS[level] == 1:
        return found.unionByName(twice)
    unsure = runs.join(
        counted.where("kinds > 1").select("key", "h1", "h2", "n"), ["key", "h1", "h2"]
    )
    pieces = stage(
        unsure.groupBy("key", "h1", "h2")
        .agg(*[F.first(c).alias(c) for c in ("off", "raw", "n", "p1", "p2")]),
        "pieces",
    )
    deeper = _resolve(pieces.select("key", "h1", "h2", "off", "raw"), level + 1)
    deeper = deeper.join(
        pieces.where("n = 1").select("h1", "h2", "p1", "p2"), ["h1", "h2"]
    ).select(F.col("p1").alias("h1"), F.col("p2").alias("h2"), "low", "high")
    return found.unionByName(twice).unionByName(deeper)


def _remove(schema: pa.Schema):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts, gone, shared = _texts(batch), *(batch.column(k).to_pylist() for k in (2, 3))
            rows: list[list] = [[] for _ in range(6)]
            for text, spans, segments in zip(texts, gone, shared, strict=True):
                kept, removed, at, runs = [], 0, 0, []
                for span in sorted((s["first"], s["last"] + LENGTH) for s in spans or []):
                    if runs and span[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], span[1])
                    else:
                        runs.append([*span])
                for first, end in runs:
                    kept.append(text[at:first])
                    removed += end - first
                    at = end
                kept = b"".join([*kept, text[at:]])
                digest, words = hashlib.sha256(kept).hexdigest(), passages.covered(segments or [])
                values = (len(text), removed, len(runs), digest, kept, words)
                for column, x in zip(rows, values, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(x, pa.int64()) for x in rows[:3]),
                    pa.array(rows[3], pa.string()),
                    pa.array(rows[4], pa.binary()),
                    pa.array(rows[5], pa.int64()),
                ],
                schema=schema,
            )

    return apply


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes) and n_shared_words of every row.

    Needs doc_id and text; other columns are ignored. A null text is empty, a text shorter
    than ``LENGTH`` stays whole. Every row is a document of its own: rows with equal or null
    ids, and equal rows, repeat one another's strings. Cutting may split a character, so what
    is kept are bytes. An empty table gives no rows.

    ``n_shared_words`` counts the words of the text in passages of over 50 words that another row
    holds too, word for word, whatever their bytes; they are told, not removed.
    """
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"))
    id_field = docs.schema["doc_id"]
    # First, so that its shuffles are gone when those of the texts come.
    shared = passages.shared(docs)
    found = T.StructType([id_field, *_longs("mark", "first", "last", "off", "gram", "h1", "h2")])
    found = stage(docs.mapInArrow(_find(to_arrow_schema(found)), found), "segments")
    by_anchor = (
        found.groupBy("gram")
        .agg(
            F.count("*").alias("n"),
            *[f(h).alias(f"{k}_{h}") for h in ("h1", "h2") for k, f in (("lo", F.min), ("hi", F.max))],
        )
        .where("n > 1")
        .select("gram", F.expr("lo_h1 = hi_h1 AND lo_h2 = hi_h2").alias("copies"))
    )
    # Written first: both sides of the join are plain shuffles, and a hot anchor can be split.
    met = stage(found.join(stage(by_anchor, "anchors"), "gram"), "met")
    copies = met.where("copies").select("doc_id", "mark", "first", "last")
    kinds = (
        met.where("NOT copies")
        .groupBy("gram", "h1", "h2")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct("mark", "first", "last", "off", F.col("doc_id").alias("id"))).alias("one"),
        )
    )
    kinds = stage(kinds, "kinds")
    # One place per kind, gathered per document: only these bytes move, at any size.
    places = (
        kinds.select("gram", "h1", "h2", "one.*")
        .groupBy(F.col("mark").alias("at"), "id")
        .agg(F.collect_list(F.struct("first", "last", "off", "gram", "h1", "h2")).alias("wanted"))
    )
    raw = T.StructType([*_longs("key", "h1", "h2", "off"), T.StructField("raw", T.BinaryType())])
    fetched = (
        docs.join(places, (docs["mark"] == places["at"]) & docs["doc_id"].eqNullSafe(places["id"]))
        .select("doc_id", "text", "wanted")
        .mapInArrow(_fetch(to_arrow_schema(raw)), raw)
        .groupBy("key", "h1", "h2")
    )
    # Rows with equal ids and texts bring a kind several times.
    distinct = stage(fetched.agg(F.first("off").alias("off"), F.first("raw").alias("raw")), "distinct")
    partly = stage(_resolve(distinct), "partly")
    # copies repeat whole, whatever else they meet
    whole = kinds.where("n > 1").select("gram", "h1", "h2")
    whole = met.where("NOT copies").join(whole, ["gram", "h1", "h2"])
    whole = whole.select("doc_id", "mark", "first", "last")
    # a segment that occurs once: offset o before its anchor is window first + off - o
    once = met.where("NOT copies").join(
        kinds.where("n = 1").select("gram", "h1", "h2"), ["gram", "h1", "h2"]
    )
    once = (
        once.join(partly, ["h1", "h2"])
        .select(
            "doc_id",
            "mark",
            (F.col("first") + F.col("off") - F.col("high")).alias("start"),
            (F.col("first") + F.col("off") - F.col("low")).alias("last"),
        )
        .withColumnRenamed("start", "first")
    )
    gone = (
        copies.unionByName(whole)
        .unionByName(once)
        .distinct()
        .unionByName(shared, allowMissingColumns=True)
        .groupBy("mark", F.col("doc_id").alias("id"))
        .agg(
            F.collect_list(F.when(F.col("mask").isNull(), F.struct("first", "last"))).alias("gone"),
            F.collect_list(F.when(F.col("mask").isNotNull(), F.struct("first", "mask"))).alias("shared"),
        )
    )
    out = T.StructType(
        [
            id_field,
            *_longs("n_bytes", "n_removed", "n_spans"),
            T.StructField("kept_sha256", T.StringType()),
            T.StructField("kept", T.BinaryType()),
            *_longs("n_shared_words"),
        ]
    )
    cut = docs.join(
        gone, (docs["mark"] == gone["mark"]) & docs["doc_id"].eqNullSafe(gone["id"]), "left"
    ).select("doc_id", "text", "gone", "shared")
    return cut.mapInArrow(_remove(to_arrow_schema(out)), out)
