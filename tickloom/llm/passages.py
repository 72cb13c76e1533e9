"""Passages of over 50 words that another row holds too, word for word.

Windows of ``WORDS`` words are found as :mod:`.repeats` finds windows of bytes: the anchor of a
window is its run of ``NEAR`` words of least hash, neighbouring windows with one anchor form a
segment, and only segments at equal anchors can share windows. Anchors of one row alone and
equal segments are settled by counting; the windows of the distinct segments that are left are
counted one by one. Words, segments and windows are told apart by 64-bit hashes, segments and
windows together with that of their anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import parts, stage

WORDS = 51
NEAR = 8
#: Bytes of texts whose words are hashed together.
AT_ONCE = 1 << 20
_PLACES = np.uint64((1 << 24) - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_BYTES = np.random.default_rng(51).integers(1 << 63, size=256, dtype=np.uint64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _ODD[0]
    return h ^ (h >> np.uint64(32))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each word."""
    raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    solid = ~_BLANK[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], solid.view(np.int8), [0]])))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    first = np.cumsum(lengths) - lengths
    power = np.full(int(lengths.max()), _ODD[0])
    power[0] = 1
    power = np.cumprod(power)
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    h = np.add.reduceat(_BYTES[raw[solid]] * power[place], first)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return _mixed(h + lengths.astype(np.uint64) * _ODD[1]), np.searchsorted(ends, starts, side="right")


def _runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``NEAR`` (8) and of the ``WORDS`` (51 = 32 + 16 + 2 + 1) words at each place."""
    sums, width = {1: words}, 1
    for odd in _ODD:
        sums[2 * width] = sums[width][:-width] * odd + sums[width][width:]
        width *= 2
    h, width = sums[32], 32
    for more, odd in zip((16, 2, 1), _ODD, strict=False):
        n = len(words) - width - more + 1
        h = h[:n] * odd + sums[more][width : width + n]
        width += more
    return _mixed(sums[NEAR]), _mixed(h)


def _groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Texts that can have a window, about ``AT_ONCE`` bytes together."""
    group, size = [], 0
    for k, text in enumerate(texts):
        if len(text) < 2 * WORDS - 1:
            continue
        if group and size + len(text) > AT_ONCE:
            yield group
            group, size = [], 0
        group.append(k)
        size += len(text)
    if group:
        yield group


def word_segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of text, first window, last window, anchor's hash and segment's hash."""
    for group in _groups(texts):
        words, owner = _words([texts[k] for k in group])
        if len(words) < WORDS:
            continue
        near, windows = _runs(words)
        begins = np.searchsorted(owner, np.arange(len(group)))
        for piece in range(0, len(windows), 1 << 23):  # places below fit 24 bits
            stop = min(piece + (1 << 23), len(windows))
            here = near[piece : stop + WORDS - NEAR]
            place = np.arange(len(here), dtype=np.uint64)
            low, width = (here & ~_PLACES) | (_PLACES - place), 1
            while width * 2 <= WORDS - NEAR + 1:
                low = np.minimum(low[:-width], low[width:])
                width *= 2
            rest = WORDS - NEAR + 1 - width
            low = np.minimum(low[:-rest], low[rest:])
            anchor = (_PLACES - (low & _PLACES)).astype(np.int64) + piece
            window = np.arange(piece, stop)
            valid = owner[window] == owner[window + WORDS - 1]
            change = np.ones(len(window) + 1, dtype=bool)
            change[1:-1] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
            change[1:-1] |= owner[window[1:]] != owner[window[:-1]]
            edges = np.flatnonzero(change)
            keep = valid[edges[:-1]]
            first, last = edges[:-1][keep], edges[1:][keep] - 1
            at, to = window[first], window[last]
            # The first and the last window overlap, so they tell the segment.
            whole = _mixed(windows[at] * _ODD[2] + windows[to] * _ODD[3] + (to - at).astype(np.uint64))
            own = owner[at]
            yield (
                np.asarray(group)[own],
                at - begins[own],
                to - begins[own],
                near[anchor[first]].view(np.int64),
                whole.view(np.int64),
            )


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _find(schema: pa.Schema):
    """doc_id, mark, row, first, last, gram, whole of every segment."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            for text, *rest in word_segments(_texts(batch)):
                take = pa.array(text)
                head = [batch.column(c).take(take) for c in ("doc_id", "mark", "row")]
                yield pa.RecordBatch.from_arrays([*head, *(pa.array(x) for x in rest)], schema=schema)

    return apply


def _expand(schema: pa.Schema):
    """gram, whole, low, high, at and h of every window of the segments named next to each text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            named = batch.column("wanted").to_pylist()
            for text, wanted in zip(_texts(batch), named, strict=True):
                windows = _runs(_words([text])[0])[1].view(np.int64)
                first = np.array([x["first"] for x in wanted])
                n = np.array([x["last"] for x in wanted]) - first + 1
                at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                kept = [np.repeat([x[c] for x in wanted], n) for c in ("gram", "whole", "low", "high")]
                rows = [*kept, at, windows[np.repeat(first, n) + at]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], schema=schema)

    return apply


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


def shared(docs: DataFrame) -> DataFrame:
    """doc_id, mark, first and mask of the segments that share windows with another row.

    Needs doc_id, text and mark (a hash of both). ``first`` is the place of the segment's first
    window in words, bit k of ``mask`` says whether another row holds the window k words later.
    """
    id_field = docs.schema["doc_id"]
    numbered = docs.select("doc_id", "text", "mark", F.monotonically_increasing_id().alias("row"))
    found = T.StructType([id_field, *_longs("mark", "row", "first", "last", "gram", "whole")])
    found = stage(numbered.mapInArrow(_find(to_arrow_schema(found)), found), "word_segments")
    anchors = found.groupBy("gram").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    anchors = stage(anchors.where("low <> high").select("gram"), "word_anchors")
    met = stage(found.join(anchors, "gram"), "word_met")
    kinds = met.groupBy("gram", "whole").agg(
        F.min("row").alias("low"),
        F.max("row").alias("high"),
        F.min(F.struct("mark", "first", "last", F.col("doc_id").alias("id"))).alias("one"),
    )
    kinds = stage(kinds, "word_kinds")
    # Segments of several rows are shared as a whole, those of one row perhaps in some windows:
    # only anchors with such ones need their windows, each distinct segment's once.
    single = stage(kinds.where("low = high").select("gram").distinct(), "word_single")
    places = (
        kinds.join(single, "gram", "left_semi")
        .select("gram", "whole", "low", "high", "one.*")
        .groupBy(F.col("mark").alias("at"), "id")
        .agg(F.collect_list(F.struct("first", "last", "gram", "whole", "low", "high")).alias("wanted"))
    )
    windows = T.StructType(_longs("gram", "whole", "low", "high", "at", "h"))
    # Rows with equal ids and texts bring a window several times, which changes no minimum or mask.
    windows = stage(
        docs.join(places, (docs["mark"] == places["at"]) & docs["doc_id"].eqNullSafe(places["id"]))
        .select("text", "wanted")
        .mapInArrow(_expand(to_arrow_schema(windows)), windows),
        "word_windows",
    )
    several = windows.groupBy("gram", "h").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    several = stage(several.where("low <> high").select("gram", "h"), "word_several")
    some = (
        windows.where("low = high")
        .join(several, ["gram", "h"])
        .groupBy("gram", "whole")
        .agg(F.bit_or(F.expr("shiftleft(1L, int(at))")).alias("mask"))
    )
    whole = kinds.where("low <> high").select("gram", "whole", F.lit(None).cast("long").alias("mask"))
    # Written first: both sides of the join are plain shuffles, and a hot segment can be split.
    told = stage(whole.unionByName(some), "word_told")
    every = F.expr("shiftleft(1L, int(last - first + 1)) - 1")
    told = met.join(told, ["gram", "whole"]).select(
        "doc_id", "mark", "first", F.coalesce("mask", every).alias("mask")
    )
    return stage(told.distinct(), "word_shared")


def covered(segments: list[dict]) -> int:
    """Words that the shared windows of a text cover."""
    total, end = 0, 0
    for first, mask in sorted((s["first"], s["mask"]) for s in segments):
        while mask:
            low = (mask & -mask).bit_length() - 1
            run = ((mask >> low) + 1 & -((mask >> low) + 1)).bit_length() - 1
            begin, stop = first + low, first + low + run - 1 + WORDS
            total += max(0, stop - max(begin, end))
            end = max(end, stop)
            mask &= ~(((1 << run) - 1) << low)
    return total
