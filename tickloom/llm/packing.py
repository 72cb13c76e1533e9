"""Best-fit packing of token sequences with a swap-based local search.

Texts are tokenised in Arrow batches (a tokenizer has no SQL form), cut into pieces and
written once. Full pieces are sequences of their own. The others are dealt at random into
groups of about ``GROUP`` pieces, as many groups as the input needs, and each group is
packed in a task of its own, so memory is bounded and no key can become hot.

A group starts from best fit in falling length. Then documents are moved, or exchanged
one for one or two for one, between underfull bins wherever that raises the sum of
squared fills: fuller bins fill up, the emptiest run empty and are closed. The search
ends when the number of bins is the least possible or no exchange helps; a bin that found
none is tried again only with bins that changed since. At most one bin a group is lost against packing all pieces at once.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import parts, ship, stage

CAPACITY = 2048
GROUP = 8192
#: Words, and pieces of words, of which a worker keeps the ids; the first ones it meets hold
#: the frequent ones.
CACHED_WORDS = 800_000
#: Texts tokenised together.
AT_ONCE = 1000
#: What the tokenizer's pre-tokenizer makes of a lower-cased word of visible ASCII characters.
PIECE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Words that aren't cut here: other characters, and what might be a special token.
WHOLE = re.compile(rb"[^\x21-\x7E]|<\|")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(1)
def _encoder(path: str):
    """Tokenizer and the ids of words and of pieces seen so far, kept while the worker lives."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), {}, {}


def _lookup(keys: list[bytes], known: dict[bytes, bytes], find: Callable) -> list[bytes]:
    """What is known of distinct keys; ``find`` is asked for the others, all at once."""
    found = [known.get(k) for k in keys]
    at = [i for i, ids in enumerate(found) if ids is None]
    new = [keys[i] for i in at]
    fresh = find(new) if new else []
    for i, ids in zip(at, fresh, strict=True):
        found[i] = ids
    if len(known) < CACHED_WORDS:
        known.update(zip(new, fresh, strict=True))
    return found


def _word_ids(words: list[bytes], path: str) -> list[bytes]:
    """Ids of distinct words.

    The tokenizer's merges stay inside a piece of its pre-tokenizer, so the ids of a word are
    those of its pieces in a row, and fewer pieces than words differ.
    """
    tokenizer, known, known_pieces = _encoder(path)

    def tokenise(new: list[bytes]) -> list[bytes]:
        encoded = tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def by_pieces(new: list[bytes]) -> list[bytes]:
        cut = [[w] if WHOLE.search(w) else PIECE.findall(w.lower()) for w in new]
        pieces = list(dict.fromkeys(chain.from_iterable(cut)))
        ids = dict(zip(pieces, _lookup(pieces, known_pieces, tokenise), strict=True))
        return [b"".join(map(ids.__getitem__, c)) for c in cut]

    return _lookup(words, known, by_pieces)


def encode(texts: list[str | None] | pa.Array, path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers, without special tokens.

    The tokenizer never joins across white space, so the ids of a text are those of its
    words in a row, and most words were met before. Arrow splits the texts and numbers the
    distinct words; ids are then gathered by these numbers.
    """
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    out = []
    for k in range(0, len(texts), AT_ONCE):
        split = pc.ascii_split_whitespace(pc.fill_null(texts[k : k + AT_ONCE], ""))
        words = split.flatten().dictionary_encode()
        known = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        known = _word_ids(known, path)
        ids = np.frombuffer(b"".join(known), dtype="<u4")
        length = np.fromiter(map(len, known), np.int64, len(known)) // 4
        start = np.cumsum(length) - length
        at = words.indices.to_numpy()
        start, length = start[at], length[at]
        ends = np.concatenate([[0], np.cumsum(length)])
        ids = ids[np.repeat(start - ends[:-1], length) + np.arange(ends[-1])].tobytes()
        edges = (4 * ends[np.cumsum([0, *pc.list_value_length(split).to_pylist()])]).tolist()
        out += [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return out


def _pieces(path: str, capacity: int, schema: pa.Schema):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, AT_ONCE):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encode(batch.column(1), path)):
                ids += b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), capacity * 4)):
                    part = ids[at : at + capacity * 4]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                schema=schema,
            )

    return cut


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit in falling length: each item into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r is set if some bin has room for exactly r
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        if room > need:
            by_room[room - need].append(at)
            rooms |= 1 << (room - need)
    return bins


class _Search:
    """Exchanges between bins; ``bins`` and ``fill`` are changed in place.

    Items are held flat with the room of their bin, so a step is a few passes over arrays.
    What comes back from a partner (nothing, an item, two items) of size s from a bin with
    room r can answer anything of a size up to s + r that leaves the emptier bin.
    """

    def __init__(self, bins: list[list[int]], fill: np.ndarray, lengths: np.ndarray, capacity: int):
        self.bins, self.fill, self.lengths, self.capacity = bins, fill, lengths, capacity
        self.owner = np.zeros(len(lengths), dtype=np.int64)
        for b, items in enumerate(bins):
            self.owner[items] = b
        self.room = capacity - fill[self.owner]
        self.clock = 0
        self.changed = np.zeros(len(bins), dtype=np.int64)  # when a bin changed last

    def step(self, low: int, since: int = -1) -> bool:
        """The best step that moves fill out of bin ``low`` into an at least as full bin that
        changed after ``since``."""
        fill, owner, capacity = self.fill, self.owner, self.capacity
        partner = (fill < capacity) & (fill >= fill[low]) & (self.changed > since)
        partner[low] = False
        others = np.flatnonzero(partner)
        if not len(others):
            return False
        room = capacity - fill[others]
        mine = sorted(self.bins[low], key=lambda i: -self.lengths[i])
        for item in mine:  # move
            fits = np.flatnonzero(room >= self.lengths[item])
            if len(fits):
                return self._do(low, [item], [], int(others[fits[np.argmin(room[fits])]]))
        items = np.flatnonzero(partner[owner])
        outs = {int(self.lengths[i]): [i] for i in mine}
        for k, a in enumerate(mine):
            for b in mine[k + 1 :]:
                outs.setdefault(int(self.lengths[a] + self.lengths[b]), [a, b])
        if best := self._best(list(outs), self.lengths[items], self.room[items]):
            out, k = best  # one or two of this bin for one of another
            return self._do(low, outs[out], [int(items[k])], int(owner[items[k]]))
        items = items[np.argsort(owner[items], kind="stable")]
        one, two = [items[:0]], [items[:0]]
        for lag in range(1, len(items)):
            same = owner[items[lag:]] == owner[items[:-lag]]
            if not same.any():
                break
            one.append(items[:-lag][same])
            two.append(items[lag:][same])
        one, two = np.concatenate(one), np.concatenate(two)
        outs = {int(self.lengths[i]): [i] for i in mine}
        if best := self._best(list(outs), self.lengths[one] + self.lengths[two], self.room[one]):
            out, k = best  # one for two
            return self._do(low, outs[out], [int(one[k]), int(two[k])], int(owner[one[k]]))
        return False

    def _best(self, outs: list[int], size: np.ndarray, room: np.ndarray) -> tuple[int, int] | None:
        """The size that leaves and the place of what comes back for the greatest gain."""
        useful = np.flatnonzero(size < max(outs))
        if not len(useful):
            return None
        reach = np.zeros(self.capacity + 1, dtype=np.int64)
        np.maximum.at(reach, size[useful], size[useful] + room[useful])
        back = np.searchsorted(np.maximum.accumulate(reach), outs)  # least size that may answer
        gain, out, size_back = max((o - b, o, b) for o, b in zip(outs, back.tolist(), strict=True))
        if gain <= 0:
            return None
        fits = np.flatnonzero((size == size_back) & (size + room >= out))
        return out, int(fits[np.argmin(room[fits])])

    def _do(self, low: int, out: list[int], back: list[int], to: int) -> bool:
        gain = int(self.lengths[out].sum() - self.lengths[back].sum())
        self.bins[low] = [i for i in self.bins[low] if i not in out] + back
        self.bins[to] = [i for i in self.bins[to] if i not in back] + out
        self.owner[out], self.owner[back] = to, low
        self.fill[low] -= gain
        self.fill[to] += gain
        self.clock += 1
        for b in (low, to):
            self.room[self.bins[b]] = self.capacity - self.fill[b]
            self.changed[b] = self.clock
        return True


def _exchange(bins: list[list[int]], fill: np.ndarray, low: int, lengths, capacity: int) -> bool:
    """One step out of bin ``low``."""
    return _Search(bins, fill, lengths, capacity).step(low)


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Items of each bin; ``lengths`` are from 1 to ``capacity``."""
    lengths = np.asarray(lengths, dtype=np.int64)
    bins = best_fit(lengths, capacity)
    fill = np.array([lengths[b].sum() for b in bins], dtype=np.int64)
    least = -(-int(lengths.sum()) // capacity)
    used, search = len(bins), _Search(bins, fill, lengths, capacity)
    stuck = np.full(len(bins), -1, dtype=np.int64)  # when no step out of a bin was left
    before = -1
    while used > least and search.clock > before:
        before = search.clock
        for low in np.argsort(fill, kind="stable").tolist():
            since = int(stuck[low])
            while used > least and 0 < fill[low] < capacity and search.step(low, since):
                used -= not bins[low]
                since = -1
            stuck[low] = search.clock
    return [b for b in bins if b]


def _pack_group(capacity: int):
    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("slot", ignore_index=True)
        lengths = group["length"].to_numpy()
        sequence = np.zeros(len(group), dtype=np.int64)
        offset = np.zeros(len(group), dtype=np.int64)
        for number, items in enumerate(pack(lengths, capacity)):
            sequence[items] = number
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
        first = int(group["part"].iloc[0]) << 24
        group["sequence_id"] = (first + sequence) * 2 + 1
        group["offset"] = offset
        return group.drop(columns=["slot", "part"])

    return place


def pack_documents(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, group: int = GROUP
) -> DataFrame:
    """One row per piece of every row of ``docs`` (doc_id, text; others are ignored).

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset. A null or
    empty text is the closing id 0 alone. Rows with equal or null ids are packed like any
    other; an empty table gives no rows. Only documents longer than ``capacity`` are cut.
    """
    ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    pieces = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    cut = docs.select("doc_id", "text").mapInArrow(
        _pieces(path or vocabulary_path(), capacity, to_arrow_schema(pieces)), pieces
    )
    cut = stage(cut.withColumn("slot", F.monotonically_increasing_id()), "pieces")
    full = cut.where(F.col("length") == capacity)
    rest = cut.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group))
    placed = T.StructType(
        [
            *pieces.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    packed = (
        rest.withColumn("part", F.pmod(F.xxhash64("slot"), F.lit(groups)))
        .groupBy("part")
        .applyInPandas(_pack_group(capacity), placed)
    )
    alone = full.select(
        *pieces.names,
        (F.col("slot") * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return alone.unionByName(packed)
