"""N-gram Jaccard self-join with count vectors in an R-tree.

A document is its set of hashed shingles. ``GROUPS`` groups of hashes give it a point, the
number of its shingles in each group. Two sets share at most the sum of the lesser coordinates,
and a box of points bounds all sets inside it by its greatest corner, so a tree of boxes
prunes pairs that can't reach the overlap that the similarity asks for.

How the join is spread, with no pair lost:
1. Equal sets are grouped first (a hot text is one row from here on).
2. Shingles get one order everywhere: frequent ones last (a fixed-size table of counts over
   all documents says which), then by hash. Linked sets share a shingle within their first
   n - ceil(share n / 100) + 1, so only documents that meet at such a shingle are compared.
3. Documents at one shingle are points of an R-tree; pairs that survive its bounds join
   documents into families (components of a superset of the links). A shingle of more than
   ``BLOCK`` documents is compared block against block.
4. A long set's groups are many-membered and differences cancel out, so families are narrowed
   with finer points first, about one group for ``FINE`` shingles, of a byte each.
5. Each narrowed family's sets come together, once for each pair of its blocks, so each pair in
   one unit only, and every pair that survives the tree is verified on the sets themselves.
6. Verified links give the components, and are counted for each set as they are found: the
   number of links may be quadratic in a family, what leaves a unit is a row for each set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import parts, ship, stage
from .components import components, least_ids

#: Words of a shingle, unless told otherwise.
WIDTH = 5
#: Linked sets share at least SHARE in 100 of their union, unless told otherwise.
SHARE = 80
GROUPS = 64
LEAF = 32
FINE = 8
BLOCK = 1024
#: Rows that a task of the comparison gets, about: (shingle, document), and sets.
UNIT, SETS = 10_000, 1000
#: Pairs that a task holds before it keeps only what they connect.
WAITING = 1 << 18
#: Shingles that the sets of a block hold together, about: 8 bytes each.
SET_SUM = 1 << 21
#: Shingles that families dealt to one unit hold together, on average: a unit may get several.
UNIT_SUM = 1 << 18
#: Counters of the table of shingle frequencies.
COUNTERS = 1 << 18
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; see ``join`` for short texts."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(len(h) - width + 1, 1)
    found = np.full(n, len(h) if len(h) < width else width, dtype=np.uint64)
    for k in range(min(width, len(h))):
        found = (found ^ h[k : k + n]) * (_A, _B, _C)[k % 3]
        found ^= found >> np.uint64(31)
    return np.unique(found)


def set_key(hashes: np.ndarray) -> bytes | None:
    """Names a set; null for an empty one."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def order_of(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Places of ``hashes`` in the common order: frequent ones last, then by hash."""
    late = frequent[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)]
    return np.argsort(late, kind="stable")  # hashes are sorted


def point(hashes: np.ndarray) -> bytes:
    """Shingles in each group: one byte each if they fit, else four."""
    counts = np.bincount((hashes >> np.uint64(58)).astype(np.int64), minlength=GROUPS)
    return counts.astype(np.uint8 if counts.max() < 256 else "<u4").tobytes()


def fine_point(hashes: np.ndarray) -> bytes:
    """Counts of a power of two of groups that nest: the width of a count, then the counts."""
    bits = max(6, (len(hashes) // FINE).bit_length())
    counts = np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    width = 1 if counts.max() < 256 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1).astype(np.int32)


def fold(counts: np.ndarray, groups: int) -> np.ndarray:
    """Counts of fewer groups."""
    return counts.reshape(groups, -1).sum(1)


def points(raw: list[bytes]) -> np.ndarray:
    out = np.empty((len(raw), GROUPS), dtype=np.int32)
    small = np.array([len(r) == GROUPS for r in raw], dtype=bool)
    if small.any():
        part = b"".join(r for r in raw if len(r) == GROUPS)
        out[small] = np.frombuffer(part, dtype=np.uint8).reshape(-1, GROUPS)
    if not small.all():
        part = b"".join(r for r in raw if len(r) != GROUPS)
        out[~small] = np.frombuffer(part, dtype="<u4").reshape(-1, GROUPS)
    return out


def may_reach(shared: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, share: int) -> np.ndarray:
    """Whether sets of such sizes that share so many shingles are similar enough."""
    return (100 + share) * shared >= share * (n_a + n_b)


_TRIANGLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def tree_pairs(
    at: np.ndarray, c: np.ndarray, n: np.ndarray, share: int, second: np.ndarray | None = None
):
    """Pairs of rows in ``at`` (or one of ``at``, one of ``second``) that the leaves let through.

    Leaves of ``LEAF`` points in order of size and of their fullest group; two leaves are
    opened against each other if the lesser of their greatest corners may reach the overlap
    that their smallest sets need.
    """
    if second is None and len(at) <= LEAF:
        if len(at) not in _TRIANGLES:
            _TRIANGLES[len(at)] = np.triu_indices(len(at), 1)
        a, b = _TRIANGLES[len(at)]
        return at[a], at[b]

    def leaves(rows: np.ndarray):
        rows = rows[np.lexsort((c[rows].argmax(1), n[rows]))]
        parts = np.array_split(rows, -(-len(rows) // LEAF))
        top = np.stack([c[p].max(0) for p in parts])
        return parts, top, np.array([n[p].min() for p in parts]), np.array([n[p].max() for p in parts])

    one = leaves(at)
    two = one if second is None else leaves(second)
    a, b = [at[:0]], [at[:0]]
    for k, part in enumerate(one[0]):
        low = k if second is None else 0
        bound = np.minimum(one[1][k], two[1][low:]).sum(1)
        open_ = may_reach(bound, one[2][k], two[2][low:], share)
        open_ &= 100 * one[3][k] >= share * two[2][low:]
        open_ &= 100 * two[3][low:] >= share * one[2][k]
        for other in (np.flatnonzero(open_) + low).tolist():
            rows = two[0][other]
            x, y = np.repeat(part, len(rows)), np.tile(rows, len(part))
            if second is None and other == k:
                x, y = part[np.triu_indices(len(part), 1)[0]], part[np.triu_indices(len(part), 1)[1]]
            a.append(x)
            b.append(y)
    return np.concatenate(a), np.concatenate(b)


def surviving(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray, share: int):
    """Of pairs of rows, those whose points may reach the overlap."""
    low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    near = 100 * low >= share * high
    a, b = a[near], b[near]
    keep = [np.zeros(0, dtype=bool)]
    for k in range(0, len(a), 50_000):
        x, y = a[k : k + 50_000], b[k : k + 50_000]
        keep.append(may_reach(np.minimum(c[x], c[y]).sum(1), n[x], n[y], share))
    keep = np.concatenate(keep)
    return a[keep], b[keep]


def _runs(group: pd.DataFrame, key: str) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Rows of each key, or of the two blocks of a key, of a frame sorted by key, left, right."""
    keys = group[[key, "left", "right"]].to_numpy()
    edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
    block = group["block"].to_numpy()
    for at, end in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
        rows = np.arange(at, end)
        if keys[at, 1] == keys[at, 2]:
            if len(rows) > 1:
                yield rows, None
        else:
            one, two = rows[block[rows] == keys[at, 1]], rows[block[rows] == keys[at, 2]]
            if len(one) and len(two):
                yield one, two


def _labels(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    least = least_ids(ids, a, b)
    moved = np.flatnonzero(least != ids)
    return pd.DataFrame({"a": ids[moved], "b": least[moved]}).drop_duplicates()


def _forest(n: int, links: list[np.ndarray]) -> list[np.ndarray]:
    """One array of links that connect the same of ``n`` rows: fewer than ``n``."""
    a, b = np.concatenate(links, axis=1)
    rows = np.arange(n)
    least = least_ids(rows, a, b)
    moved = np.flatnonzero(least != rows)
    return [np.stack([moved, least[moved]])]


def _meet(group: pd.DataFrame, share: int) -> pd.DataFrame:
    """Documents that met at a shingle, joined where the tree and their points allow it."""
    group = group.sort_values(["token", "left", "right", "rep"], ignore_index=True)
    c, n = points(group["point"].tolist()), group["n"].to_numpy()
    ids, codes = np.unique(group["rep"].to_numpy(), return_inverse=True)
    linked, pairs, waiting = [np.zeros((2, 0), dtype=np.int64)], [], 0

    def settle() -> list[np.ndarray]:
        x, y = surviving(*np.concatenate(pairs, axis=1), c, n, share)
        pairs.clear()
        return _forest(len(ids), [*linked, np.stack([codes[x], codes[y]])])

    for one, two in _runs(group, "token"):
        pairs.append(np.stack(tree_pairs(one, c, n, share, two)))
        waiting += pairs[-1].shape[1]
        if waiting > WAITING:
            linked, waiting = settle(), 0
    if pairs:
        linked = settle()
    a, b = np.concatenate(linked, axis=1)
    return _labels(ids, a, b)


def _connect(
    group: pd.DataFrame, c: np.ndarray, n: np.ndarray, shared: Callable, share: int
) -> pd.DataFrame:
    """Joins rows of a family whose ``shared(a, b)`` reaches the overlap, if the tree lets them
    through and they aren't connected yet."""
    root = list(range(len(n)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    linked_a, linked_b = [], []
    for one, two in _runs(group, "family"):
        x, y = surviving(*tree_pairs(one, c, n, share, two), c, n, share)
        for k in range(0, len(x), 10_000):
            for a, b in zip(x[k : k + 10_000].tolist(), y[k : k + 10_000].tolist(), strict=True):
                if (p := find(a)) != (q := find(b)) and may_reach(shared(a, b), n[a], n[b], share):
                    root[max(p, q)] = min(p, q)
                    linked_a.append(a)
                    linked_b.append(b)
    a, b = np.array(linked_a, dtype=np.int64), np.array(linked_b, dtype=np.int64)
    return _labels(group["rep"].to_numpy(), a, b)


def _narrow(group: pd.DataFrame, share: int) -> pd.DataFrame:
    """Families by the bounds of finer points."""
    group = group.sort_values(["family", "left", "right", "rep"], ignore_index=True)
    fine = [unpack(r) for r in group["fine"]]
    n = group["n"].to_numpy()
    c = np.stack([fold(f, GROUPS) for f in fine])

    def shared(a: int, b: int) -> np.int64:
        f, g = fine[a], fine[b]
        groups = min(len(f), len(g))
        return np.int64(np.minimum(fold(f, groups), fold(g, groups)).sum())

    return _connect(group, c, n, shared, share)


def _verify(group: pd.DataFrame, share: int) -> pd.DataFrame:
    """All links between different sets of a family: labels of ids, and links of each set."""
    where = ["family", "left", "right", "rep", "key"]
    group = group.drop_duplicates(where).sort_values(where, ignore_index=True)
    sets = [np.frombuffer(r, dtype=np.uint64) for r in group["hashes"]]
    n = np.array([len(s) for s in sets])
    c = points([point(s) for s in sets])
    copies, links = group["copies"].to_numpy(), np.zeros(len(n), dtype=np.int64)
    linked, waiting = [np.zeros((2, 0), dtype=np.int64)], 0
    for one, two in _runs(group, "family"):
        x, y = surviving(*tree_pairs(one, c, n, share, two), c, n, share)
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        rows = np.union1d(x, y)
        if not len(rows):
            continue
        values, codes = np.unique(np.concatenate([sets[k] for k in rows.tolist()]), return_inverse=True)
        codes = np.split(codes.astype(np.int32), np.cumsum(n[rows])[:-1])
        codes = dict(zip(rows.tolist(), codes, strict=True))
        inside = np.zeros(len(values), dtype=bool)
        edges = np.flatnonzero(np.diff(x, prepend=-1, append=-1)).tolist()
        for at, end in zip(edges, edges[1:], strict=False):
            a, others = int(x[at]), y[at:end]
            inside[codes[a]] = True
            hits = inside[np.concatenate([codes[b] for b in others.tolist()])]
            inside[codes[a]] = False
            starts = np.cumsum(n[others]) - n[others]
            shared = np.add.reduceat(hits, starts, dtype=np.int64)
            b = others[may_reach(shared, n[a], n[others], share)]
            links[a] += copies[b].sum()
            links[b] += copies[a]
            linked.append(np.stack([np.full(len(b), a), b]))
            waiting += len(b)
            if waiting > WAITING:
                linked, waiting = _forest(len(n), linked), 0
    a, b = np.concatenate(linked, axis=1)
    labels = _labels(group["rep"].to_numpy(), a, b)
    some = np.flatnonzero(links)
    counts = pd.DataFrame({"key": group["key"].to_numpy()[some], "links": links[some]})
    out = pd.concat([labels, counts], ignore_index=True)
    return out[["a", "b", "key", "links"]].astype({"a": "Int64", "b": "Int64", "links": "Int64"})


def _count(width: int, schema: pa.Schema):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in parts(batches):
            for text in batch.column(0).to_pylist():
                places = (shingles(text, width) & np.uint64(COUNTERS - 1)).astype(np.int64)
                np.add.at(counts, places, 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], schema=schema)

    return apply


def _describe(width: int, share: int, frequent: np.ndarray, schema: pa.Schema):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            n, key, where, fine, prefix = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, width)
                n.append(len(s))
                key.append(set_key(s))
                where.append(point(s) if len(s) else None)
                fine.append(fine_point(s) if len(s) else None)
                first = len(s) - -(-share * len(s) // 100) + 1 if len(s) else 0
                prefix.append(s[order_of(s, frequent)[:first]].view(np.int64))
            ends = np.cumsum([0, *map(len, prefix)])
            flat = np.concatenate(prefix) if prefix else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(key, pa.binary()),
                    pa.array(where, pa.binary()),
                    pa.array(fine, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                schema=schema,
            )

    return apply


def _sets(width: int, schema: pa.Schema):
    """Sets of documents."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = [shingles(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([set_key(s) for s in found], pa.binary()),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                ],
                schema=schema,
            )

    return apply


def _spread(
    rows: DataFrame, key: str, block: int, units: int, weight: str | None = None
) -> DataFrame:
    """Adds blocks of large keys, the pair (left, right) of blocks and the task's unit.

    A block holds about ``block`` rows, and about ``SET_SUM`` of ``weight`` if there is one.
    """
    parts = F.ceil(F.count("*") / block)
    if weight:
        parts = F.greatest(parts, F.ceil(F.sum(weight) / SET_SUM))
    sizes = rows.groupBy(key).agg(parts.cast("int").alias("blocks")).where("blocks > 1")
    own = F.xxhash64(key, "left", "right")
    return (
        rows.join(sizes, key, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("left", F.least("block", "other"))
        .withColumn("right", F.greatest("block", "other"))
        .withColumn(
            "unit",
            F.when(F.col("blocks") > 1, own).otherwise(F.pmod(own, F.lit(max(1, units)))),
        )
        .drop("blocks", "other")
    )


def join(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links for every row of ``docs`` (doc_id bigint, text).

    Two documents link when their sets share ``share`` in 100 (1 to 100) of their union.
    Other columns are ignored. Words are lower-cased (A-Z); a set holds the distinct shingles
    of ``width`` words, or the whole sequence of a shorter text. Texts without words (null
    too) have an empty set and link with nothing: their component is their own id. Rows with
    equal ids are one node; a row with a null id belongs to the component of the rows with
    an equal set, null if there is none. An empty table gives no rows.

    ``n_links`` counts the other documents (a doc_id with a set; equal rows are one) that a
    row's set links with: those with an equal set and, by copies, those of every other set in
    reach. It is 0 without words; a row with a null id shows that of the rows with an equal
    set, null if there is none.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long, binary = T.LongType(), T.BinaryType()
    schema = lambda **kinds: T.StructType([T.StructField(k, v) for k, v in kinds.items()])

    def mapped(rows: DataFrame, function: Callable, out: T.StructType, *more) -> DataFrame:
        return rows.mapInArrow(function(*more, to_arrow_schema(out)), out)

    def sharing(function: Callable) -> Callable[[pd.DataFrame], pd.DataFrame]:
        return lambda group: function(group, share)

    counted = mapped(docs.select("text"), _count, schema(counter=long, n=long), width)
    counted = stage(counted.groupBy("counter").agg(F.sum("n").alias("n")), "counters")
    mean = (counted.agg(F.sum("n")).first()[0] or 0) / COUNTERS
    often = counted.where(F.col("n") > mean + max(64, 6 * mean**0.5)).select("counter").toPandas()
    frequent = np.zeros(COUNTERS, dtype=bool)  # at most COUNTERS rows came to the driver
    frequent[often["counter"].to_numpy(dtype=np.int64)] = True

    described = schema(
        doc_id=long, n=long, key=binary, point=binary, fine=binary, prefix=T.ArrayType(long)
    )
    described = stage(mapped(docs, _describe, described, width, share, frequent), "shingles")
    sets = described.where("key is not null AND doc_id is not null").select("key", "doc_id")
    sets = sets.distinct().groupBy("key")
    sets = stage(sets.agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "sets")
    reps = described.join(sets, "key").where("doc_id = rep")
    # Shingles travel alone until it is known which of them several documents share.
    tokens = reps.select("rep", F.explode("prefix").alias("token"))
    shared = stage(tokens.groupBy("token").count().where("count > 1").select("token"), "shared")
    meeting = stage(tokens.join(shared, "token"), "meeting")
    edge = schema(a=long, b=long)
    near = (
        _spread(meeting, "token", BLOCK, meeting.count() // UNIT)
        .join(reps.select("rep", "n", "point"), "rep")
        .groupBy("unit")
        .applyInPandas(sharing(_meet), edge)
    )

    def families_of(edges: DataFrame, purpose: str) -> tuple[DataFrame, int, int]:
        found = components(edges).select(
            F.col("node").alias("rep"), F.col("component").alias("family")
        )
        of_ids = reps.select("rep", "key", "n", "copies").distinct()
        found = stage(found.join(of_ids, "rep"), purpose)
        total, weight = found.agg(F.count("*"), F.sum("n")).first()
        return found, total, weight or 0

    wide, total, _ = families_of(near, "wide")
    tight = (
        _spread(wide.drop("copies"), "family", BLOCK, total // SETS)
        .join(reps.select("rep", "key", "fine").distinct(), ["rep", "key"])
        .groupBy("unit")
        .applyInPandas(sharing(_narrow), edge)
    )
    families, total, weight = families_of(tight, "families")
    # Where each set goes is settled before any set is moved.
    units = max(total // SETS, weight // UNIT_SUM)
    places = stage(_spread(families, "family", BLOCK, units, "n").drop("n"), "places")
    members = families.select(F.col("rep").alias("doc_id"))
    found = schema(rep=long, key=binary, hashes=binary)
    wanted = mapped(docs.join(members, "doc_id", "left_semi"), _sets, found, width)
    verified = wanted.join(places, ["rep", "key"]).groupBy("unit")
    verified = verified.applyInPandas(sharing(_verify), schema(a=long, b=long, key=binary, links=long))
    verified = stage(verified, "verified")
    found = components(verified.where("a is not null").select("a", "b"))
    counts = verified.where("key is not null").groupBy("key").agg(F.sum("links").alias("links"))
    named = (
        sets.join(found, sets["rep"] == found["node"], "left")
        .join(counts, "key", "left")
        .select(
            "key",
            F.coalesce("component", "rep").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return described.join(named, "key", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.when(F.col("key").isNull(), 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )
