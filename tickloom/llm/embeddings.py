"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosines, components.

Equal vectors are grouped first, so a hot vector is one row with a count. Each distinct vector
gets ``tables`` signatures of ``bits`` signs. bits follows log2 of the number of vectors (about
``BUCKET`` of them meet in a bucket by chance) and tables follows from bits so that a pair at the
threshold meets in some table with probability ``RECALL``; closer pairs do so almost surely.

Buckets of one table are dealt to tasks by a hash. A task compares its buckets with one matrix
product in double precision each. A pair counts in the first table where it meets, which both
signatures tell, so counts add up without listing pairs: a task returns for each vector the
number of linked vectors and its least link-connected vector. A bucket of more than ``BLOCK``
vectors is cut into blocks, and each pair of blocks is a unit of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ship, stage
from .components import components, least_ids

THRESHOLD = 0.9
RECALL = 0.97
BUCKET = 8
BLOCK = 1024
#: Vectors that a task of the comparison gets, about.
UNIT = 4096
SEED = 20
#: Columns that a task of the comparison needs.
SENT = ("vec_id", "raw", "copies", "signature", "t", "bucket", "block", "left", "right")


def shape(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """bits and tables for so many distinct vectors."""
    bits = max(6, math.ceil(math.log2(max(vectors, 2) / BUCKET)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def _planes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(count, dim)).T


def _as_bytes(kind: str, schema: pa.Schema):
    """Valid vectors as raw bytes; rows that link with nothing are left out."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, raw = [], []
            for i, v in enumerate(batch.column(1).to_pylist()):
                if not v or any(x is None for x in v):
                    continue
                x = np.array(v, dtype=kind)
                if np.isfinite(x).all() and x.any():
                    keep.append(i)
                    raw.append((x + 0).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(raw, pa.binary())],
                schema=schema,
            )

    return apply


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Rows of length 1 in double precision, from vectors of one dimension."""
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _signatures(bits: int, tables: int, kind: str, schema: pa.Schema):
    powers = 1 << np.arange(bits, dtype=np.int64)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            found = np.zeros((len(raw), tables), dtype=np.int64)
            for size in {len(r) for r in raw}:
                rows = [k for k, r in enumerate(raw) if len(r) == size]
                x = _unit([raw[k] for k in rows], kind)
                signs = x @ _planes(x.shape[1], bits * tables) >= 0
                found[rows] = signs.reshape(len(rows), tables, bits) @ powers
            signature = pa.array([row.tobytes() for row in found.astype(np.int32)], pa.binary())
            buckets = pa.ListArray.from_arrays(
                pa.array(np.arange(len(raw) + 1) * tables, pa.int32()), pa.array(found.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, signature, buckets], schema=schema)

    return apply


def _compare(threshold: float, kind: str):
    def links(group: pd.DataFrame, table: int) -> pd.DataFrame | None:
        """Links inside the buckets (or pairs of blocks) of vectors of one dimension."""
        group = group.sort_values(["bucket", "left", "right", "vec_id"], ignore_index=True)
        x = _unit(group["raw"].tolist(), kind)
        key = group[["bucket", "left", "right"]].to_numpy()
        edges = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
        edges = np.concatenate([[0], edges, [len(x)]])
        from_block = group["block"].to_numpy()
        first, second = [], []
        for at, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if end - at < 2:
                continue
            low, high = key[at, 1], key[at, 2]
            one, two = np.arange(at, end), np.arange(at, end)
            if low != high:
                one, two = one[from_block[one] == low], two[from_block[two] == high]
            a, b = np.nonzero(x[one] @ x[two].T >= threshold)
            a, b = one[a], two[b]
            new = a < b if low == high else a >= 0
            first.append(a[new])
            second.append(b[new])
        a = np.concatenate(first) if first else np.zeros(0, dtype=np.int64)
        b = np.concatenate(second) if second else a
        if table and len(a):
            signs = np.frombuffer(b"".join(group["signature"]), dtype=np.int32)
            signs = signs.reshape(len(x), -1)[:, :table]
            new = ~(signs[a] == signs[b]).any(1)
            a, b = a[new], b[new]
        if not len(a):
            return None
        copies, ids = group["copies"].to_numpy(), group["vec_id"].to_numpy()
        n = np.bincount(a, copies[b], len(x)) + np.bincount(b, copies[a], len(x))
        least = least_ids(ids, a, b)
        hit = np.flatnonzero(n)
        return pd.DataFrame(
            {"vec_id": ids[hit], "links": n[hit].astype(np.int64), "least": least[hit]}
        )

    def apply(group: pd.DataFrame) -> pd.DataFrame:
        table = int(group["t"].iloc[0])
        parts = [links(part, table) for _, part in group.groupby(group["raw"].map(len))]
        none = pd.DataFrame({"vec_id": [], "links": [], "least": []}, dtype="int64")
        return pd.concat([none, *(p for p in parts if p is not None)], ignore_index=True)

    return apply


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``.

    Needs vec_id (bigint) and embedding (array of numbers); other columns are ignored. Null,
    empty and zero vectors and those with null or non-finite components link with nothing;
    vectors of different dimensions never link. Equal vectors link with each other. Ids
    are taken to be unique: vectors that share one count as linked through it. Rows with a null id link with nothing and
    have a null component. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    element, kind = ("float", "<f4") if single else ("double", "<f8")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast(f"array<{element}>").alias("embedding"),
    )
    raw = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("raw", T.BinaryType())])
    valid = stage(
        rows.where("vec_id is not null").mapInArrow(_as_bytes(kind, to_arrow_schema(raw)), raw), "vectors"
    )
    distinct = stage(
        valid.groupBy("raw")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
        .select("vec_id", "raw", "copies"),
        "vectors",
    )
    bits, tables = shape(distinct.count(), threshold, recall)
    signed = T.StructType(
        [
            *distinct.schema.fields,
            T.StructField("signature", T.BinaryType()),
            T.StructField("buckets", T.ArrayType(T.LongType(), False)),
        ]
    )
    marked = distinct.mapInArrow(_signatures(bits, tables, kind, to_arrow_schema(signed)), signed)
    marked = stage(marked, "signatures")
    sizes = (
        marked.select(F.posexplode("buckets").alias("t", "bucket"))
        .groupBy("t", "bucket")
        .agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        .where("blocks > 1")
    )
    spread = (
        marked.select("*", F.posexplode("buckets").alias("t", "bucket"))
        .join(sizes, ["t", "bucket"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("left", F.least("block", "other"))
        .withColumn("right", F.greatest("block", "other"))
    )
    units = max(1, -(-marked.count() // UNIT))
    unit = F.pmod(F.xxhash64("bucket", "left", "right"), F.lit(units))
    linked = T.StructType(
        [T.StructField(name, T.LongType()) for name in ("vec_id", "links", "least")]
    )
    unit = F.when(F.col("blocks") > 1, F.xxhash64("bucket", "left", "right")).otherwise(unit)
    found = stage(
        spread.select(*SENT, unit.alias("unit"))
        .groupBy("t", "unit")
        .applyInPandas(_compare(threshold, kind), linked),
        "links",
    )
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("vec_id").alias("a"), F.col("least").alias("b")))
    classes = (
        distinct.join(counts, "vec_id", "left")
        .join(groups, distinct["vec_id"] == groups["node"], "left")
        .select(
            "raw",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    joined = valid.join(classes, "raw").select("vec_id", "n_links", "component_id")
    invalid = rows.select("vec_id").join(valid.select("vec_id"), "vec_id", "left_anti")
    alone = invalid.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
