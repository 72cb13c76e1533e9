"""Centroid clustering: Lloyd's algorithm with the dimensions dealt over shards.

Vectors are laid out once as *blocks* (a batch of vectors x a slice of their dimensions). In
every round a task holds one block and the centroids' values in that slice only. It computes
exact partial squared distances; they are added per batch, the nearest centroid is taken, and
the labels (a byte or two per vector) go back to the blocks, where every shard sums its own
slice and so updates its part of the centroids. All arithmetic is on integers, so the result
does not depend on how the work is split.

No vector is moved after the layout: the block table is bucketed by (batch, shard), and labels
are joined to it bucket by bucket. What a round shuffles is k partial distances per vector and
shard. Only k x dimensions centroid values and k sums reach the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import shared_folder

from .common import ship, stage

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
#: Dimensions of one shard and vectors of one batch; both only split the work.
SHARD = 16
BATCH = 4096
#: Largest absolute integer component. 64 squared differences of twice that fit a signed long.
LARGEST = int(2**27.5)


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), held to +-``LARGEST`` where a distance could leave a long."""
    scaled = np.floor(vectors.astype(np.float64) * scale)
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int32)


def _layout(dimensions: int, shard: int, batch: int, scale: int):
    """Rows to batches: their ids and one byte string of integers per shard."""
    starts = range(0, dimensions, shard)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                whole = integers(vectors.reshape(part.num_rows, dimensions), scale)
                ids = part.column("id")
                ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                slices = [whole[:, s : s + shard].tobytes() for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        ids,
                        pa.array([slices], pa.list_(pa.binary())),
                    ],
                    ["batch", "ids", "slices"],
                )
                number += 1

    return lay


def usable(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """id and vector (doubles) of the vectors with that many finite components."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    keep = F.coalesce((F.size(x) == dimensions) & ~bad, F.lit(False))
    return vectors.where(keep).select(
        F.col("vec_id").alias("id"), x.cast("array<double>").alias("vector")
    )


def lay_out(
    vectors: DataFrame,
    dimensions: int = DIMENSIONS,
    shard: int = SHARD,
    batch: int = BATCH,
    scale: int = SCALE,
) -> DataFrame:
    """batch, ids, slices of all usable vectors, from columns ``vec_id`` and ``embedding``.

    Written before anything is shuffled: batches keep their rows whatever runs again.
    """
    ship(vectors.sparkSession)
    rows = usable(vectors, dimensions)
    kind = rows.schema["id"].dataType.simpleString()
    laid = rows.mapInArrow(
        _layout(dimensions, shard, batch, scale),
        f"batch bigint, ids array<{kind}>, slices array<binary>",
    )
    return stage(laid, "batches")


@contextmanager
def bucketed(laid: DataFrame):
    """Blocks (batch, shard, slice) as a table in as many buckets as there are shuffle
    partitions, so that joins on (batch, shard) leave it where it is.

    Its files lie in the shared folder; its name leaves the catalogue at the end.
    """
    spark = laid.sparkSession
    blocks = laid.select("batch", F.posexplode("slices").alias("shard", "slice"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"blocks_{uuid.uuid4().hex}"
    (
        blocks.repartition(buckets, "batch", "shard")
        .write.bucketBy(buckets, "batch", "shard")
        .option("path", shared_folder(spark, "blocks"))
        .format("parquet")
        .saveAsTable(name)
    )
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _block(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i4").reshape(-1, width).astype(np.int64)


def _partial_distances(centroids: np.ndarray, shard: int):
    """Per block the squared distances to every centroid, over the block's dimensions."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for batch, s, raw in zip(*(rows.column(c).to_pylist() for c in ("batch", "shard", "slice"))):
                near = centroids[:, s * shard : (s + 1) * shard]
                values = _block(raw, near.shape[1])
                parts = np.stack([((values - c) ** 2).sum(axis=1) for c in near], axis=1)
                small = parts.max() < 2**31
                yield pa.RecordBatch.from_pydict(
                    {
                        "batch": pa.array([batch], pa.int64()),
                        "wide": pa.array([not small]),
                        "parts": pa.array([parts.astype("<u4" if small else "<i8").tobytes()]),
                    }
                )

    return measure


def _nearest(k: int):
    """Adds the partial distances of a batch and takes the nearest centroid, ties the first."""

    def take(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(
            np.frombuffer(raw, dtype="<i8" if wide else "<u4").reshape(-1, k).astype(np.int64)
            for wide, raw in zip(group["wide"], group["parts"], strict=True)
        )
        cluster = total.argmin(axis=1)
        distance = total[np.arange(len(total)), cluster]
        return pd.DataFrame(
            {
                "batch": group["batch"].iloc[:1],
                "clusters": [cluster.astype("<i4").tobytes()],
                "distances": [distance.astype("<i8").tobytes()],
            }
        )

    return take


def assign(blocks: DataFrame, centroids: np.ndarray, shard: int = SHARD) -> DataFrame:
    """batch, clusters, distances: the nearest centroid of each vector, as bytes."""
    parts = blocks.select("batch", "shard", "slice").mapInArrow(
        _partial_distances(centroids, shard), "batch bigint, wide boolean, parts binary"
    )
    found = parts.groupBy("batch").applyInPandas(
        _nearest(len(centroids)), "batch bigint, clusters binary, distances binary"
    )
    return stage(found, "labels")


def _slice_sums(k: int, dimensions: int, shard: int):
    """Sums and counts per cluster over the blocks of a task, each within its shard."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for rows in batches:
            for s, raw, labels in zip(*(rows.column(c).to_pylist() for c in ("shard", "slice", "clusters"))):
                width = min(shard, dimensions - s * shard)
                values, label = _block(raw, width), np.frombuffer(labels, dtype="<i4")
                total = sums.setdefault(s, np.zeros((k, width), dtype=np.int64))
                for c in np.unique(label):
                    total[c] += values[label == c].sum(axis=0)
                counts[s] = counts.get(s, 0) + np.bincount(label, minlength=k)
        for s, total in sums.items():
            width = total.shape[1]
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": pa.array(np.repeat(np.arange(k, dtype=np.int32), width)),
                    "dimension": pa.array(np.tile(np.arange(width, dtype=np.int32), k) + s * shard, pa.int32()),
                    "total": pa.array(total.ravel()),
                    "n": pa.array(np.repeat(counts[s], width).astype(np.int64)),
                }
            )

    return add


def update(
    blocks: DataFrame, labels: DataFrame, centroids: np.ndarray, shard: int = SHARD
) -> np.ndarray:
    """Centroids moved to the floored means of their vectors; empty ones stay."""
    k, dimensions = centroids.shape
    shards = range((dimensions + shard - 1) // shard)
    spread = labels.select(
        "batch", F.explode(F.array(*map(F.lit, shards))).alias("shard"), "clusters"
    )
    sums = (
        blocks.join(spread, ["batch", "shard"])
        .select("shard", "slice", "clusters")
        .mapInArrow(
            _slice_sums(k, dimensions, shard),
            "cluster int, dimension int, total bigint, n bigint",
        )
        .groupBy("cluster", "dimension")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .where("n > 0")
        # Exact: the remainder is taken off before the integer division.
        .selectExpr("cluster", "dimension", "(total - pmod(total, n)) div n AS value")
        .toPandas()
    )
    moved = centroids.copy()
    moved[sums["cluster"], sums["dimension"]] = sums["value"]
    return moved


def first_centroids(rows: DataFrame, k: int, salt: int, scale: int = SCALE) -> np.ndarray:
    """The k vectors of ``usable`` rows whose id has the smallest sha256 of ``salt:id`` (null:
    empty id). Rows that share an id go by their values. Fewer rows give fewer centroids."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(k)
    return integers(np.array([row.vector for row in first.collect()]), scale).astype(np.int64)


def _listed():
    """Label bytes of a batch as lists, next to its ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(rows.num_rows):
                row = rows.slice(at, 1)
                ids = row.column("ids").flatten()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.frombuffer(row.column("clusters")[0].as_py(), dtype="<i4")),
                        pa.array(np.frombuffer(row.column("distances")[0].as_py(), dtype="<i8")),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    return read


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    *,
    dimensions: int = DIMENSIONS,
    salt: int = 3,
    shard: int = SHARD,
    batch: int = BATCH,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every usable vector, and the final centroids.

    ``vectors`` has ``vec_id`` (any type) and ``embedding`` (array of numbers); other columns
    are ignored. A vector is left out if it is null, has another number of components, or holds
    a null, NaN or infinite one. Components beyond +-``LARGEST`` / ``scale`` count as that
    bound, so that no distance leaves a long. Repeated rows and ids are vectors of their own; a
    null id stays null. Equally near centroids: the smaller number. No usable vector gives no
    row. Rounds stop early once the centroids no longer move: later ones would change nothing.
    """
    spark = vectors.sparkSession
    laid = lay_out(vectors, dimensions, shard, batch, scale)
    centroids = first_centroids(usable(vectors, dimensions), k, salt, scale)
    if not len(centroids):
        kind = laid.schema["ids"].dataType.elementType.simpleString()
        empty = spark.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint")
        return empty, centroids.reshape(0, dimensions)
    with bucketed(laid) as blocks:
        labels = None
        for _ in range(rounds):
            labels = assign(blocks, centroids, shard)
            moved = update(blocks, labels, centroids, shard)
            settled = np.array_equal(moved, centroids)
            centroids = moved
            if settled:
                break
        else:
            labels = assign(blocks, centroids, shard)
    kind = laid.schema["ids"].dataType.elementType.simpleString()
    found = laid.select("batch", "ids").join(labels, "batch").mapInArrow(
        _listed(), f"vec_id {kind}, cluster int, distance bigint"
    )
    return found, centroids


def digest(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster``'s rows with the sums of distances and the hash of each final centroid.

    A sum beyond a long is null.
    """
    spark = found.sparkSession
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    names = spark.createDataFrame(
        list(enumerate(hashes)), "cluster int, centroid_sha256 string"
    )
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    whole = sums.agg(F.sum("s").alias("whole"))
    # One row per centroid, k in all.
    facts = (
        names.join(sums, "cluster", "left")
        .crossJoin(F.broadcast(whole))
        .select(
            "cluster",
            F.expr("try_cast(s AS bigint)").alias("cluster_inertia"),
            F.expr("try_cast(whole AS bigint)").alias("inertia"),
            "centroid_sha256",
        )
    )
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The query in SQL: one pair of steps (labels, centroids) a round."""
    steps = [
        f"""kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,
        list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS whole
    FROM embeddings
    WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS}
)""",
        """v AS MATERIALIZED (
    SELECT r, unnest(whole) AS x, generate_subscripts(whole, 1) AS d FROM kept
)""",
        f"""firsts AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster, r
    FROM kept ORDER BY sha256('3:' || vec_id) LIMIT {k}
)""",
        "c0 AS MATERIALIZED (SELECT cluster, d, x::HUGEINT AS x FROM firsts JOIN v USING (r))",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""l{n} AS MATERIALIZED (
    SELECT r, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
    FROM (SELECT r, cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance
          FROM v JOIN c{n} c USING (d) GROUP BY r, cluster)
    GROUP BY r
)"""
        )
        if n < rounds:
            steps.append(
                f"""c{n + 1} AS MATERIALIZED (
    SELECT cluster, d, coalesce((s - ((s % n) + n) % n) // n, x) AS x
    FROM c{n} LEFT JOIN (SELECT cluster, d, sum(x)::HUGEINT AS s, count(*) AS n
                         FROM v JOIN l{n} USING (r) GROUP BY cluster, d) USING (cluster, d)
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f"""
SELECT vec_id, cluster::INT AS cluster, distance::BIGINT AS distance,
    (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM l{rounds} JOIN kept USING (r) JOIN (
    SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256
    FROM c{rounds} GROUP BY cluster) USING (cluster)"""
    )
