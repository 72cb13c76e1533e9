"""Connected components by alternating large-star and small-star rounds.

Each round is a map-side combined minimum per node and a join; edges shrink to stars. Every
round is written to the shared folder; only a count and a checksum reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a, b) with a > b. Large: every neighbour above a node moves to the least one
    around it. Small: a node's lesser neighbours move to the least of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    # Written, so that both sides of the join are plain shuffles and a hub can be split.
    least = stage(least.select("a", F.least("a", "m").alias("m")), "least")
    moved = around.join(least, "a")
    if large:
        moved = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of ``edges`` (a, b), bigint.

    Edges may repeat, run either way or be loops; rows with a null end are ignored. Nodes
    without an edge to another node don't appear.
    """
    edges = (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges, before = stage(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
        edges = stage(_star(_star(edges, large=True), large=False), "edges")


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least of n rows reachable from each over links (a, b), inside one task."""
    root = np.arange(n)
    while True:
        low, before = np.minimum(root[a], root[b]), root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def least_ids(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest id reachable from each row over links (a, b) between rows."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(ids))
    return ids[order][local_roots(len(ids), rank[a], rank[b])[rank]]
