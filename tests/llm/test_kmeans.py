import hashlib
import math

import numpy as np
import pytest

from checks.compare import connect, differences
from tests.conftest import SMALL
from tickloom.llm import kmeans, queries

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, batch string, id string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, "x", "y", "z") for i, e in rows], SCHEMA)


def brute(rows, k, rounds, dimensions):
    """Lloyd's algorithm on Python integers, one vector at a time."""
    kept = [
        (i, [math.floor(1024 * x) for x in e])
        for i, e in rows
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)
    ]
    order = sorted(
        kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    )
    centroids = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for n, members in groups.items():
            centroids[n] = [sum(v) // len(members) for v in zip(*members)]
    found = sorted(((-1 if i is None else i), *nearest(x)[::-1]) for i, x in kept)
    return found, centroids


def sample(n, dimensions, seed=0):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(5, dimensions))
    return [
        (k, [float(np.float32(x)) for x in middles[k % 5] + 0.4 * r.normal(size=dimensions)])
        for k in range(n)
    ]


def run(spark, rows, **options):
    found, centroids = kmeans.cluster(vectors(spark, rows), salt=3, **options)
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in found.collect())
    return got, centroids.tolist()


@pytest.mark.parametrize("shard, batch", [(16, 4096), (5, 7), (1, 50)])
def test_equals_brute_force_however_it_is_split(spark, shard, batch):
    rows = sample(90, 12)
    got = run(spark, rows, k=4, rounds=6, dimensions=12, shard=shard, batch=batch)
    assert got == brute(rows, 4, 6, 12)


def test_unusable_vectors_ties_and_repeated_rows(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [4.0, -3.0]), (3, [-0.0001, 0.0]),
        (4, None), (5, []), (6, [1.0]), (7, [1.0, None]), (8, [1.0, float("nan")]),
        (9, [float("inf"), 1.0]), (10, [1.0, 2.0, 3.0]), (11, [2.0, 2.0]), (1, [7.0, 2.0]),
    ]
    for k in (1, 3, 8):
        assert run(spark, rows, k=k, rounds=10, dimensions=2) == brute(rows, k, 10, 2)


def test_an_emptied_centroid_stays_and_rounds_may_be_zero(spark):
    rows = [(i, [0.0, 0.0]) for i in range(6)] + [(10, [9.0, 9.0])]
    for rounds in (0, 1, 4):
        assert run(spark, rows, k=3, rounds=rounds, dimensions=2) == brute(rows, 3, rounds, 2)


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [float("nan")] * 64)]):
        found, centroids = kmeans.cluster(vectors(spark, rows))
        out = kmeans.digest(found, centroids)
        assert out.collect() == [] and len(centroids) == 0
        assert out.columns == [
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
        ]


def test_huge_components_are_held_and_sums_beyond_a_long_are_null(spark):
    big = 3e38
    rows = [(i, [big if i % 2 else -big] * 64) for i in range(6)]
    found, centroids = kmeans.cluster(vectors(spark, rows), k=1, rounds=0)
    out = kmeans.digest(found, centroids).collect()
    assert {r.distance for r in out} == {0, 64 * (2 * kmeans.LARGEST) ** 2}
    assert {r.inertia for r in out} == {None}


def test_clashing_and_other_typed_ids(spark):
    rows = [(f"v{i}", e) for i, e in sample(20, 3)]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    found, _ = kmeans.cluster(frame, k=2, rounds=2, dimensions=3)
    assert sorted(r.vec_id for r in found.collect()) == sorted(i for i, _ in rows)


def test_blocks_stay_in_their_buckets(spark):
    laid = kmeans.lay_out(vectors(spark, sample(30, 4)), 4, 2, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with kmeans.bucketed(laid) as blocks:
            labels = spark.createDataFrame([], "batch bigint, shard int, clusters binary")
            plan = blocks.join(labels, ["batch", "shard"])._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") == 1


def test_query_equals_its_sql(spark):
    got = queries.op13_centroid_clustering(spark, SMALL).toPandas()
    want = connect(SMALL).sql(queries.sql_texts()["op13_centroid_clustering"]).df()
    assert differences(got, want) == ""
