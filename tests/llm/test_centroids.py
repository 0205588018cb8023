import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from mostrador.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k, rounds):
    """[(vec_id, cluster, distance)], centroids: by comparing all with all."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(256 * x) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middles = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middles))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(near(v)[1], []).append(v)
        for c, own in members.items():
            middles[c] = [sum(column) // len(own) for column in zip(*own)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], middles


def vectors(rng, n, spread=0.2):
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(7)]
    return [[float(np.float32(m + rng.gauss(0, spread))) for m in rng.choice(middles)] for _ in range(n)]


def same(spark, rows, **how):
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    found, middles = centroids.cluster(table, **how)
    expected, plain_middles = plain(rows, how.get("clusters", centroids.CLUSTERS), how.get("rounds", centroids.ROUNDS))
    got = found.collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=key) == sorted(expected, key=key)
    assert middles.tolist() == plain_middles
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == r["cluster"])
        assert r["inertia"] == sum(d for _, _, d in expected)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, plain_middles[r["cluster"]])).encode()).hexdigest()
    return got


def test_equals_plain_clustering(spark):
    rng = random.Random(1)
    same(spark, list(enumerate(vectors(rng, 400))), clusters=9, rounds=4)


def test_defined_handling(spark):
    rng = random.Random(2)
    good = vectors(rng, 60)
    odd = [None, [], good[0][:63], [*good[0], 0.5], [None, *good[0][1:]], [float("nan"), *good[0][1:]], [float("-inf"), *good[0][1:]]]
    rows = list(enumerate(good + odd)) + [(3, good[3]), (3, good[4]), (None, good[5]), (None, good[5]), (100, good[6])]
    assert len(same(spark, rows)) == 65


def test_fewer_vectors_than_clusters_and_ties(spark):
    one = [0.25] * 64
    got = same(spark, [(1, one), (2, one), (3, [0.5] * 64)])
    assert {r["distance"] for r in got} == {0}
    # Equal centroids: all go to the one with the smaller number.
    assert len({r["cluster"] for r in got if r["vec_id"] != 3}) == 1


def test_huge_components_are_held_at_the_limit(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * 3.0e38, *[0.1] * 63]) for i in range(9)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found, middles = centroids.cluster(table, clusters=2)
    assert abs(int(middles[0][0])) <= centroids.MOST
    assert all(0 <= r["distance"] <= 1 << 56 for r in found.collect())


def test_integer_and_double_distances_agree():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-centroids.EXACT, centroids.EXACT, (50, 64)), rng.integers(-centroids.EXACT, centroids.EXACT, (9, 64))
    assert (centroids.squared(a, b) == np.stack([((a - row) ** 2).sum(1) for row in b], axis=1)).all()
    a *= 32
    assert (centroids.squared(a, b) == np.stack([((a - row) ** 2).sum(1) for row in b], axis=1)).all()


def test_pivots_spare_distances():
    rng = np.random.default_rng(5)
    middles = rng.integers(-5000, 5000, (40, 64))
    v = middles[rng.integers(0, 40, 2000)] + rng.integers(-50, 50, (2000, 64))
    pivots = middles[:16]
    number, best, counted = centroids.nearest(v, np.sqrt(centroids.squared(v, pivots)), middles, np.sqrt(centroids.squared(middles, pivots)))
    every = centroids.squared(v, middles)
    assert (best == every.min(1)).all() and (number == every.argmin(1)).all()
    assert counted < 2000 * 8


def test_empty_table_and_other_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    found, _ = centroids.cluster(none)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and found.count() == 0
    rng = random.Random(6)
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors(rng, 50))], SCHEMA)
    clashing = table.withColumn("cluster", F.lit("x")).withColumn("id", F.lit("y")).withColumn("distance", F.lit(1))
    assert sorted(map(tuple, centroids.cluster(clashing)[0].collect())) == sorted(map(tuple, centroids.cluster(table)[0].collect()))
