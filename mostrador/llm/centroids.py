"""Centroid clustering with a pivot table (LAESA).

A few kept vectors are pivots. The distances of every vector to all pivots are worked out once and stored beside it. In
each round the distances of the centroids to the pivots are known too, and by the triangle inequality no vector is nearer
to a centroid than the largest difference of their distances to one pivot. So each vector is compared with the centroid
of the least bound first, and then exactly with those centroids only whose bound is not beyond that distance.

Vectors are integers, so distances, sums and floors are exact: block products run in doubles while every partial sum
stays below 2**53, in 64-bit integers otherwise. Tasks add up their vectors by cluster, so a shuffle carries one row per
task, cluster and component at most, however large a cluster is. The driver holds the centroids, never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm.common import written

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
PIVOTS = 16
#: Components beyond this (either sign) count as this, so that every squared distance fits 64 bits.
MOST = 1 << 27
#: Up to this size of component, 64 products and their sums are exact in doubles.
EXACT = 1 << 21
ROWS = 4096


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as an array of int; null if a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.greatest(F.lit(-MOST).cast("long"), F.least(F.lit(MOST).cast("long"), F.floor(v * float(scale)))).cast("int"))
    return F.when(finite, whole)


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """(id, v): the rows whose vector has exactly ``dimensions`` finite components, as integers."""
    found = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("x")).where(F.size("x") == dimensions)
    return found.select("id", integers(F.col("x")).alias("v")).where("v IS NOT NULL")


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:id``, in the order of the hashes; equal hashes by vector. A missing
    id counts as empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(column: pa.ListArray, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``, as 64-bit integers."""
    largest = max(int(np.abs(x).max(initial=0)) for x in (a, b))
    if largest <= EXACT:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :]).astype(np.int64)
    return np.stack([((a - row) ** 2).sum(1) for row in b], axis=1)


def pivot_table(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``kept`` with ``far``: the distances to all pivots (doubles, rounded square roots of exact squares)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                far = np.sqrt(squared(_matrix(batch.column("v"), np.int64), pivots))
                ends = pa.array(np.arange(len(far) + 1, dtype=np.int32) * far.shape[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, pa.array(far.ravel()))], [*batch.schema.names, "far"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("far", T.ArrayType(T.DoubleType()))]))


def nearest(v: np.ndarray, far: np.ndarray, centroids: np.ndarray, centroids_far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance, of each vector; and how many exact
    distances that took. ``far`` and ``centroids_far``: distances of vectors and centroids to the pivots."""
    n, k = len(v), len(centroids)
    bound = np.zeros((n, k))
    for p in range(far.shape[1]):
        np.maximum(bound, np.abs(far[:, p, None] - centroids_far[None, :, p]), out=bound)
    # Square roots are rounded; so the bound gives way by more than that.
    bound = np.maximum(bound * (1 - 1e-12) - 1e-6, 0) ** 2
    rows = np.arange(n)
    first = bound.argmin(1)
    best = ((v - centroids[first]) ** 2).sum(1)
    number, counted = first.copy(), n
    for c in range(k):
        at = rows[(bound[:, c] * (1 - 1e-12) <= best) & (first != c)]
        if len(at):
            d = ((v[at] - centroids[c]) ** 2).sum(1)
            counted += len(at)
            better = (d < best[at]) | ((d == best[at]) & (c < number[at]))
            best[at[better]], number[at[better]] = d[better], c
    return number, best, counted


def assign(table: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """(id, cluster int, distance long) of each row of the pivot table."""
    between = np.sqrt(squared(centroids, pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                number, best, _ = nearest(_matrix(batch.column("v"), np.int64), _matrix(batch.column("far"), np.float64), centroids, between)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(number.astype(np.int32)), pa.array(best)], ["id", "cluster", "distance"])

    return table.mapInArrow(run, T.StructType([table.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]))


def cluster_sums(table: DataFrame, pivots: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """(cluster, size, sums): vectors of each cluster, and the sum of each component. One row per task and cluster."""
    between = np.sqrt(squared(centroids, pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                v = _matrix(batch.column("v"), np.int64)
                number = nearest(v, _matrix(batch.column("far"), np.float64), centroids, between)[0]
                order = np.argsort(number, kind="stable")
                present, begins = np.unique(number[order], return_index=True)
                sums[present] += np.add.reduceat(v[order], begins, axis=0)
                sizes += np.bincount(number, minlength=len(centroids))
        found = np.flatnonzero(sizes)
        ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * centroids.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(sizes[found]), pa.ListArray.from_arrays(ends, pa.array(sums[found].ravel()))],
            ["cluster", "size", "sums"],
        )

    parts = table.mapInArrow(run, "cluster int, size long, sums array<long>")
    # Sums of tasks may be too large for a long together.
    each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(centroids.shape[1])]
    return parts.groupBy("cluster").agg(F.sum("size").alias("size"), *each).select("cluster", "size", F.array(*[f"s{i}" for i in range(centroids.shape[1])]).alias("sums"))


def _moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Centroids at the floors of their vectors' means; those without vectors stay."""
    out = centroids.copy()
    for row in sums.collect():
        out[row["cluster"]] = [int(s) // row["size"] for s in row["sums"]]
    return out


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, clusters: int = CLUSTERS,
    rounds: int = ROUNDS, seed: int = SEED, pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """One row (id, cluster int, distance long, cluster_inertia, inertia long, centroid_sha256) per kept row, and the
    centroids (integers).

    Rows are kept whose vector is not null, has exactly ``dimensions`` components and no null, NaN or infinite one;
    components are floor(256 * x), at most 2**27 either way. Centroids start as the kept vectors of smallest hash; fewer
    kept rows than ``clusters`` give as many centroids. Ties go to the smaller number. Repeated rows and ids count as
    often as they come; a null id counts as empty text in the hash and comes back as null. Inertias beyond a long are
    null. An empty table (or one without a kept row) gives no rows. Other columns are ignored.
    """
    kept = kept_vectors(vectors, id_col, vector_col, dimensions)
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        none = kept.select("id", *[F.lit(None).cast(t).alias(n) for n, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
        return none.where("false").withColumnRenamed("id", id_col), centroids
    fixed = centroids[:pivots]
    table = written(pivot_table(kept, fixed), "laesa-table")
    for _ in range(rounds):
        centroids = _moved(centroids, cluster_sums(table, fixed, centroids))
    found = written(assign(table, fixed, centroids), "laesa-assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(exact.alias("d")).collect()}
    total = sum(by_cluster.values())
    fits = lambda x: x if x < 1 << 63 else None
    sums = F.array(*[F.lit(fits(by_cluster.get(c, 0))).cast("long") for c in range(len(centroids))])
    names = F.array(*[F.lit(sha256(",".join(map(str, row)).encode()).hexdigest()) for row in centroids.tolist()])
    out = found.select(
        F.col("id").alias(id_col), "cluster", "distance", F.element_at(sums, F.col("cluster") + 1).alias("cluster_inertia"),
        F.lit(fits(total)).cast("long").alias("inertia"), F.element_at(names, F.col("cluster") + 1).alias("centroid_sha256"),
    )
    return out, centroids
