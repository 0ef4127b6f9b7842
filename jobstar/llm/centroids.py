"""Centroid clustering with a LAESA pivot table (operator 12).

Vectors are turned into integers once and stored with their distances to a
few fixed pivots. By the triangle inequality the difference of a vector's and
a centroid's distances to the same pivot is a lower bound of the distance
between the two. In every round centroids are taken in order of their bounds;
once a centroid's bound exceeds the best exact distance so far, neither it
nor any later one can win, and no distance to it is worked out. Distances that
count are exact 64-bit integers; the bounds are rounded down by a margin that
covers their floating-point error, so pruning never changes an assignment.

Sums are exact: each task adds up its vectors per centroid, Spark adds the
tasks' sums as decimals. The driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar.session import materialize

#: components up to this size keep a squared distance of 2**16 components within 64 bits
LARGEST = 1 << 22
PIVOTS = 6
MARGIN = 1e-6  # of a bound; sqrt and subtraction of values below 2**40 err by far less
RESULT = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def quantised(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """Rows whose vector ``_v`` has exactly ``dims`` finite components, with ``_q`` = floor(scale * component) instead."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = rows.where((F.size("_v") == dims) & F.coalesce(F.forall("_v", good), F.lit(False)))
    small = F.forall("_v", lambda x: F.abs(F.lit(scale) * x) < LARGEST)
    whole = F.transform("_v", lambda x: F.floor(F.lit(scale) * x).cast("int"))
    return kept.withColumn("_q", F.when(small, whole).otherwise(F.raise_error(
        F.lit(f"a component times {scale} is not below {LARGEST}: squared distances could pass 64 bits")))).drop("_v")


def choose_pivots(centroids: np.ndarray, count: int) -> np.ndarray:
    """Pivots among the first centroids: each next one has the largest sum of distances to those before it."""
    chosen, total = [0], np.zeros(len(centroids))
    while len(chosen) < min(count, len(centroids)):
        total += np.sqrt(((centroids - centroids[chosen[-1]]) ** 2).sum(1).astype(float))
        rest = np.where(np.isin(np.arange(len(total)), chosen), -1.0, total)
        chosen.append(int(rest.argmax()))
    return centroids[chosen]


def to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of every vector to every pivot."""
    return np.stack([np.sqrt(((vectors - p) ** 2).sum(1).astype(float)) for p in pivots], 1)


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number) and squared distance of every vector, and the exact distances worked out."""
    n, k = len(vectors), len(centroids)
    far = to_pivots(centroids, pivots)
    bound = np.zeros((n, k))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(table[:, p, None] - far[None, :, p]), out=bound)
    bound = np.maximum(bound * (1 - MARGIN) - MARGIN, 0) ** 2
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max)
    cluster = np.zeros(n, np.int64)
    alive, worked = np.arange(n), 0
    for step in range(k):
        c = order[alive, step]
        on = bound[alive, c] <= best[alive]  # bounds grow along the order: one beyond the best ends the row
        alive, c = alive[on], c[on]
        if not alive.size:
            break
        worked += alive.size
        exact = ((vectors[alive] - centroids[c]) ** 2).sum(1)
        better = (exact < best[alive]) | ((exact == best[alive]) & (c < cluster[alive]))
        best[alive[better]], cluster[alive[better]] = exact[better], c[better]
    return cluster, best, worked


def _assign(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """The stored rows with ``_cluster`` and ``_distance``."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cluster, distance, _ = nearest(_vectors(b.column("_q"), dims).astype(np.int64),
                                           _vectors(b.column("_d"), len(pivots)), centroids, pivots)
            names = [n for n in b.schema.names if n not in ("_q", "_d")]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(cluster.astype(np.int32)),
                                              pa.array(distance)], names=[*names, "_cluster", "_distance"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema if f.name not in ("_q", "_d"))
    return stored.mapInArrow(run, f"{fields}, _cluster int, _distance bigint")


def _moved(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The next centroids: floor of the exact mean of each one's vectors; those without any stay."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums and counts of a task, a row per centroid and component; below 2**41 rows of a task none passes 64 bits."""
        count, sums = [0] * k, [[0] * dims for _ in range(k)]
        for b in batches:
            vectors = _vectors(b.column("_q"), dims).astype(np.int64)
            cluster, _, _ = nearest(vectors, _vectors(b.column("_d"), len(pivots)), centroids, pivots)
            for c in np.unique(cluster).tolist():
                mine = vectors[cluster == c]
                count[c] += len(mine)
                sums[c] = [a + b for a, b in zip(sums[c], mine.sum(0).tolist())]
        for c in range(k):
            if count[c]:
                yield pa.RecordBatch.from_pydict({"c": pa.array([c] * dims, pa.int32()),
                                                  "i": pa.array(range(dims), pa.int32()),
                                                  "n": pa.array([count[c]] * dims, pa.int64()),
                                                  "s": pa.array(sums[c], pa.int64())})

    sums = (stored.select("_q", "_d").mapInArrow(run, "c int, i int, n bigint, s bigint").groupBy("c", "i")
            .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    after = centroids.copy()
    for r in sums.collect():  # one row per centroid and component
        after[r["c"], r["i"]] = int(r["s"]) // int(r["n"])
    return after


def cluster_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64,
                    scale: int = 64, clusters: int = 16, rounds: int = 3, seed: int = 1, pivots: int = PIVOTS) -> DataFrame:
    """The rows with a whole vector, each with its cluster, squared distance, inertias and digest of the centroid.

    Rows are left out when the vector is null, has not exactly ``dims``
    components, or has one that is null or not finite. The first centroids are
    the vectors of smallest sha256 of ``seed:id``; of rows that repeat an
    identifier the smaller vector comes first, a null identifier counts as an
    empty text. With fewer vectors than ``clusters`` there are as many centroids
    as vectors; none at all give an empty result. Equal vectors are assigned
    alike. A component whose multiple is 2**22 or more is an error, since
    exact distances could pass 64 bits. Columns that carry a result's name are replaced, the others kept.
    """
    rows = rows.drop(*RESULT)
    columns = [c for c in rows.columns if c != vector_col]
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    packed = quantised(rows.select(
        F.struct(*[f"`{c}`" for c in columns]).alias("_row"), F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("_h"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("_v")), dims, scale)
    first = packed.orderBy("_h", "_q").limit(clusters).select("_q").collect()  # a bounded number of rows
    if not first:
        empty = packed.select("_row.*").limit(0)
        return empty.selectExpr("*", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
                                "'' AS centroid_sha256")
    centroids = np.array([r["_q"] for r in first], np.int64)
    fixed = choose_pivots(centroids, pivots)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = to_pivots(_vectors(b.column("_q"), dims).astype(np.int64), fixed)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(far), pa.list_(pa.float64()))],
                                             names=[*b.schema.names, "_d"])

    packed = packed.drop("_h")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema)
    stored = materialize(packed.mapInArrow(table, f"{fields}, _d array<double>"), "centroids-pivots")
    for _ in range(rounds):
        centroids = _moved(stored, centroids, fixed)
    assigned = materialize(_assign(stored, centroids, fixed), "centroids-assigned")
    inertia = {r["_cluster"]: int(r["s"]) for r in  # one row per centroid
               assigned.groupBy("_cluster").agg(F.sum(F.col("_distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("_cluster"))
    return assigned.select(
        "_row.*", F.col("_cluster").alias("cluster"), F.col("_distance").alias("distance"),
        pick([inertia.get(c, 0) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), pick(digest).alias("centroid_sha256"))
