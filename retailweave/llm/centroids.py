"""Exact k-means on integer vectors by Shallot search.

Every vector keeps its centroid, the second-nearest one that it last found, an upper bound of the distance to
the former and a lower bound of the distances to all others. After the centroids have moved, a vector

* keeps its centroid if the bounds, or half the distance from it to the nearest other centroid, say that no other can be as near;
* else computes the distances to its two centroids, and begins at the closer one;
* goes through the other centroids in the order of their distance from that one, as far as a ball of radius
  "distance to the first centroid plus distance to the second-nearest so far" reaches. The ball shrinks whenever a nearer
  centroid is found, and a centroid outside of it is farther away than the second-nearest.

Bounds are floating-point numbers, rounded away from each other. Whatever they leave is compared in
integers, so the result is that of comparing every vector with every centroid.

Vectors stay in their partitions; a round writes their state and sums up components by centroid. Only the centroids, k of
them, pass the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailweave.llm.batches import quoted
from retailweave.sinks.scratch import written

CENTROIDS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
MAX_CENTROIDS = 4096  # they are held by every task, with their distances from each other
MAX_COMPONENT = 1 << 27  # with 64 components, squared distances and what is added to them fit in 64 bits

_WIDER, _NARROWER = 1 + 1e-12, 1 - 1e-12
_ROWS = 1 << 14  # vectors that are worked on at a time
_STATE = "cluster int, second int, upper double, lower double, distance long"


@dataclass(frozen=True)
class Clustering:
    """``vectors``: ``id``, ``vector`` (integers), ``cluster``, ``distance`` (squared) of every kept row. ``centroids``: final components."""

    vectors: DataFrame
    centroids: list[tuple[int, ...]]


def integer_vector(vector: Column, dimensions: int = DIMENSIONS, scale: int = SCALE) -> Column:
    """The vector with floor(scale * x) for each component x, or null if it is not ``dimensions`` finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when((F.size(vector) == dimensions) & F.coalesce(finite, F.lit(False)), scaled)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[tuple[int, ...]]:
    """The ``k`` vectors with the smallest hexadecimal SHA-256 of ``seed:id``, in that order; without an id, the last ones."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(k).collect()
    return [tuple(row.vector) for row in rows]


class Search:
    """Finds the nearest of some centroids for batches of vectors and their state. The smaller number wins a tie.

    ``before`` are the centroids that the state was computed for.
    """

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        self.centroids = centroids.astype(np.int64)
        k = len(centroids)
        between = np.sqrt(np.stack([self._squares(self.centroids, np.full(k, j)) for j in range(k)]).astype(np.float64))
        # The other centroids of each, by distance from it.
        np.fill_diagonal(between, -1.0)
        self.order = np.argsort(between, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(between, self.order, axis=1) * _NARROWER
        self.half = self.apart[:, 0] / 2 * _NARROWER if k > 1 else np.full(k, np.inf)
        if before is not None:
            moved = np.sqrt(((self.centroids - before) ** 2).sum(axis=1).astype(np.float64)) * _WIDER
            self.moved = moved
            # How far any centroid but one has moved.
            farthest = int(np.argmax(moved))
            self.others_moved = np.full(k, moved[farthest])
            self.others_moved[farthest] = np.delete(moved, farthest).max(initial=0.0)

    def _squares(self, vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        """The exact squared distance of each vector from its centroid."""
        away = vectors - self.centroids[centroid]
        return np.einsum("ij,ij->i", away, away)

    def begin(self, vectors: np.ndarray) -> tuple[np.ndarray, ...]:
        """The state of vectors of which nothing is known yet."""
        n = len(vectors)
        second = np.full(n, min(1, len(self.centroids) - 1))
        return self._search(vectors, np.zeros(n, np.int64), second)

    def next(self, vectors: np.ndarray, cluster: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cluster, second-nearest, upper and lower bound after the centroids moved."""
        upper = (upper + self.moved[cluster]) * _WIDER
        lower = np.maximum(lower - self.others_moved[cluster], 0.0) * _NARROWER
        bound = np.maximum(lower, self.half[cluster])
        left = np.flatnonzero(~(upper < bound))
        upper[left] = _up(self._squares(vectors[left], cluster[left]))
        left = left[~(upper[left] < bound[left])]
        cluster, second = cluster.copy(), second.copy()
        cluster[left], second[left], upper[left], lower[left] = self._search(vectors[left], cluster[left], second[left])
        return cluster, second, upper, lower

    def _search(self, vectors: np.ndarray, cluster: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
        n, k = len(vectors), len(self.centroids)
        best, best_square = cluster.copy(), self._squares(vectors, cluster)
        if k == 1:
            return best, second, _up(best_square), np.full(n, np.inf)
        next_best, next_square = second.copy(), self._squares(vectors, second)
        _swap(best, best_square, next_best, next_square)
        start, radius = best.copy(), _up(best_square)
        scanned = np.arange(n)
        for nth in range(k - 1):
            # Farther from the start than this, a centroid is farther from the vector than its second-nearest.
            ball = radius[scanned] + _up(next_square[scanned])
            scanned = scanned[self.apart[start[scanned], nth] <= ball]
            if not len(scanned):
                break
            other = self.order[start[scanned], nth]
            new = (other != best[scanned]) & (other != next_best[scanned])
            rows, other = scanned[new], other[new]
            square = self._squares(vectors[rows], other)
            nearer = (square < next_square[rows]) | (square == next_square[rows]) & (other < next_best[rows])
            rows = rows[nearer]
            next_best[rows], next_square[rows] = other[nearer], square[nearer]
            _swap(best, best_square, next_best, next_square, rows)
        return best, next_best, _up(best_square), _down(next_square)

    def distances(self, vectors: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        return self._squares(vectors, cluster)


def _up(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * _WIDER


def _down(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * _NARROWER


def _swap(best, best_square, next_best, next_square, rows=None) -> None:
    """Puts the nearer of two centroids first; of equally near ones the one with the smaller number."""
    rows = np.arange(len(best)) if rows is None else rows
    wrong = (next_square[rows] < best_square[rows]) | (next_square[rows] == best_square[rows]) & (next_best[rows] < best[rows])
    rows = rows[wrong]
    best[rows], next_best[rows] = next_best[rows], best[rows]
    best_square[rows], next_square[rows] = next_square[rows], best_square[rows]


def cluster(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = 1,
) -> Clustering:
    """Clusters the rows whose vector is ``dimensions`` finite numbers, on floor(scale * x) of each component x.

    The centroids begin as ``first_centroids``. Each round assigns all vectors and replaces every centroid that has any by
    the componentwise floor of their exact mean; at the end all vectors are assigned once more. Other rows are left
    out. Rows with a null or repeated id are vectors of their own; of rows with the same hash the smaller vector comes first.
    Fewer than ``k`` vectors are as many centroids, and none give an empty result. Other columns are not looked at.
    A component beyond ``MAX_COMPONENT`` is an error, since its squared distances would not fit in 64 bits.
    """
    if not 1 <= k <= MAX_CENTROIDS:
        raise ValueError(f"between 1 and {MAX_CENTROIDS} centroids, not {k}")
    rows = df.select(quoted(id_column).alias("id"), integer_vector(quoted(vector), dimensions, scale).alias("vector"))
    rows = rows.where("vector is not null")
    too_large = F.exists("vector", lambda x: F.abs(x) > MAX_COMPONENT)
    rows = rows.withColumn("vector", F.when(too_large, F.raise_error(F.lit("a component is too large"))).otherwise(F.col("vector")).cast("array<int>"))
    rows = written(rows)
    centroids = first_centroids(rows, k, seed)
    before: list[tuple[int, ...]] | None = None
    if centroids:
        for _ in range(rounds):
            rows = written(_assigned(rows, centroids, before))
            before, centroids = centroids, _means(rows, centroids)
        rows = written(_assigned(rows, centroids, before))
        return Clustering(rows.select("id", "vector", "cluster", "distance"), centroids)
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("cluster", "int"), ("distance", "long"))]
    return Clustering(rows.select("id", "vector", *nothing), [])


def _assigned(rows: DataFrame, centroids: list[tuple[int, ...]], before: list[tuple[int, ...]] | None) -> DataFrame:
    """``id``, ``vector`` and the state of every vector for ``centroids``; ``rows`` has that for ``before``."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((np.array(centroids, np.int64), None if before is None else np.array(before, np.int64)))
    source = rows.select("id", "vector", *(() if before is None else ("cluster", "second", "upper", "lower")))
    schema = T.StructType([rows.schema["id"], rows.schema["vector"], *T.StructType.fromDDL(_STATE).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then = shared.value
        search = Search(now, then)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                piece = batch.slice(at, _ROWS)
                vectors = np.asarray(pc.list_flatten(piece.column(1))).astype(np.int64).reshape(piece.num_rows, -1)
                if then is None:
                    state = search.begin(vectors)
                else:
                    state = search.next(vectors, *(np.array(column) for column in piece.columns[2:]))
                cluster, second, upper, lower = state
                distance = search.distances(vectors, cluster)
                kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
                added = [pa.array(x, kind) for x, kind in zip((cluster.astype(np.int32), second.astype(np.int32), upper, lower, distance), kinds)]
                yield pa.RecordBatch.from_arrays([*piece.columns[:2], *added], schema.names)

    return source.mapInArrow(run, schema)


def _means(rows: DataFrame, centroids: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """The floor of the mean of each centroid's vectors, or the centroid itself where it has none."""
    n = len(centroids[0])
    sums = [F.sum(F.get("vector", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(n)]
    found = {row.cluster: row for row in rows.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()}
    return [
        tuple(found[j][f"s{i}"] // found[j].n for i in range(n)) if j in found else centroid for j, centroid in enumerate(centroids)
    ]


def with_inertia(clustering: Clustering) -> DataFrame:
    """``id``, ``cluster`` and ``distance`` of every vector, with ``cluster_inertia`` and ``inertia`` (distance summed up over
    its cluster and over all) and ``centroid``, the final components of its centroid."""
    vectors = clustering.vectors
    spark = vectors.sparkSession
    sums = {row.cluster: row.total for row in vectors.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    total = sum(sums.values()) if clustering.centroids else None
    # One row for each centroid, at most MAX_CENTROIDS.
    known = [(j, sums.get(j, 0), total, list(centroid)) for j, centroid in enumerate(clustering.centroids)]
    table = spark.createDataFrame(known, "of int, cluster_inertia long, inertia long, centroid array<long>")
    joined = vectors.join(F.broadcast(table), F.col("cluster") == F.col("of"), "left")
    return joined.select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
