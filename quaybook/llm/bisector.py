"""Centroid clustering by bisector tournaments, in exact integers.

Components are scaled and floored to integers. For centroids a < b a vector x
is nearer to b exactly if x . 2(b - a) > |b|^2 - |a|^2: one linear sign test
against the bisecting plane of the pair. The normals and thresholds of all
pairs are made once for a round, from the centroids alone. A vector's nearest
centroid is then found by a tournament: number 0 meets number 1, the winner
meets number 2, and so on; k - 1 sign tests leave one, and a test of zero (a
tie) is won by the smaller number. Only the winner's distance is computed.

A round is one pass over the written integer vectors: of each Arrow batch one
sum and count per cluster leave the task, so a hot cluster is a few small
rows; they are added in Spark as decimals, and k times dim numbers come to
the driver, where each non-empty centroid becomes the floor of its mean. Rounds depend on centroids only, so a lost executor costs its own
tasks of one round.

Vectors that are null, have another number of components, or hold a null or
non-finite one are left out. Repeated rows count as rows of their own. A null
id is kept; for the choice of starts it is the empty text. Rows with equal
ids are told apart by their vectors, the smaller first. Fewer vectors than
``k`` give as many centroids as there are vectors; an empty input gives an
empty result. Integers too large for exact 64-bit distances raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import pick, prepare
from quaybook.plans.stages import write_stage

SCALE = 64
DIM = 64
K = 16
ROUNDS = 3
SEED = "1"
MAX_PAIR_VALUES = 1 << 24  # of all pairs' normals in a task; bounds k


def finite_vector(vector: Column, dim: int | None = None) -> Column:
    """Whether a vector has no null or non-finite component (and ``dim`` of them)."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good if dim is None else good & (F.size(vector) == dim), F.lit(False))


def integer_vectors(rows: DataFrame, scale: int = SCALE, dim: int = DIM, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """(vec_id, point) of the rows that take part: floor(scale * x) per component."""
    limit = int((2**30) / dim**0.5)  # dim * limit * 4 limit < 2**63
    given = pick(rows, vec_id=id_col, vector=vector_col).withColumn("vector", F.col("vector").cast("array<double>"))
    kept = given.where(finite_vector(F.col("vector"), dim))
    wide = F.exists("vector", lambda x: F.abs(scale * x) >= limit)
    message = F.lit(f"a component times {scale} reaches {limit}: distances would not be exact")
    return kept.select("vec_id", F.when(wide, F.raise_error(message).cast("array<bigint>")).otherwise(
        F.transform("vector", lambda x: F.floor(scale * x))).alias("point"))


def starts(points: DataFrame, k: int = K, seed: str = SEED) -> np.ndarray:
    """The points of the k smallest hashes of ``seed:id``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = points.select(order.alias("place"), "point").orderBy("place", "point").limit(k).collect()
    return np.array([r.point for r in chosen], dtype=np.int64)


class Tournament:
    """Bisecting planes of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        square = (centroids * centroids).sum(axis=1)
        # Entry j: the planes between j and every smaller number.
        self.normals = [2 * (c - centroids[:j]) for j, c in enumerate(centroids)]
        self.thresholds = [square[j] - square[:j] for j in range(len(centroids))]

    def nearest(self, points: np.ndarray) -> np.ndarray:
        winner = np.zeros(len(points), dtype=np.int64)
        for j in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", points, self.normals[j][winner]) - self.thresholds[j][winner]
            winner[side > 0] = j
        return winner

    def distance(self, points: np.ndarray, winner: np.ndarray) -> np.ndarray:
        off = points - self.centroids[winner]
        return np.einsum("ij,ij->i", off, off)


def _points_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def next_centroids(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each non-empty centroid's floored mean of its vectors; others stay."""
    k, dim = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(centroids)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _points_of(batch.column(0), dim)
            winner = tournament.nearest(rows)
            some, place, n = np.unique(winner, return_inverse=True, return_counts=True)
            total = np.zeros((len(some), dim), dtype=np.int64)
            np.add.at(total, place, rows)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n.astype(np.int64)),
                                              pa.array(total.tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    parts = points.select("point").mapInArrow(sums, "cluster long, n long, total array<long>")
    found = (parts.select("cluster", "n", F.posexplode("total").alias("place", "part"))
             .groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
             .collect())  # k * dim rows at most
    new = centroids.copy()
    for r in found:
        new[r.cluster, r.place] = int(r.total) // r.n
    return new


def assign(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every point."""
    dim = centroids.shape[1]
    id_type = points.schema["vec_id"].dataType

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tournament = Tournament(centroids)
        for batch in batches:
            rows = _points_of(batch.column(1), dim)
            winner = tournament.nearest(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(winner.astype(np.int32)),
                                              pa.array(tournament.distance(rows, winner))],
                                             names=["vec_id", "cluster", "distance"])

    return points.select("vec_id", "point").mapInArrow(
        label, f"vec_id {id_type.simpleString()}, cluster int, distance long")


def cluster(rows: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, seed: str = SEED,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every vector that takes part, the final
    centroids)."""
    if k * k * dim // 2 > MAX_PAIR_VALUES:
        raise ValueError(f"{k} centroids of {dim} components exceed {MAX_PAIR_VALUES} values of pair normals")
    prepare(rows.sparkSession)
    points = write_stage(integer_vectors(rows, scale, dim, id_col, vector_col), "points")
    centroids = starts(points, k, seed)
    if not len(centroids):
        return points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = next_centroids(points, centroids)
    return write_stage(assign(points, centroids), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia and the centroid's components as text.
    Only one row per cluster is aggregated to the driver and broadcast."""
    spark = assigned.sparkSession
    found = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    whole = sum(int(r.inertia) for r in found)
    table = [(r.cluster, int(r.inertia), whole, ",".join(map(str, centroids[r.cluster]))) for r in found]
    sides = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid string")
    return assigned.join(F.broadcast(sides), "cluster")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
