"""Centroid clustering in integers by a tournament of bisectors.

For two centroids i < j the sign of 2 (cj - ci) . x - (|cj|^2 - |ci|^2) says which of them is nearer to x: above zero j, else
i, so a vector on the bisector goes to the smaller number. Normals and thresholds of all pairs are made once a round and
broadcast; their size is k^2 times the dimensions, both parameters. A vector plays a knock-out of k - 1 such tests: each
removes one centroid, and the last one left is the nearest. Only its distance is then worked out. Everything is whole
numbers, so the result does not depend on how the rows are dealt over tasks.

Each task adds up its own vectors per centroid before anything is shuffled, so a cluster that holds most rows costs no more
than any other. The driver sees sums per centroid and component only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.llm.ship import ship, unpack
from millpulse.session import work_dir

CLUSTERS, DIMS, ROUNDS = 40, 64, 5
SCALE = 256
SEED = "2"
LARGEST = 2**26  # of a component; sums of squares over 64 of them stay below 2^63
EXACT_IN_FLOAT = 2**19  # components up to this size give products that doubles hold exactly
STEP = 4_096  # vectors that play at once


@dataclass
class Bisectors:
    """Centroids with the normal and threshold of each pair (i, j), i < j."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Bisectors:
        squares = (centroids**2).sum(1)
        return cls(centroids, 2 * (centroids[None] - centroids[:, None]), squares[None] - squares[:, None])

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each point; of equally near ones the smallest."""
        kind = float if max(np.abs(points).max(initial=0), np.abs(self.centroids).max()) <= EXACT_IN_FLOAT else np.int64
        points, k = points.astype(kind), len(self.centroids)
        normals, thresholds = self.normals.astype(kind), self.thresholds.astype(kind)
        # All points meet the same pairs in the first round; later each point has players of its own.
        first = np.arange(0, k - 1, 2)
        beaten = points @ normals[first, first + 1].T > thresholds[first, first + 1]
        left = first + beaten
        if k % 2:
            left = np.column_stack([left, np.full(len(points), k - 1)])
        while left.shape[1] > 1:
            winners = []
            for at in range(0, left.shape[1] - 1, 2):
                # The numbers on the left side of the table are all smaller than those on the right.
                i, j = left[:, at], left[:, at + 1]
                winners.append(np.where(np.einsum("nd,nd->n", points, normals[i, j]) > thresholds[i, j], j, i))
            if left.shape[1] % 2:
                winners.append(left[:, -1])
            left = np.column_stack(winners)
        return left[:, 0]


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, dims: int = DIMS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per vector that takes part.

    Takes `vec_id` and `embedding`; other columns are ignored. Vectors of another length than `dims`, NULL ones and those
    with a NULL, NaN or infinite component take no part. Components become floor(scale * x). Rows that repeat an id are
    vectors of their own, also when they start as centroids; a NULL id counts as empty text in the starting order. With
    fewer vectors than `clusters` all of them start. An empty table gives no rows. A component beyond 2^26 after scaling
    fails the job, since squared distances would not fit a long.
    """
    spark = vectors.sparkSession
    folder = work_dir(spark, "clusters")
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    sound = (F.size("embedding") == dims) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    usable = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(sound)
    usable.mapInArrow(_whole_numbers(dims, scale), f"vec_id {id_type}, point binary").write.parquet(f"{folder}/points")
    points = spark.read.parquet(f"{folder}/points")

    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    start = points.orderBy(order, "point").limit(clusters).collect()
    if not start:
        schema = f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    centroids = np.array([np.frombuffer(r.point, "<i4") for r in start], dtype=np.int64)
    for _ in range(rounds):
        centroids = _moved(points, centroids, dims)

    points.mapInArrow(_assigned(ship(spark, Bisectors.of(centroids)), dims), f"vec_id {id_type}, cluster int, distance long").write.parquet(
        f"{folder}/assigned"
    )
    assigned = spark.read.parquet(f"{folder}/assigned")
    inertia = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per_cluster = spark.createDataFrame(  # at most `clusters` rows
        [(c, inertia[c], sum(inertia.values()), prints[c]) for c in sorted(inertia)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _moved(points: DataFrame, centroids: np.ndarray, dims: int) -> np.ndarray:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays."""
    partial = points.mapInArrow(_sums(ship(points.sparkSession, Bisectors.of(centroids)), dims), "cluster int, sums array<long>")
    sums = partial.select("cluster", F.posexplode("sums").alias("at", "value")).groupBy("cluster", "at").agg(F.sum("value").alias("total"))
    totals = {(r.cluster, r.at): r.total for r in sums.collect()}
    return np.array([
        [totals[c, at] // totals[c, dims] for at in range(dims)] if (c, dims) in totals else centroids[c] for c in range(len(centroids))
    ], dtype=np.int64)


Batches = Iterator[pa.RecordBatch]


def _whole_numbers(dims: int, scale: int) -> Callable[[Batches], Batches]:
    def convert(batches: Batches) -> Batches:
        for batch in batches:
            values = np.asarray(batch.column(1).flatten(), dtype=float).reshape(batch.num_rows, dims)
            scaled = np.floor(scale * values)
            if np.abs(scaled).max(initial=0) > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            rows = scaled.astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["vec_id", "point"])

    return convert


def _steps(batches: Batches, dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and points, a bounded number at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            rows = b"".join(part.column("point").to_pylist())
            yield part.column("vec_id"), np.frombuffer(rows, "<i4").reshape(-1, dims).astype(np.int64)


def _sums(shipped, dims: int) -> Callable[[Batches], Batches]:
    def add(batches: Batches) -> Batches:
        bisectors = unpack(shipped)
        totals = np.zeros((len(bisectors.centroids), dims + 1), dtype=np.int64)
        for _, points in _steps(batches, dims):
            winners = bisectors.nearest(points)
            order = np.argsort(winners, kind="stable")
            found, starts = np.unique(winners[order], return_index=True)
            totals[found, :dims] += np.add.reduceat(points[order], starts)
            totals[found, dims] += np.diff(np.append(starts, len(order)))
        held = np.flatnonzero(totals[:, dims])
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(totals[held].tolist(), pa.list_(pa.int64()))], ["cluster", "sums"]
        )

    return add


def _assigned(shipped, dims: int) -> Callable[[Batches], Batches]:
    def assign(batches: Batches) -> Batches:
        bisectors = unpack(shipped)
        for ids, points in _steps(batches, dims):
            winners = bisectors.nearest(points)
            distance = ((points - bisectors.centroids[winners]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([ids, pa.array(winners, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return assign
