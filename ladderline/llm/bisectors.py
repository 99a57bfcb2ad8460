"""Centroid clustering with a bisector tournament.

Vectors are whole numbers, ``floor(scale * x)``. For centroids ``a`` and ``b`` with ``a < b`` by number, ``2 (b - a) x`` is
above ``b*b - a*a`` if and only if ``x`` is nearer to ``b``. Normals and thresholds of all pairs are computed once a
round. A vector's nearest centroid is then found with one such test per further centroid: the winner so far meets the next
number, and a tie, the test being zero, leaves the smaller number, which the winner always has. Only the last round's
winner gets a distance, which is exact.

A round is one pass over the vectors: tasks return sums by cluster, Spark adds them up, and the ``k`` new centroids go
out with the next pass. All rows take part in every round. Nothing but ``k`` centroids, and ``k`` sums, reaches the driver.

Defined cases: vectors that are null, hold null or non-finite components or have another length take no part. Repeated
rows count each. Seeds are different ids; of rows that repeat an id the least vector is the seed; rows without an id seed
after all others. Fewer ids than ``k`` give fewer centroids, no rows give none. A number beyond 64 bits is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.llm.vectors import exact, first_vectors, floor_means, longs, matrix, whole_vectors
from ladderline.session import stage


class Tournament:
    """Nearest of ``centroids`` by sign tests."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        wide = centroids.astype(object)
        squares = (wide * wide).sum(axis=1)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])  # [a, b]: 2 (b - a)
        self.thresholds = squares[None, :] - squares[:, None]  # [a, b]: b*b - a*a

    def winners(self, x: np.ndarray) -> np.ndarray:
        top = int(np.abs(x).max(initial=0))
        largest = max(int(np.abs(self.normals).max(initial=0)) * top * x.shape[1], int(np.abs(self.thresholds).max(initial=0)))
        kind = np.float64 if largest < 1 << 52 else np.int64 if largest < 1 << 62 else object
        x, normals, thresholds = x.astype(kind), self.normals.astype(kind), self.thresholds.astype(kind)
        best = np.zeros(len(x), dtype=np.int64)
        for b in range(1, len(self.centroids)):
            # the normals of (winner, b) for all winners that are left, one product per winner that occurs
            for a in np.unique(best):
                held = np.flatnonzero(best == a)
                best[held[(x[held] @ normals[a, b]) > thresholds[a, b]]] = b
        return best

    def distances(self, x: np.ndarray, winners: np.ndarray) -> np.ndarray:
        x, centroids = exact(x, self.centroids)
        gap = x - centroids[winners]
        return (gap * gap).sum(axis=1)


def _sums(centroids: list[list[int]], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contest = Tournament(np.array(centroids, dtype=np.int64))
        n = np.zeros(len(centroids), dtype=np.int64)
        total = np.zeros((len(centroids), width), dtype=object)
        for batch in batches:
            x = matrix(batch.column("v"), width)
            best = contest.winners(x)
            for c in np.unique(best):
                mine = x[best == c]
                n[c] += len(mine)
                total[c] += mine.sum(axis=0, dtype=np.int64 if len(mine) * int(np.abs(mine).max()) < 1 << 62 else object)
        some = np.flatnonzero(n)
        yield pa.record_batch({"cluster": pa.array(some, pa.int32()), "n": pa.array(n[some], pa.int64()), "total": pa.array(total[some].tolist(), pa.list_(pa.int64()))})

    return run


def _placed(centroids: list[list[int]], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contest = Tournament(np.array(centroids, dtype=np.int64))
        for batch in batches:
            x = matrix(batch.column("v"), width)
            best = contest.winners(x)
            yield pa.record_batch({"id": batch.column("id"), "cluster": pa.array(best, pa.int32()), "distance": longs(contest.distances(x, best))})

    return run


def clustered(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    width: int = 64,
    seed: int = 1,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """``(id, cluster, distance)`` of the vectors with ``width`` components, and the centroids.

    Centroids start as the ``k`` vectors with the smallest hexadecimal sha256 of ``seed:id``; each of ``rounds`` rounds
    assigns all vectors and moves every centroid that has some to the floor of their mean."""
    sized = vectors.where(F.size(vector_col) == width)
    rows = stage(whole_vectors(sized, scale, id_col, vector_col), "whole-vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("seed_id").cast("string")), 256)
    centroids = first_vectors(rows, name, k)
    if not centroids:
        return rows.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(_sums(centroids, width), "cluster int, n bigint, total array<bigint>")
        for (cluster,), mean in floor_means(sums, ["cluster"]).items():
            centroids[cluster] = mean
    placed = rows.mapInArrow(_placed(centroids, width), "id bigint, cluster int, distance bigint")
    return stage(placed, "clustered"), centroids


def with_inertia(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``placed`` with the summed distances of its cluster and of all, and its centroid's sha256 over ``,``-joined components.

    One row per centroid is joined to all rows."""
    names = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    whole = int(sum(r["s"] for r in sums))
    by = {r["cluster"]: int(r["s"]) for r in sums}
    spark = placed.sparkSession
    facts = spark.createDataFrame([(c, by.get(c, 0), whole, name) for c, name in names], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster")
