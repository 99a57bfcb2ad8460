"""Exact top-k by integer inner product, with MaxScore over impact postings.

Vectors become integers, floor(1024 * x). A shard keeps for every dimension two postings, the rows with a positive and
those with a negative component. For a query, the terms are the dimensions with the sign that adds to the score; each
has a bound, its largest contribution in the shard. The smallest terms whose bounds together stay below the k-th best
score so far are non-essential: a row that occurs in no essential posting can't reach it. Essential postings are
traversed and summed, rows that can't reach the score with all that is left are dropped, and the others are probed in
the remaining dimensions while competitive. The results of the shards are merged by a window with a group limit.

Work is laid out as cells of ``QUERY_BLOCK`` queries by ``SHARD`` rows, so no task gets more than a cell, and nothing is
broadcast or collected.

Defined cases: vectors that are null or hold null or non-finite components, and rows without an id, take no part; an
empty vector is as good as zeros, as are components that the shorter of two vectors lacks. Rows that repeat an id are
candidates each, but never of a query of the same id; equal query rows count once. A cell whose sums might leave 64 bits
is added up in Python's integers; a component or score beyond 64 bits is an error. No queries give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderline.llm.vectors import longs, matrix, whole_vectors
from ladderline.session import stage

SCALE, QUERY_BLOCK, SHARD = 1024, 1024, 2048

def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the vectors that take part."""
    return whole_vectors(vectors, SCALE, id_col, vector_col).where("id IS NOT NULL").withColumnRenamed("id", "vec_id")


class _Shard:
    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.top, self.low = x.max(axis=0), x.min(axis=0)
        self.postings = [[np.flatnonzero(c > 0), np.flatnonzero(c < 0)] for c in x.T]

    def best(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of at least the ``k`` best, own id left out."""
        mine = self.ids != own
        first = np.flatnonzero(mine[: 8 * k])
        floor = np.sort(self.x[first] @ q)[-k] if len(first) >= k else None
        bound = np.where(q > 0, self.top, self.low) * q  # the largest contribution of each dimension, maybe negative
        gain = np.maximum(bound, 0)
        order = np.argsort(-gain, kind="stable")
        behind = gain[order][::-1].cumsum()[::-1]
        essential = len(order) if floor is None else int(np.count_nonzero(behind >= floor))
        total = np.zeros(len(self.ids), dtype=self.x.dtype)
        seen = np.zeros(len(self.ids), dtype=bool)
        if floor is None or floor <= 0:
            seen[:] = True  # a row outside all postings scores 0 or less and may still be among the best
        head, tail = order[:essential], order[essential:]
        for d in head:
            if q[d]:
                at = self.postings[d][0 if q[d] > 0 else 1]
                total[at] += q[d] * self.x[at, d]
                seen[at] = True
        rows = np.flatnonzero(seen & mine)
        if floor is not None:
            rows = rows[total[rows] + (behind[essential] if essential < len(order) else 0) >= floor]
        scores = self.x[np.ix_(rows, head)] @ q[head] if len(head) else np.zeros(len(rows), dtype=self.x.dtype)
        left = np.append(bound[tail][::-1].cumsum()[::-1], 0)
        for first in range(0, len(tail), 8):
            if floor is not None:
                near = scores + left[first] >= floor
                rows, scores = rows[near], scores[near]
            dims = tail[first : first + 8]
            scores = scores + self.x[np.ix_(rows, dims)] @ q[dims]
        chosen = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[chosen], scores[chosen]


def _cell(k: int):
    def run(cell: pa.Table) -> pa.Table:
        values = cell.column("v").combine_chunks()
        x = matrix(values, int(np.diff(values.offsets.to_numpy()).max(initial=0)))
        top = int(np.abs(x).max(initial=0))
        if x.shape[1] * top * top >= 1 << 62:
            x = x.astype(object)
        ids, asks = cell.column("vec_id").to_numpy(), cell.column("ask").to_numpy()
        out = {"query_id": [], "ask": [], "vec_id": [], "score": []}
        if (asks == 0).any():
            shard = _Shard(ids[asks == 0], x[asks == 0])
            for at in np.flatnonzero(asks != 0):
                rows, scores = shard.best(ids[at], x[at], k)
                out["query_id"].append(np.full(len(rows), ids[at]))
                out["ask"].append(np.full(len(rows), asks[at]))
                out["vec_id"].append(shard.ids[rows])
                out["score"].append(scores)
        flat = {c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in out.items()}
        return pa.table({c: longs(v) for c, v in flat.items()})

    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of every row whose id is divisible by ``every``."""
    rows = stage(quantised(vectors, id_col, vector_col), "vectors")
    asks = rows.where(F.col("vec_id") % every == 0).distinct()
    shards, blocks = max(1, -(-rows.count() // SHARD)), max(1, -(-asks.count() // QUERY_BLOCK))
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(n))
    # a query is told apart from others of its id by a hash that is never 0; 0 marks candidates
    ask = F.xxhash64("v").bitwiseOR(F.lit(1))
    out = asks.select(spread(blocks, 1).alias("b"), F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("s"), ask.alias("ask"), "vec_id", "v")
    held = rows.select(F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("b"), spread(shards, 2).alias("s"), F.lit(0).cast("bigint").alias("ask"), "vec_id", "v")
    found = out.unionByName(held).groupBy("b", "s").applyInArrow(_cell(k), "query_id bigint, ask bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
