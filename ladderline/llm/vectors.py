"""Vectors of whole numbers, taken from Arrow batches, with squared distances that are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAFE = 1 << 26
"""Components below it, of up to 512 a vector, have squared distances below 2**63."""


def usable(vector: Column) -> Column:
    """True for a vector that is not null and holds neither null nor non-finite components."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole(component: Column, scale: int) -> Column:
    """``floor(scale * component)`` as bigint; a value beyond 64 bits is an error, not another number."""
    scaled = component.cast("double") * scale
    return F.when(F.abs(scaled) < float(1 << 62), F.floor(scaled)).otherwise(F.raise_error(F.lit("a component is beyond 64 bits")).cast("bigint"))


def whole_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str, *others: str) -> DataFrame:
    """``(id bigint, v array<bigint>, *others)`` of the rows with a usable vector."""
    named = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("x"), *others)
    return named.where(usable(F.col("x"))).select("id", F.transform("x", lambda c: whole(c, scale)).alias("v"), *others)


def matrix(values: pa.Array, width: int) -> np.ndarray:
    """Rows of an array of lists as a matrix; components that a row lacks are 0."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    lengths = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def exact(*arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays in a number type in which sums of their squares and products are exact.

    That is 64-bit floats while the sums stay below 2**53, which multiply fastest, then 64-bit integers, then Python's."""
    top = max((int(np.abs(a).max(initial=0)) for a in arrays), default=0)
    width = max(a.shape[-1] for a in arrays)
    kind = np.float64 if 4 * width * top * top < 1 << 53 else np.int64 if top < SAFE and width <= 512 else object
    return tuple(a.astype(kind) for a in arrays)


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all ``entries``."""
    x, entries = exact(x, entries)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T)) + (entries * entries).sum(axis=1)


def longs(values: np.ndarray) -> pa.Array:
    """A column of 64-bit integers; a value that doesn't fit is an error."""
    return pa.array(values.tolist() if values.dtype == object else values.astype(np.int64), pa.int64())


def first_vectors(rows: DataFrame, order: Column, n: int) -> list[list[int]]:
    """The vectors of the ``n`` ids that come first by ``order``, of ``seed_id`` (a null id is one that comes last), ascending.

    Of rows that repeat an id, the least vector counts. No more than ``n`` rows reach the driver."""
    place = [F.asc_nulls_last("by"), F.asc_nulls_last("seed_id")]
    ids = rows.select(F.col("id").alias("seed_id")).distinct().withColumn("by", order).orderBy(*place).limit(n)
    seeds = rows.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("seed_id"))).groupBy("by", "seed_id").agg(F.min("v").alias("v"))
    return [list(r["v"]) for r in seeds.orderBy(*place).collect()]


def floor_means(sums: DataFrame, keys: list[str]) -> dict[tuple, list[int]]:
    """Componentwise ``floor(sum / count)`` by key, from partial ``(*keys, n, total array<bigint>)``.

    Totals are added up as decimals of 38 digits; as many rows as there are entries reach the driver."""
    parts = sums.select(*keys, "n", F.posexplode("total").alias("d", "t"))
    found = parts.groupBy(*keys, "d").agg(F.sum("n").alias("n"), F.sum(F.col("t").cast("decimal(20,0)")).alias("t")).collect()
    out: dict[tuple, list[int]] = {}
    for r in sorted(found, key=lambda r: r["d"]):
        out.setdefault(tuple(r[k] for k in keys), []).append(int(r["t"]) // r["n"])
    return out
