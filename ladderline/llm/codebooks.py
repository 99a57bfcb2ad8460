"""Vector code compression: product codes whose codebooks come from active-entry Lloyd rounds.

Vectors are whole numbers, ``floor(scale * x)``, cut into equal consecutive parts with a codebook each. A round assigns
every part to the nearest entry of its codebook and then moves each entry that has parts to the floor of their mean.
Between rounds every part keeps its entry and the exact distance to it. Where that entry did not move in the last update,
the kept distance still holds and no entry that stayed can have become nearer, so the part is compared with the moved
entries alone; the other parts scan the codebook. Among equal distances the lower index wins in both cases.

A round reads the staged vectors with the state of the last round and writes them with the new one, which needs no shuffle,
and sums by part and entry are added up in Spark. The driver holds the codebooks only. A round's table is removed once
the next one is written.

Defined cases: vectors that are null or hold null or non-finite components take no part; components that a vector lacks
to the longest one's length, rounded up to a multiple of ``parts``, are 0. Repeated rows count each. Codebooks start with
different ids; of rows that repeat an id the least vector counts; rows without an id come after all others. Fewer ids than
``entries`` give smaller codebooks, no rows give no codes. A number beyond 64 bits is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.llm.vectors import first_vectors, floor_means, longs, matrix, squared_distances, whole_vectors
from ladderline.session import stage, unstage

Codebooks = list[list[list[int]]]
"""By part, by entry, the components."""

STATE = "id bigint, v array<bigint>, label string, codes array<int>, distances array<bigint>"


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lower of equal ones, and the squared distance to it."""
    gaps = squared_distances(x, entries)
    code = gaps.argmin(axis=1)
    return code, gaps[np.arange(len(x)), code]


def active_nearest(x: np.ndarray, entries: np.ndarray, code: np.ndarray, distance: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the state of the last round: a part on a fixed entry looks at the ``moved`` ones only."""
    code, distance = code.copy(), distance.astype(object if distance.dtype == object else np.int64)
    again = moved[code]
    if again.any():
        code[again], distance[again] = nearest(x[again], entries)
    fixed, active = np.flatnonzero(~again), np.flatnonzero(moved)
    if len(fixed) and len(active):
        best, gap = nearest(x[fixed], entries[active])
        best = active[best]
        better = (gap < distance[fixed]) | ((gap == distance[fixed]) & (best < code[fixed]))
        code[fixed[better]], distance[fixed[better]] = best[better], gap[better]
    return code, distance


def _split(codebooks: Codebooks) -> list[np.ndarray]:
    return [np.array(book, dtype=np.int64) for book in codebooks]


def _assigned(codebooks: Codebooks, moved: list[list[bool]] | None):
    """Batches with their parts assigned, from scratch or from the state they carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _split(codebooks)
        each = books[0].shape[1]
        for batch in batches:
            x = matrix(batch.column("v"), each * len(books))
            codes, distances = [], []
            if moved is not None:
                old = matrix(batch.column("codes"), len(books)), matrix(batch.column("distances"), len(books))
            for p, book in enumerate(books):
                part = x[:, p * each : (p + 1) * each]
                if moved is None:
                    code, distance = nearest(part, book)
                else:
                    code, distance = active_nearest(part, book, old[0][:, p], old[1][:, p], np.array(moved[p]))
                codes.append(code)
                distances.append(longs(distance).to_numpy())
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(np.column_stack(c).ravel(), t), len(books)).cast(pa.list_(t)) for c, t in ((codes, pa.int32()), (distances, pa.int64()))]
            yield pa.record_batch([batch.column("id"), batch.column("v"), batch.column("label"), *lists], ["id", "v", "label", "codes", "distances"])

    return run


def _sums(parts: int, entries: int, each: int):
    """Counts and componentwise sums by part and entry, one row each a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(parts * entries, dtype=np.int64)
        total = np.zeros((parts * entries, each), dtype=object)
        for batch in batches:
            x, codes = matrix(batch.column("v"), parts * each), matrix(batch.column("codes"), parts)
            place = (codes + np.arange(parts) * entries).ravel()
            rows = x.reshape(-1, each)
            order = np.argsort(place, kind="stable")
            at, first = np.unique(place[order], return_index=True)
            kind = np.int64 if len(rows) * int(np.abs(rows).max(initial=0)) < 1 << 62 else object
            if len(at):
                total[at] += np.add.reduceat(rows[order].astype(kind), first, axis=0)
                n += np.bincount(place, minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.record_batch({
            "part": pa.array(some // entries, pa.int32()), "entry": pa.array(some % entries, pa.int32()),
            "n": pa.array(n[some], pa.int64()), "total": pa.array(total[some].tolist(), pa.list_(pa.int64())),
        })

    return run


def trained(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = None,
) -> tuple[DataFrame, Codebooks]:
    """``(id, v, label, codes, distances)`` of every usable vector after the last round, and the codebooks."""
    label = F.col(label_col).cast("string") if label_col else F.lit(None).cast("string")
    named = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), label.alias("label"))
    rows = stage(whole_vectors(named, scale, "id", "v", "label"), "whole-vectors")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    each = max(1, -(-longest // parts))
    seeds = [v + [0] * (parts * each - len(v)) for v in first_vectors(rows, F.col("seed_id"), entries)]
    if not seeds:
        return rows.select("*", F.array().cast("array<int>").alias("codes"), F.array().cast("array<bigint>").alias("distances")), [[] for _ in range(parts)]
    books = [[v[p * each : (p + 1) * each] for v in seeds] for p in range(parts)]
    held = stage(rows.mapInArrow(_assigned(books, None), STATE), "codes")
    unstage(rows)
    for _ in range(rounds):
        sums = held.select("v", "codes").mapInArrow(_sums(parts, len(seeds), each), "part int, entry int, n bigint, total array<bigint>")
        before = [list(book) for book in books]
        for (p, e), mean in floor_means(sums, ["part", "entry"]).items():
            books[p][e] = mean
        moved = [[a != b for a, b in zip(*pair, strict=True)] for pair in zip(before, books, strict=True)]
        new = stage(held.mapInArrow(_assigned(books, moved), STATE), "codes")
        unstage(held)
        held = new
    return held, books


def codebooks_sha256(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def with_totals(rows: DataFrame, key: str, value: str, name: str, salts: int = 64) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over the rows of the same ``key``, nulls being one key.

    Sums are formed before the shuffle, and rows meet their total under one of ``salts`` salted keys, so a key with a
    third of all rows is dealt to many tasks. ``rows`` is read from a table, so that a task which runs again salts alike."""
    totals = rows.groupBy(key).agg(F.sum(F.col(value).cast("decimal(20,0)")).cast("bigint").alias(name))
    dealt = totals.select(F.col(key).alias("key_"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("dealt_"), name)
    salted = rows.withColumn("salt_", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    return salted.join(dealt, F.col(key).eqNullSafe(F.col("key_")) & (F.col("salt_") == F.col("dealt_"))).drop("key_", "salt_", "dealt_")


def compressed(vectors: DataFrame, label_col: str | None = None, **how) -> tuple[DataFrame, Codebooks]:
    """``(id, label, code, error, label_error)``: two hexadecimal digits a part, in part order, and the squared error."""
    held, books = trained(vectors, label_col=label_col, **how)
    digits = 2 * max(1, -(-(max(map(len, books), default=1) - 1).bit_length() // 8))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("bigint")), digits, "0"))), "")
    error = F.aggregate("distances", F.lit(0).cast("bigint"), lambda a, d: a + d)
    return with_totals(held.select("id", "label", code.alias("code"), error.alias("error")), "label", "error", "label_error"), books


def restored(codes: DataFrame, books: Codebooks, scale: int = 1024) -> DataFrame:
    """``(id, v, approx)`` of rows from ``trained``: the vector that each code stands for, in the scale of the input."""
    width = sum(len(book[0]) for book in books if book)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _split(books)
        for batch in batches:
            code = matrix(batch.column("codes"), len(tables))
            approx = np.concatenate([t[code[:, p]] for p, t in enumerate(tables)], axis=1) / scale
            values = pa.FixedSizeListArray.from_arrays(pa.array(approx.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.record_batch({"id": batch.column("id"), "v": batch.column("v"), "approx": values})

    return codes.select("id", "v", "codes").mapInArrow(run, "id bigint, v array<bigint>, approx array<double>")
