"""Quality classifier: naive Bayes features with a linear support vector machine.

A text's features are the n-grams that it has: runs of three bytes of its lower-cased words, words, and pairs of
neighbouring words, hashed to ``FEATURES`` numbers. Each feature is scaled by the log ratio of its counts in the two
classes, which are taken over all labelled training texts by one aggregation, and a text's features are divided by the
root of their number. On a sample of at most ``FIT`` training texts, those with the least hash of their id, a linear
model is fitted to the hinge loss by dual coordinate descent, with classes weighted to balance, and then moved towards
the mean weight as the method asks. Its margins become scores through a logistic curve fitted on a fifth of the sample
that the descent doesn't see.

Defined cases: a null or blank text has no features and is scored by the bias alone. A label that repeats counts once,
the largest; null labels and ids don't count. If training has one class only the score is its label, without training
0.5. Further columns are not read. Rows are scored alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.llm import kernel
from ladderline.llm.bitmaps import maybe_in
from ladderline.llm.ppm import Coded, held_out, written
from ladderline.session import stage

FEATURES, FIT = 1 << 18, 8192
SMOOTHING, COST, EPOCHS, TOWARDS_MEAN = 1.0, 1.0, 15, 0.75
_BITS = np.uint64(FEATURES.bit_length() - 1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of all texts, text after text, and the offsets of each text's."""
    stream = Coded(written(texts, 2), 2)
    hashes, counts = stream.words.view(np.uint64), np.diff(stream.word_offsets)
    pairs, pair_offsets = kernel.window_starts(stream.word_offsets, 2)
    n = len(counts)
    # an empty text's end mark is no n-gram of it
    size = np.where(counts > 0, np.diff(stream.offsets), 0)
    keys = [kernel.mix(stream.grams.view(np.uint64)[np.repeat(counts > 0, np.diff(stream.offsets))]), kernel.mix(hashes), kernel.window_hashes(hashes, pairs, 2)]
    text = np.concatenate([np.repeat(np.arange(n), c) for c in (size, counts, np.diff(pair_offsets))]).astype(np.uint64)
    found = np.unique((text << _BITS) | (np.concatenate(keys) >> (np.uint64(64) - _BITS)))
    return (found & np.uint64(FEATURES - 1)).astype(np.int64), np.searchsorted(found, np.arange(n + 1).astype(np.uint64) << _BITS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * FEATURES, dtype=np.int64)
    for piece in kernel.pieces(batches, "text"):
        found, offsets = features(piece.column("text"))
        label = np.repeat(piece.column("label").to_numpy(), np.diff(offsets))
        total += np.bincount(found + FEATURES * label, minlength=2 * FEATURES)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["feature", "n"])


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Of the second half, label 1, over the first."""
    smooth = counts.reshape(2, FEATURES) + SMOOTHING
    shares = smooth / smooth.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the last of them the bias, that minimise |w|^2 / 2 + sum of cost * hinge loss, by descent on the dual."""
    w, alpha = np.zeros(FEATURES + 1), np.zeros(len(rows))
    square = np.array([v @ v + 1 for v in values])
    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(len(rows)):
            slope = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            after = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            step = (after - alpha[i]) * y[i]
            if step:
                alpha[i] = after
                w[rows[i]] += step * values[i]
                w[-1] += step
                most = max(most, abs(step))
        if most < 1e-3 * cost.max():
            break
    return w


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """``(a, b)`` of 1 / (1 + exp(-(a * margin + b))) by Newton steps, with targets drawn in as for few rows."""
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x, t = np.stack((margins, np.ones(len(margins)))), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(t @ x, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (target - p))
        t = t + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(t[0]), float(t[1])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature numbers in place of texts, at most ``FEATURES`` of them for a text of any length."""
    for piece in kernel.pieces(batches, "text"):
        found, offsets = features(piece.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int32()))
        yield pa.RecordBatch.from_arrays([lists, piece.column("label"), piece.column("order")], names=["features", "label", "order"])


def _fit(ratios: Broadcast):
    def run(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by([("order", "ascending"), ("label", "ascending")])
        labels = sample.column("label").to_numpy()
        rows = [r.values.to_numpy().astype(np.int64) for r in sample.column("features")]
        values = [ratios.value[r] / np.sqrt(max(len(r), 1)) for r in rows]
        tests = np.arange(len(rows)) % 5 == 4
        if len(set(labels[~tests])) < 2 or len(set(labels[tests])) < 2:
            tests[:] = False
        train = np.flatnonzero(~tests)
        y = np.where(labels == 1, 1.0, -1.0)
        share = np.array([(labels[train] == c).mean() for c in (0, 1)])
        w = descend([rows[i] for i in train], [values[i] for i in train], y[train], COST / (2 * share[labels[train]]))
        w[:-1] = TOWARDS_MEAN * w[:-1] + (1 - TOWARDS_MEAN) * np.abs(w[:-1]).mean()
        check = np.flatnonzero(tests) if tests.any() else train
        margins = np.array([w[rows[i]] @ values[i] + w[-1] for i in check])
        a, b = logistic(margins, labels[check])
        flat = np.concatenate((w[:-1] * ratios.value, [w[-1], a, b]))
        return pa.table({"at": pa.array(np.arange(len(flat))), "w": pa.array(flat)})

    return run


def _score(weights: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *_, bias, a, b = weights.value[-3:]
        w = weights.value[:-3]
        for piece in kernel.pieces(batches, "text"):
            found, offsets = features(piece.column("text"))
            sums = np.add.reduceat(np.append(w[found], 0.0), offsets[:-1])
            n = np.diff(offsets)
            margin = np.where(n > 0, sums / np.sqrt(np.maximum(n, 1)), 0.0) + bias
            score = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
            yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(score)], names=["id", "score"])

    return run


def classified(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    parts: int = 5, rest: int = 0, threshold: float = 0.3, fit: int = FIT,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row of ``docs``; labels of ids with remainder ``rest`` are not learnt."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = stage(known.where(~held_out("id", parts, rest)).groupBy("id").agg(F.max("label").alias("label")), "labels")
    counts = maybe_in(rows, known.select("id"), "id").join(known, "id").select("text", "label").mapInArrow(_count, "feature bigint, n bigint")
    found = counts.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()  # 2 * FEATURES rows at most
    totals = np.zeros(2 * FEATURES)
    totals[found.column("feature").to_numpy()] = found.column("n").to_numpy()
    classes = dict(map(tuple, known.groupBy("label").agg(F.count("*")).collect()))
    kind = rows.schema["id"].dataType.simpleString()
    if len(classes) < 2:
        out = rows.select("id", F.lit(float(next(iter(classes), 0.5))).alias("score"))
    else:
        # ids whose hash is within the share of all hashes that ``fit`` labels take, a little less to stay within it
        share = min(1.0, 0.9 * fit / sum(classes.values()))
        order = F.shiftrightunsigned(F.xxhash64("id"), 2)
        chosen = known.withColumn("order", order).where(F.col("order") <= F.lit(int(share * (1 << 62))))
        sample = maybe_in(rows, chosen.select("id"), "id").join(chosen, "id").select("text", "label", "order")
        featured = sample.mapInArrow(_featured, "features array<int>, label int, order bigint")
        model = featured.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(_fit(spark.sparkContext.broadcast(log_ratios(totals))), "at bigint, w double").toArrow()
        weights = np.zeros(FEATURES + 3)
        weights[model.column("at").to_numpy()] = model.column("w").to_numpy()
        out = rows.mapInArrow(_score(spark.sparkContext.broadcast(weights)), f"id {kind}, score double")
    return out.select("id", held_out("id", parts, rest).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
