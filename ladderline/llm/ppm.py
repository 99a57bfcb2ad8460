"""Language-model scores by prediction by partial matching, with a unigram base.

The model is a trie of byte contexts up to ``ORDER`` bytes, pretrained on all training texts. It codes the token
sequence of a text: its lower-cased words joined by one space, then an end mark (0xFF, which no UTF-8 text has; it also
stands before the first byte). A byte is coded at the longest known context; a context with N occurrences and D different
bytes escapes with probability D / (N + D), and in the next shorter context the bytes already seen in the longer one are
excluded from its counts. After the empty context the remaining bytes are equally likely.

The trie lives in Spark tables: ``symbols`` has the count of every gram (a context and the byte behind it) of every
order, ``contexts`` has N, D and what a context excludes from the next shorter one. Texts are written down once as byte
streams, in a bucketed table of blocks, which end at ``BLOCK`` bytes or at about ``DIFFERENT`` different grams. The different
grams of all blocks are counted; every different gram gets its code length, a known one from its context, the others by
joining them with their shorter grams and contexts, all orders in one join; the code lengths are joined with the grams of
each block and go back to the block, where they are added up. So the work is one pass whatever the size of the trie, no
task holds more than a block and its grams, and texts are not shuffled. The base goes the same way, with words in place of
grams: their keys are negative. Nothing but counts by order reaches the driver; orders whose tables have at most ``HEAD``
rows by count, which holds for those of up to two bytes, are sent to all tasks, the others are joined by key.

A text of any length is written down in segments of about ``SEGMENT`` bytes, cut between words, each with the bytes before
it as context; a single longer word is not cut.

Defined cases: a null or blank text is the end mark alone. Ids may repeat or be null; a null id hashes as the empty text.
Further columns are not read. Without training texts every byte is equally likely, and the base is uniform.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.llm import kernel
from ladderline.session import shared_dir, stage, unstage

ORDER = 5
"""Up to 6: a gram is a number that is not negative."""
BLOCK, DIFFERENT, SEGMENT, HEAD = 1 << 24, 1 << 21, 1 << 20, 1 << 17
FLUSH = 1 << 20
END = 0xFF
_SAMPLED = np.uint64(15)
"""Grams are sampled by these bits of a hash to estimate how many different ones a block has."""
_END_TOKEN = -1


def held_out(id_col: str, parts: int, rest: int):
    """Whether crc32 of the id as text has this remainder."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == rest


def written(texts: pa.Array, order: int) -> pa.BinaryArray:
    """The streams of some texts, each with ``order`` end marks before it."""
    words = kernel.words_of(texts, lower=True)
    n, counts = len(words.offsets) - 1, words.counts
    lengths = words.ends - words.starts
    before = np.concatenate(([0], np.cumsum(lengths + 1)))
    size = np.maximum(before[words.offsets[1:]] - before[words.offsets[:-1]], 1)
    begin = np.concatenate(([0], np.cumsum(size + order)))
    data = np.full(int(begin[-1]), END, dtype=np.uint8)
    doc = np.repeat(np.arange(n), counts)
    to = begin[doc] + order + before[:-1] - before[words.offsets[doc]]
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    data[np.repeat(to, lengths) + at] = words.data[np.repeat(words.starts, lengths) + at]
    gap = np.ones(len(to), dtype=bool)
    gap[words.offsets[1:][counts > 0] - 1] = False
    data[(to + lengths)[gap]] = 0x20
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(data)])


def _segments(text: pa.Array, order: int) -> Iterator[bytes]:
    """The stream of one long text, cut between words; each segment follows its context of ``order`` bytes."""
    context, some = bytes([END]) * order, False
    for part in kernel.slices(text, SEGMENT):
        words = written(part, order)[0].as_py()[order:-1]
        if words:
            coded = (b" " if some else b"") + words
            yield context + coded
            context, some = (context + coded)[-order:], True
    yield context + bytes([END])


def _streams(order: int, block: int):
    @kernel.freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        at, filled, sample = row, 0, np.empty(0, np.uint64)
        for piece in kernel.pieces(batches, "text", min(2 * SEGMENT, block)):
            long = piece.num_rows == 1 and len(piece.column("text")[0].as_buffer()) > 2 * SEGMENT
            if long:
                streams = ((np.zeros(1, np.int64), pa.array([s], pa.binary())) for s in _segments(piece.column("text"), order))
            else:
                streams = [(np.arange(piece.num_rows), written(piece.column("text"), order))]
            for of, stream in streams:
                filled += stream.nbytes
                hashes = kernel.mix(Coded(stream, order, False).grams.view(np.uint64))
                sample = np.union1d(sample, hashes[hashes & _SAMPLED == 0])
                take = pa.array(of)
                yield pa.record_batch({
                    "block": pa.array(np.full(len(of), at)), "rid": pa.array(row + of), "id": piece.column("id").take(take),
                    "train": piece.column("train").take(take), "data": stream,
                })
                if filled >= block or len(sample) * (int(_SAMPLED) + 1) >= DIFFERENT:
                    at, filled, sample = at + 1, 0, np.empty(0, np.uint64)
            row += piece.num_rows

    return run


class Coded:
    """Grams of ``order + 1`` bytes at every coded byte of some streams, and their tokens."""

    def __init__(self, streams: pa.Array, order: int, with_words: bool = True):
        streams = streams.cast(pa.large_binary())
        begin = np.frombuffer(streams.buffers()[1], dtype=np.int64)[streams.offset : streams.offset + len(streams) + 1]
        data = np.frombuffer(streams.buffers()[2], dtype=np.uint8)[begin[0] : begin[-1]]
        begin = begin - begin[0]
        coded = np.ones(len(data), dtype=bool)
        coded[(begin[:-1, None] + np.arange(order)).ravel()] = False
        grams = np.zeros(len(data) - order, dtype=np.uint64)
        for k in range(order + 1):
            grams = (grams << np.uint64(8)) | data[k : len(data) - order + k]
        self.grams = grams[coded[order:]].view(np.int64)
        self.offsets = begin - order * np.arange(len(begin))
        if not with_words:
            return
        inside = coded & (data != 0x20) & (data != END)
        edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.word_offsets = np.searchsorted(starts, begin)
        self.words = kernel.Words(data, starts, ends, self.word_offsets).hashes().view(np.int64) | np.int64(-1 << 63)
        self.ended = data[begin[1:] - 1] == END


class _Counter:
    """Counts by key of one block, merged when as many have come together as there are, and ``FLUSH``."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.fresh = 0

    def add(self, keys: np.ndarray, counted: bool) -> None:
        found, n = np.unique(keys, return_counts=True)
        self.parts.append((found, n if counted else np.zeros(len(found), np.int64)))
        self.fresh += len(found)
        if self.fresh > max(FLUSH, len(self.parts[0][0])):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([k for k, _ in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in self.parts])[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.parts, self.fresh = [(keys[first], np.add.reduceat(counts, first))], 0

    def taken(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if sum(len(k) for k, _ in self.parts):
            self.merge()
            yield self.parts[0]
        self.parts, self.fresh = [], 0


def _different(order: int):
    """``(block, key, n)``: the different grams and words of each block, with their counts in training texts."""

    @kernel.freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, block = _Counter(), None
        rows = lambda: (pa.record_batch({"block": pa.array(np.full(len(k), block)), "key": pa.array(k), "n": pa.array(n)}) for k, n in counter.taken())
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, [len(blocks)])).tolist()
            for first, last in zip(cuts, cuts[1:], strict=False):
                if first == last:
                    continue
                if block is not None and blocks[first] != block:
                    yield from rows()
                block = blocks[first]
                for piece in kernel.pieces([batch.slice(first, last - first)], "data", 2 * SEGMENT):
                    coded = Coded(piece.column("data"), order)
                    train = piece.column("train").to_numpy(zero_copy_only=False)
                    for part in (True, False):
                        mine = train == part
                        ends = np.full(int((mine & coded.ended).sum()), _END_TOKEN)
                        grams = coded.grams[np.repeat(mine, np.diff(coded.offsets))]
                        counter.add(np.concatenate((grams, coded.words[np.repeat(mine, np.diff(coded.word_offsets))], ends)), part)
        yield from rows()

    return run


def _added_up(order: int, unit: float):
    """Code lengths of the streams of a block, from what its grams and words cost."""
    none = float(np.log10(0.5 / unit))  # above what an unknown word has, below a known one's

    def run(streams: pa.Table, costs: pa.Table) -> pa.Table:
        keys, values = costs.column("key").to_numpy(), costs.column("value").to_numpy()
        by = np.argsort(keys)
        keys, values = keys[by], values[by]
        parts = [_scores(piece, order, keys, values, none) for piece in kernel.pieces(streams.to_batches(), "data", SEGMENT)]
        return pa.Table.from_batches(parts)

    return run


def _scores(piece: pa.RecordBatch, order: int, keys: np.ndarray, values: np.ndarray, none: float) -> pa.RecordBatch:
    coded = Coded(piece.column("data"), order)
    cost = lambda wanted: values[np.searchsorted(keys, wanted)]
    words = cost(coded.words)
    end = float(cost(np.array([_END_TOKEN]))[0]) if coded.ended.any() else 0.0
    by_row = lambda v: np.array([v[a:b].sum() for a, b in zip(coded.word_offsets[:-1], coded.word_offsets[1:], strict=True)])
    ended = coded.ended.astype(np.int64)
    return pa.record_batch({
        "rid": piece.column("rid"), "id": piece.column("id"), "n_tokens": pa.array(np.diff(coded.word_offsets) + ended),
        "known": pa.array(by_row(words > none).astype(np.int64) + ended * int(end > none)), "base": pa.array(by_row(words) + ended * end),
        "score": pa.array(np.add.reduceat(cost(coded.grams), coded.offsets[:-1])),
    })


def _bucketed(rows: DataFrame, by: str) -> tuple[DataFrame, Callable[[], None]]:
    """``rows`` as a table whose buckets are joined by ``by`` without a shuffle, and what removes it."""
    spark = rows.sparkSession
    name = f"streams_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, by).saveAsTable(name)
    table = spark.table(name)
    table._staged_at = path

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        unstage(table)

    return table, drop


def _shorter(gram: str, order: int) -> tuple:
    """The gram of order ``k`` in a longer one, by its last bytes."""
    masks = F.array(*[F.lit((1 << (8 * (k + 1))) - 1) for k in range(order + 1)])
    return F.posexplode(F.transform(masks, lambda m: F.col(gram).bitwiseAND(m))).alias("k", "gram")


def trie(leaves: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """``symbols(k, gram, n)`` and ``contexts(k, context, total, distinct, below)`` from the grams of the longest contexts."""
    symbols = stage(leaves.select("n", _shorter("key", order)).groupBy("k", "gram").agg(F.sum("n").alias("n")), "symbols")
    low = F.expr("gram & (shiftleft(1L, 8 * k) - 1)")  # what follows the shorter context
    behind = symbols.select((F.col("k") + 1).alias("k"), F.col("gram").alias("low"), F.col("n").alias("shorter"))
    joined = symbols.where("k > 0").withColumn("low", low).join(behind, ["k", "low"])
    every = joined.select("k", "gram", "n", "shorter").unionByName(symbols.where("k = 0").select("k", "gram", "n", F.lit(0).cast("bigint").alias("shorter")))
    contexts = every.groupBy("k", F.shiftright("gram", 8).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum("shorter").alias("below"))
    return symbols, stage(contexts, "contexts")


def _with_orders(rows: DataFrame, table: DataFrame, keys: list[str], small: int) -> DataFrame:
    """``rows`` joined with ``table``, whose orders up to ``small`` go to all tasks."""
    few = rows.where(F.col("k") <= small).join(F.broadcast(table.where(F.col("k") <= small)), keys, "left")
    return few.unionByName(rows.where(F.col("k") > small).join(table.where(F.col("k") > small), keys, "left"))


def escaped(grams: DataFrame, symbols: DataFrame, contexts: DataFrame, order: int, head: int) -> DataFrame:
    """``(key, value)``: the code lengths of grams that no training text has."""
    sizes = dict(map(tuple, symbols.groupBy("k").agg(F.count("*")).collect()))  # one row per order
    small, held = -1, 0
    while small < order and (held := held + sizes.get(small + 1, 0)) <= head:
        small += 1
    wanted = grams.select("key", _shorter("key", order)).withColumn("context", F.shiftright("gram", 8))
    met = _with_orders(_with_orders(wanted, symbols, ["k", "gram"], small), contexts, ["k", "context"], small)
    levels = met.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("k", "n", "total", "distinct", "below")), asc=False).alias("levels"))
    fresh = "coalesce(x.distinct - a.d, 0)"
    whole = f"coalesce(x.total - a.n + {fresh}, 1)"
    value = F.expr(f"""
        aggregate(levels, named_struct('s', 0D, 'n', 0L, 'd', 0L, 'done', false), (a, x) -> if(a.done, a, named_struct(
            's', a.s + CASE WHEN x.n IS NOT NULL THEN log10(x.n / {whole}) WHEN {fresh} > 0 THEN log10({fresh} / {whole}) ELSE 0D END,
            'n', coalesce(x.below, a.n), 'd', coalesce(x.distinct, a.d), 'done', x.n IS NOT NULL)),
            a -> a.s - if(a.done, 0D, log10(256 - a.d)))""")
    return levels.select("key", value.alias("value"))


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int = 10, rest: int = 0, order: int = ORDER, shard: int = BLOCK, head: int = HEAD) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row; texts whose id has remainder
    ``rest`` are kept out of the training. ``shard``: bytes in a block of texts, at most and but for the last text."""
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    written = named.withColumn("train", ~held_out("id", parts, rest)).mapInArrow(_streams(order, shard), f"block bigint, rid bigint, id {kind}, train boolean, data binary")
    streams, drop = _bucketed(written, "block")
    different = streams.select("block", "train", "data").mapInArrow(_different(order), "block bigint, key bigint, n bigint")
    counts = stage(different.groupBy("key").agg(F.sum("n").alias("n")), "counts")

    words, grams = counts.where("key < 0"), counts.where("key >= 0")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    unit = total + 0.1 * (distinct + 1)
    known, unknown = grams.where("n > 0"), grams.where("n = 0")
    symbols, contexts = trie(known, order)
    longest = contexts.where(F.col("k") == order).select("context", "total", "distinct")
    top = known.withColumn("context", F.shiftright("key", 8)).join(longest, "context").select("key", F.log10(F.col("n") / (F.col("total") + F.col("distinct"))).alias("value"))
    word_costs = words.select("key", F.log10((F.col("n") + 0.1) / F.lit(unit)).alias("value"))
    costs = stage(top.unionByName(escaped(unknown, symbols, contexts, order, head)).unionByName(word_costs), "costs")
    for table in (counts, symbols, contexts):
        unstage(table)

    held = different.select("block", "key").join(costs, "key").select("block", "key", "value")
    asking = streams.select("block", "rid", "id", "data")
    lengths = asking.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(_added_up(order, unit), f"rid bigint, id {kind}, n_tokens bigint, known bigint, base double, score double")
    lengths = stage(lengths, "lengths")
    unstage(costs)
    drop()
    sums = lengths.groupBy("rid", "id").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "known", "base", "score")])
    return sums.select(
        F.col("id").alias(id_col), held_out("id", parts, rest).alias("held_out"), "n_tokens", F.col("known").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )
