"""Removal of words in long passages that repeat, by level-wise doubling.

A window of ``size`` words is removed if its word sequence also starts anywhere else. Lengths double up to ``size``
(9, 18, 35): at each shorter one a window stands for itself by one of its parts of that length, the one with the least
hash, so equal windows choose equal parts. Parts are counted over all texts; a window whose part occurs once occurs once
and drops out, and only the others are extended to the next length. At the full length every surviving window is counted
itself, and those that occur once are taken out exactly. So a corpus is counted at one part in about fourteen words, and
whole windows only where there is a repeat.

Between levels the repeated parts are held as a bitmap of ``BITS`` bits, whatever their number. It may let a window of a
single part survive to the next level, never the other way round, and the last level is exact. Counts are sums with
map-side combining, at most one row per piece of text and hash; texts are never shuffled, but for those with a window
that the last level takes out.

Defined cases: a null text has no words; texts of fewer than ``size`` words keep all. Repeated rows repeat all their
windows. Windows are compared by 64-bit hashes. Further columns are carried in the struct ``row`` and can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.llm import kernel
from ladderline.llm.bitmaps import flagged_in
from ladderline.session import stage

SIZE = 35
BITS = 1 << 27
"""Bits of a level's bitmap: 16 MB on the driver and in a worker."""
PIECE = 1 << 19
"""Bytes of text worked on at once in a worker, unless one text is longer: temporary arrays of 39 MB, bitmaps aside."""
_PLACE = np.uint64((1 << 28) - 1)


def lengths_to(size: int) -> list[int]:
    """The lengths before ``size``, each at least half the next; the first has four words or more."""
    out = [-(-size // 2)]
    while out[0] > 15:
        out.insert(0, -(-out[0] // 2))
    return out


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


class _Piece:
    """The windows of a piece of texts, and which of them survive the levels so far."""

    def __init__(self, texts: pa.Array, size: int):
        self.words = kernel.words_of(texts)
        self.hashes = self.words.hashes()
        self.size = size
        self.starts, self.offsets = kernel.window_starts(self.words.offsets, size)
        self.alive = np.ones(len(self.starts), dtype=bool)

    def parts(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all parts of ``length`` words, and for each surviving window the place of its least part."""
        hashes = kernel.window_hashes(self.hashes, np.arange(len(self.hashes) - length + 1), length)
        placed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_min(placed, self.size - length + 1)
        return hashes, (least[self.starts[self.alive]] & _PLACE).astype(np.int64)

    def survive(self, levels: list[tuple[int, np.ndarray]]) -> None:
        for length, bitmap in levels:
            if not self.alive.any():
                return
            hashes, places = self.parts(length)
            bit = hashes[places] >> np.uint64(37)
            on = (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
            self.alive[np.flatnonzero(self.alive)[on == 0]] = False

    def whole(self) -> np.ndarray:
        return kernel.window_hashes(self.hashes, self.starts[self.alive], self.size)


def _levels(held: list[tuple[int, Broadcast]]) -> list[tuple[int, np.ndarray]]:
    return [(length, b.value) for length, b in held]


def _count_parts(size: int, length: int, held: list):
    @kernel.freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _levels(held)
        for batch in kernel.pieces(batches, "text", PIECE):
            piece = _Piece(batch.column("text"), size)
            piece.survive(levels)
            if piece.alive.any():
                hashes, places = piece.parts(length)
                found, n = np.unique(hashes[np.unique(places)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int32))], names=["h", "n"])

    return run


def _count_whole(size: int, held: list):
    @kernel.freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _levels(held)
        for batch in kernel.pieces(batches, "text", PIECE):
            piece = _Piece(batch.column("text"), size)
            piece.survive(levels)
            if piece.alive.any():
                doc = np.searchsorted(piece.offsets, np.flatnonzero(piece.alive), side="right") - 1
                found, first, n = np.unique(piece.whole(), return_index=True, return_counts=True)
                rid = batch.column("rid").take(pa.array(doc[first]))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int32)), rid], names=["h", "n", "rid"])

    return run


def _cut(size: int, held: list, unchanged: bool):
    @kernel.freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = _levels(held)
        for batch in kernel.pieces(batches, "text", PIECE):
            piece = _Piece(batch.column("text"), size)
            piece.survive(levels)
            alone = batch.column("alone").flatten().to_numpy().view(np.uint64)
            if len(alone):
                at = np.flatnonzero(piece.alive)
                piece.alive[at[np.isin(piece.whole(), alone)]] = False
            words = piece.words
            edge = np.zeros(len(words.starts) + 1, dtype=np.int64)
            np.add.at(edge, piece.starts[piece.alive], 1)
            np.add.at(edge, piece.starts[piece.alive] + size, -1)
            keep = np.cumsum(edge[:-1]) == 0
            s, e = words.starts[keep], words.ends[keep]
            ends = np.cumsum(e - s + 1)
            total = int(ends[-1]) if len(ends) else 0
            out = np.full(total, 32, dtype=np.uint8)
            if total:
                source = np.arange(total) + np.repeat(s - (ends - (e - s + 1)), e - s + 1)
                inside = np.ones(total, dtype=bool)
                inside[ends - 1] = False
                out[inside] = words.data[source[inside]]
            kept = np.concatenate(([0], np.cumsum(keep)))[words.offsets]
            cut = np.concatenate(([0], ends))[kept].tolist()
            text = out.tobytes()
            texts = pa.array([text[a : max(a, b - 1)] for a, b in zip(cut, cut[1:], strict=False)], pa.binary()).cast(pa.string())
            removed = pa.array(words.counts - np.diff(kept))
            if unchanged:
                texts = pc.if_else(pc.equal(removed, 0), batch.column("text"), texts)
            columns = [batch.column("row"), pa.array(words.counts), removed, texts]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "n_removed", "kept_text"])

    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """One bit for each of ``BITS`` leading values of a hash: at most ``BITS`` / 32768 rows of 4 KB reach the driver."""
    bit = F.shiftrightunsigned("h", 37)
    parts = hashes.groupBy((bit / 32768).cast("int").alias("part")).agg(F.bitmap_construct_agg(bit % 32768).alias("bits"))
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for part, bits in parts.toLocalIterator():
        out[part * 4096 : (part + 1) * 4096] = np.frombuffer(bits, dtype=np.uint8)
    return out


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, unchanged: bool = False) -> DataFrame:
    """Every row of ``docs``, without its text, as ``row`` with ``n_words``, ``n_removed`` and ``kept_text``.

    That is the kept words joined by spaces, or with ``unchanged`` the text itself, null included, where all words are kept."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(kernel.others(docs, text_col).alias("row"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), text).alias("rid"))
    held: list[tuple[int, Broadcast]] = []
    for length in lengths_to(size):
        parts = rows.select("text").mapInArrow(_count_parts(size, length, list(held)), "h bigint, n int")
        repeated = parts.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
        held.append((length, spark.sparkContext.broadcast(_bitmap(repeated))))
    whole = rows.select("text", "rid").mapInArrow(_count_whole(size, held), "h bigint, n int, rid bigint")
    # a window that occurs once occurs in one text, so the least id is that text's
    single = whole.groupBy("h").agg(F.sum("n").alias("n"), F.min("rid").alias("of")).where("n = 1")
    alone = stage(single.groupBy("of").agg(F.collect_list("h").alias("alone")), "alone")
    marked = flagged_in(rows, alone.select("of"), "rid", "of")
    none = F.array().cast("array<bigint>")
    free = marked.where("not flagged").select("row", "text", none.alias("alone"))
    bound = marked.where("flagged").join(alone, F.col("rid") == F.col("of"), "left").select("row", "text", F.coalesce("alone", none).alias("alone"))
    kind = rows.schema["row"].dataType.simpleString()
    return free.unionByName(bound).mapInArrow(_cut(size, held, unchanged), f"row {kind}, n_words bigint, n_removed bigint, kept_text string")
