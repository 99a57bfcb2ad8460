"""Words, word hashes and word-window hashes of Arrow text batches, in numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D; as those are ASCII, this is the same in UTF-8 bytes and in
code points. Hashes are 64-bit: two different words or windows share one with probability 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 20
"""Bytes or words hashed at once; bounds the temporary arrays, whatever the length of a text."""

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_WORD_BYTE = np.ones(256, dtype=bool)
_WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    have = len(_powers["up"]) if _powers else 0
    if have < n:
        n = max(n, SLICE // 8, 2 * have)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for spans in ascending order, from running sums of a polynomial."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        top = int(ends[last - 1])
        up, down = _power_tables(top - base + 1)
        sums = np.zeros(top - base + 1, dtype=np.uint64)
        np.cumsum(values[base:top] * up[: top - base], out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        first = last
    return mix(out)


@dataclass
class Words:
    """The words of a batch of texts: ``data[starts[i]:ends[i]]``; text d has words ``offsets[d]:offsets[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        first = 0
        while first < len(self.starts):
            base = int(self.starts[first])
            last = max(first + 1, int(np.searchsorted(self.ends, base + SLICE, side="right")))
            top = int(self.ends[last - 1])
            out[first:last] = span_hashes(_BYTE[self.data[base:top]], self.starts[first:last] - base, self.ends[first:last] - base)
            first = last
        return out


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins (one more offset at the end); null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = bytes_of(texts)
    if lower:
        data = _LOWER[data]
    inside = _WORD_BYTE[data]
    n = len(data)
    if not n:
        none = np.empty(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(offsets), dtype=np.int64))
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[offsets < n]] = False
    starts = np.flatnonzero(inside & ~before)
    behind = np.zeros(n, dtype=bool)
    behind[:-1] = inside[1:]
    edge = offsets[(offsets > 0)] - 1
    behind[edge] = False
    ends = np.flatnonzero(inside & ~behind) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def window_starts(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``size`` words begin that lie within one text, and the offsets of each text's windows."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    ends = np.concatenate(([0], np.cumsum(counts)))
    return np.arange(ends[-1]) + np.repeat(offsets[:-1] - ends[:-1], counts), ends


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return span_hashes(hashes, starts, starts + size)


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 * SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut between rows into pieces of about ``most`` bytes of text; a longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(first, last - first)
            first = last


def slices(text: pa.Array, most: int) -> Iterator[pa.Array]:
    """One text in consecutive pieces of ``most`` bytes and the rest of the word there, without a copy."""
    data, _ = bytes_of(text)
    first = 0
    while first < len(data):
        last = first + most
        while last < len(data):
            ahead = np.flatnonzero(~_WORD_BYTE[data[last : last + 4096]])
            if len(ahead):
                last += int(ahead[0]) + 1
                break
            last += 4096
        last = min(last, len(data))
        part = np.array([0, last - first], dtype=np.int64)
        yield pa.LargeStringArray.from_buffers(1, pa.py_buffer(part), pa.py_buffer(data[first:last]))
        first = last


def others(docs: DataFrame, text_col: str) -> Column:
    """A struct of all columns but the text, which so goes to a task and back once."""
    return F.struct(*([c for c in map(_quoted, docs.columns) if c != _quoted(text_col)] or [F.lit(None).cast("int").alias("none")]))


def with_text(docs: DataFrame, text_col: str, row: str, text: str) -> Column:
    """All columns of ``docs`` as a struct, from the struct of the others and the text."""
    return F.struct(*[F.col(text).alias(c) if c == text_col else F.col(row)[c].alias(c) for c in docs.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` giving its memory back at the end of a task; workers live on and would hold it through later stages."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _powers.clear()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task
