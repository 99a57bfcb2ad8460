"""Byte-level BPE of whole texts, with a segment tree over the ranks of adjacent pairs.

A text is cut at the tokenizer's added tokens and then by the byte-level pattern. The distinct cuts of a piece of a batch
are encoded together: for each, a segment tree has the rank of every adjacent pair of symbols, so its root is the
leftmost pair of the lowest rank. That pair is merged, three leaves change and with them their paths to the root, until
no root has a mergeable pair. The trees of cuts of like length are rows of one array, so a step is a few array
operations for all of them. Cuts of any length take O(n log n).

Decoding looks the ids up as bytes and reads those as UTF-8, with the replacement character for what isn't.

The vocabulary is read from a file whose path is a parameter and that every executor can open; nothing is trained.

Defined cases: a null text counts as empty and gives no ids. Added tokens in a text become their ids. Rows are encoded
alone, so repeated rows get equal results. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.llm import kernel

NONE = np.int64(1) << np.int64(62)
"""A leaf without a mergeable pair."""
LEAVES = 1 << 20
"""Leaves of the trees that are worked on at once."""
KNOWN = 300_000
"""Encoded cuts that a worker remembers."""
LONG = 1 << 18

# White space as Unicode defines it, and the pattern of byte-level pre-tokenization.
WHITE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
_SPACE = "".join(f"{chr(a)}-{chr(b)}" for a, b in WHITE)
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (c for c in range(256) if c not in set(printable))
    moved = {b: 0x100 + i for i, b in enumerate(others)}
    return [chr(moved.get(b, b)) for b in range(256)]


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["normalizer"] or spec["pre_tokenizer"].get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("only byte-level tokenizers without a normalizer or a prefix space are supported")
        vocab = spec["model"]["vocab"]
        chars = byte_characters()
        to_byte = {c: b for b, c in enumerate(chars)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t[flag] for t in spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        size = max([*vocab.values(), *added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(to_byte[c] for c in token)
        for token, i in added.items():
            self.bytes[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.ids = list(range(size))
        self.added = added
        self.cut_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.find = regex.compile(PATTERN)
        self.first = np.array([vocab[c] for c in chars], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
        self.size = size
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        # open addressing: a pair's slot is found by its hash and then the next free ones
        self.mask = (1 << (4 * len(keys) - 1).bit_length()) - 1
        self.slots, self.ranks = np.full(self.mask + 1, -1, dtype=np.int64), np.zeros(self.mask + 1, dtype=np.int64)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist(), strict=True)):
            while self.slots[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.slots[slot], self.ranks[slot] = key, rank
        self.known: dict[str, tuple[int, ...]] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (kernel.mix(keys.astype(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where it isn't mergeable or a side is missing (-1)."""
        keys = left * self.size + right
        out = np.full(keys.shape, NONE)
        open_at = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[open_at])
        while len(open_at):
            there = self.slots[slot]
            hit = there == keys[open_at]
            out[open_at[hit]] = self.ranks[slot[hit]]
            more = ~hit & (there >= 0)
            open_at, slot = open_at[more], (slot[more] + 1) & self.mask
        return out

    def merge(self, cuts: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of byte strings of at least one byte."""
        out: list[tuple[int, ...]] = [()] * len(cuts)
        lengths = np.array([len(c) for c in cuts], dtype=np.int64)
        by_size = np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
        for bits in np.unique(by_size).tolist():
            chosen = np.flatnonzero(by_size == bits)
            step = max(1, LEAVES >> bits)
            for first in range(0, len(chosen), step):
                part = chosen[first : first + step]
                for i, ids in zip(part.tolist(), self._merge_alike([cuts[i] for i in part], lengths[part], 1 << bits), strict=True):
                    out[i] = ids
        return out

    def _merge_alike(self, cuts: list[bytes], lengths: np.ndarray, leaves: int) -> Iterator[tuple[int, ...]]:
        n = len(cuts)
        inside = np.arange(leaves) < lengths[:, None]
        symbols = np.full((n, leaves), -1, dtype=np.int64)
        symbols[inside] = self.first[np.frombuffer(b"".join(cuts), dtype=np.uint8)]
        place = np.arange(leaves, dtype=np.int64)
        behind, before = np.tile(place + 1, (n, 1)), np.tile(place - 1, (n, 1))
        behind[behind >= lengths[:, None]] = -1
        ranks = np.full((n, leaves), NONE)
        if leaves > 1:
            ranks[:, :-1] = self._rank(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, -1)
        tree = np.full((n, 2 * leaves), NONE)
        tree[:, leaves:] = np.where(ranks < NONE, (ranks << 32) | place, NONE)
        for level in range(leaves.bit_length() - 2, -1, -1):
            at = np.arange(1 << level, 2 << level)
            tree[:, at] = np.minimum(tree[:, 2 * at], tree[:, 2 * at + 1])
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root & 0xFFFFFFFF
            gone = behind[rows, at]
            after = behind[rows, gone]
            symbols[rows, at] = self.merged[root >> 32]
            symbols[rows, gone] = -1
            behind[rows, at] = after
            has_after = after >= 0
            before[rows[has_after], after[has_after]] = at[has_after]
            ahead = before[rows, at]
            symbol = symbols[rows, at]
            right = np.where(has_after, symbols[rows, after], -1)
            left = np.where(ahead >= 0, symbols[rows, ahead], -1)
            has_ahead = ahead >= 0
            at_left = ahead[has_ahead]
            where = np.concatenate((gone, at, at_left))
            ranks = np.concatenate((np.full(len(rows), NONE), self._rank(symbol, right), self._rank(left[has_ahead], symbol[has_ahead])))
            self._set(tree, leaves, np.concatenate((rows, rows, rows[has_ahead])), where, ranks)
            rows = rows[tree[rows, 1] < NONE]
        held = symbols >= 0
        flat, ends = symbols[held].tolist(), np.cumsum(held.sum(axis=1)).tolist()
        start = 0
        for end in ends:
            yield tuple(map(self.ids.__getitem__, flat[start:end]))
            start = end

    @staticmethod
    def _set(tree: np.ndarray, leaves: int, rows: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> None:
        """New ranks at leaves, and the least of both children on the paths from there to the root."""
        flat, base, node = tree.reshape(-1), rows * (2 * leaves), at + leaves
        flat[base + node] = np.where(ranks < NONE, (ranks << 32) | at, NONE)
        for _ in range(leaves.bit_length() - 1):
            node = node >> 1
            child = base + 2 * node
            flat[base + node] = np.minimum(flat[child], flat[child + 1])

    def learn(self, cuts: Iterable[str]) -> None:
        """Encodes those cuts that aren't remembered."""
        fresh = [c for c in set(cuts) if c not in self.known]
        for cut, ids in zip(fresh, self.merge([c.encode() for c in fresh]), strict=True):
            self.known[cut] = ids

    def cuts(self, text: str) -> Iterator[list[str] | int]:
        """The text's cuts in lists of bounded length, and the ids of added tokens between them."""
        for part in self.cut_added.split(text) if self.cut_added else [text]:
            if part in self.added:
                yield self.added[part]
            elif len(part) <= LONG:
                yield self.find.findall(part)
            else:
                found = (m.group() for m in self.find.finditer(part))
                while some := list(islice(found, LONG)):
                    yield some

    def encode(self, cuts: Iterable[list[str] | int], learnt: bool = False) -> Iterator[list[int]]:
        """The ids for each item of ``cuts``, in order; ``learnt``: all cuts are remembered."""
        for some in cuts:
            if isinstance(some, int):
                yield [some]
            else:
                if not learnt:
                    self.learn(some)
                yield list(chain.from_iterable(map(self.known.__getitem__, some)))
                if not learnt:
                    self.forget()

    def forget(self) -> None:
        if len(self.known) > KNOWN:
            self.known.clear()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _codes(path: str, with_ids: bool, with_text: bool = False):
    @kernel.freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path)
        for piece in kernel.pieces(batches, "text"):
            texts = [t or "" for t in piece.column("text").to_pylist()]
            names = ("ids", "decoded") if with_ids else ("n_tokens", "ids_sha256", "decoded_sha256")
            kinds = (pa.list_(pa.int32()), pa.string()) if with_ids else (pa.int64(), pa.string(), pa.string())
            code = _plain if with_ids else _code
            rows = [code(coder, coder.encode(coder.cuts(t))) if len(t) > LONG else None for t in texts]
            cuts = [list(coder.cuts(t)) if len(t) <= LONG else [] for t in texts]
            coder.forget()
            coder.learn(chain.from_iterable(x for c in cuts for x in c if not isinstance(x, int)))
            rows = [code(coder, coder.encode(c, True)) if r is None else r for r, c in zip(rows, cuts, strict=True)]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            same = ["row", "text"] if with_text else ["row"]
            yield pa.RecordBatch.from_arrays([*map(piece.column, same), *columns], names=[*same, *names])

    return run


def _plain(coder: Bpe, parts: Iterable[list[int]]) -> tuple[list[int], str]:
    ids = list(chain.from_iterable(parts))
    return ids, coder.decode(ids).decode("utf-8", "replace")


def _code(coder: Bpe, parts: Iterable[list[int]]) -> tuple[int, str, str]:
    """Number of ids and the digests of ids and decoded text, a bounded part of the text at a time."""
    n, left, digest, back = 0, b"", hashlib.sha256(), hashlib.sha256()
    for ids in parts:
        if not ids:
            continue
        digest.update((("," if n else "") + ",".join(map(coder.decimal.__getitem__, ids))).encode())
        n += len(ids)
        left += coder.decode(ids)
        # a character may end in the next part only if the last three bytes open it
        whole = len(left) - next((i for i in (1, 2, 3) if len(left) >= i and left[-i] >= 0xC0), 0)
        back.update(left[:whole].decode("utf-8", "replace").encode())
        left = left[whole:]
    back.update(left.decode("utf-8", "replace").encode())
    return n, digest.hexdigest(), back.hexdigest()


def encoded(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Every row of ``docs`` as ``row`` with its ``ids`` and the text ``decoded`` from them.

    A null text counts as empty, which has no ids; rows are coded alone."""
    coded = _encoded(docs, text_col, path, True)
    return coded.select(kernel.with_text(docs, text_col, "row", "text").alias("row"), "ids", "decoded")


def recoded(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """The same with ``row`` without its text, for those who go on with the decoded one."""
    return _encoded(docs, text_col, path, False)


def _encoded(docs: DataFrame, text_col: str, path: str | None, with_text: bool) -> DataFrame:
    rows = docs.select(kernel.others(docs, text_col).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    text = "text string, " if with_text else ""
    return rows.mapInArrow(_codes(path or default_vocabulary(), True, with_text), f"row {kind}, {text}ids array<int>, decoded string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: digests of the decimal ids joined by commas and of the decoded text."""
    rows = docs.select(F.struct(F.col(id_col).alias("id")).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(_codes(path or default_vocabulary(), False), f"row {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.select(F.col("row.id").alias(id_col), "n_tokens", "ids_sha256", "decoded_sha256")
