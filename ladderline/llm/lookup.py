"""A table from 64-bit keys to places, looked up by whole arrays."""

from __future__ import annotations

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Lookup:
    """Values by 64-bit key, in a table with open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, room: int = 2):
        """``room``: slots per key; with more of them a key that isn't there is told apart sooner."""
        self.mask = np.uint64((1 << max(4, (room * len(keys)).bit_length())) - 1)
        self.index = np.zeros(int(self.mask) + 1, dtype=np.int32)  # place + 1
        self.keys, self.values = keys, values
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.index[slot] == 0
            at, first = np.unique(slot[free], return_index=True)
            self.index[at] = left[free][first] + 1
            placed = np.zeros(len(left), dtype=bool)
            placed[np.flatnonzero(free)[first]] = True
            left, slot = left[~placed], (slot[~placed] + 1) & int(self.mask)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD >> np.uint64(29)) & self.mask).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it isn't there."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.keys):
            return out
        slot = self._slot(keys)
        at = self.index[slot]
        some = np.flatnonzero(at)
        at = at[some] - 1
        hit = self.keys[at] == keys[some]
        out[some[hit]] = at[hit]
        left = some[~hit]
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & int(self.mask)
            at = self.index[slot]
            hit = (at > 0) & (self.keys[at - 1] == keys[left])
            out[left[hit]] = at[hit] - 1
            more = (at > 0) & ~hit
            left, slot = left[more], slot[more]
        return out


