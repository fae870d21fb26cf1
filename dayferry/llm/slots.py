"""Values of 64-bit hashes, inside tasks."""

from __future__ import annotations

import numpy as np


class Slots:
    """The values of sorted, different keys that are spread evenly over 64 bits, as hashes are.

    The first bits of a key name its slot, which holds about one key; keys of a slot are tried in order. So most
    keys are found at the first place looked at, where a binary search waits for memory at each of its steps.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values, self.last = keys, values, len(keys) - 1
        bits = max(len(keys), 1).bit_length()
        self.shift = np.uint64(64 - bits)
        slots = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.minimum(np.cumsum(slots) - slots, self.last).astype(np.int32)

    def __call__(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each key, 0 if there is none, and whether there is one."""
        if self.last < 0:
            return np.zeros(len(wanted), self.values.dtype), np.zeros(len(wanted), bool)
        at = self.first[(wanted >> self.shift).astype(np.int64)]
        later = np.flatnonzero(self.keys[at] < wanted)
        while len(later):
            later = later[at[later] < self.last]
            at[later] += 1
            later = later[self.keys[at[later]] < wanted[later]]
        there = self.keys[at] == wanted
        return np.where(there, self.values[at], self.values.dtype.type(0)), there
