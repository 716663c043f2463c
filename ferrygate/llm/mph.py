"""Minimal perfect hashing of distinct 64-bit keys in numpy.

Keys that are alone in their cell of a level's bit field own that cell; the others go on to the next, smaller level. A key's slot is
the number of owned cells before its own, so ``n`` keys have the slots ``0 .. n - 1`` and nothing is stored but the bits, about
three a key. A key that was never put in gets some slot or none: what is stored beside the slots has to verify it.
"""

from __future__ import annotations

import numpy as np

#: Cells per key of a level.
LOAD = 1.6
LEVELS = 64
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of unsigned 64-bit ``keys``."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * _A
        h = (h ^ (h >> np.uint64(27))) * _B
    return h ^ (h >> np.uint64(31))


def _cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return ((mixed(keys, level) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


class MinimalPerfectHash:
    """Slots of a fixed set of keys; ``sizes`` and ``bits`` are all there is to store."""

    def __init__(self, sizes: np.ndarray, bits: bytes):
        self.sizes = np.asarray(sizes, np.int64)
        self.bits = bits
        self.owned = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(self.sizes.sum())).astype(bool)
        self.before = np.concatenate(([0], np.cumsum(self.owned, dtype=np.int64)))
        self.n = int(self.before[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        """Of distinct unsigned 64-bit ``keys``."""
        left, sizes, fields = np.asarray(keys, np.uint64), [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(8, int(len(left) * LOAD))
            cells = _cells(left, level, size)
            field = np.bincount(cells, minlength=size) == 1
            sizes.append(size)
            fields.append(field)
            left = left[~field[cells]]
        if len(left):
            raise ValueError("some keys are equal")
        field = np.concatenate(fields) if fields else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), np.packbits(field).tobytes())

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 where no level owns one."""
        keys = np.asarray(keys, np.uint64)
        found, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            cells = base + _cells(keys[todo], level, size)
            mine = self.owned[cells]
            found[todo[mine]] = self.before[cells[mine]]
            todo = todo[~mine]
            base += size
        return found
