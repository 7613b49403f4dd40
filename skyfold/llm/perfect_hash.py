"""Minimal perfect hashing: distinct keys to the numbers 0 .. n-1, in a few bits a key.

Each level is a bit array. Keys that are alone at their place in a level set its bit; those that meet go on to the next, until none is
left. A key's number is the count of set bits before its own.
"""

from __future__ import annotations

import numpy as np

#: Places of a level for each key that reaches it.
PLACES_A_KEY = 2
LEAST_PLACES = 64

U64 = np.uint64


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Places of 64-bit keys in a level, by a mixing of bits that differs from level to level."""
    h = keys.astype(U64) + U64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (h ^ h >> U64(30)) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> U64(27)) * U64(0x94D049BB133111EB)
    return ((h ^ h >> U64(31)) % U64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.before = np.cumsum([0] + [int(bits.sum()) for bits in levels])
        self.ranks = [np.cumsum(bits, dtype=np.int64) - bits for bits in levels]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct ``keys``."""
        levels = []
        while len(keys):
            size = max(LEAST_PLACES, PLACES_A_KEY * len(keys))
            places = _places(keys, len(levels), size)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[places]]
        return cls(levels)

    def __len__(self) -> int:
        return int(self.before[-1])

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number. A key that the hash wasn't made of gets any number, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            places = _places(keys[left], level, len(bits))
            hit = bits[places]
            out[left[hit]] = self.before[level] + self.ranks[level][places[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        sizes = np.asarray([len(self.levels), *[len(b) for b in self.levels]], "<u8").tobytes()
        return sizes + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        (count,) = np.frombuffer(raw, "<u8", 1).tolist()
        levels, at = [], 8 * (count + 1)
        for size in np.frombuffer(raw, "<u8", count, 8).tolist():
            held = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, held, at), count=size).astype(bool))
            at += held
        return cls(levels)
