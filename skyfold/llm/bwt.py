"""Classes of equal fixed-length substrings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

The passages of a task are joined with separators and their suffixes sorted. From the interval of all suffixes, intervals are
extended backwards symbol by symbol, breadth first, with ranks from a wavelet matrix over the transform. The level at which a
right bound is first reached is the common prefix at that bound, so common prefixes come out by increasing value, and the
expansion stops at the minimum length: bounds not reached by then lie inside a class of suffixes that share that many bytes.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0


def sorted_suffixes(text: np.ndarray, length: int) -> np.ndarray:
    """Positions of ``text`` (symbols under 512, read as a circle), ordered by their next ``length`` symbols or more."""
    n, covered = len(text), 7
    wide = np.concatenate([text, np.resize(text, 6)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << np.uint64(9)) | wide[j : j + n]
    while True:
        order = np.argsort(key)
        ranked = key[order]
        fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        if covered >= length or fresh.all():
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(fresh).astype(np.uint64)
        key = (rank << np.uint64(32)) | np.roll(rank, -(covered % n))
        covered *= 2


class WaveletMatrix:
    """Ranks of all symbols of a sequence at once: one bit of the symbols for each level."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.n = len(sequence)
        self.levels: list[tuple[np.ndarray, int]] = []
        for bit in reversed(range(max(1, int(symbols - 1).bit_length()))):
            ones = (sequence >> bit) & 1
            zeros_before = np.zeros(self.n + 1, np.int32)
            np.cumsum(1 - ones, out=zeros_before[1:], dtype=np.int32)
            self.levels.append((zeros_before, int(zeros_before[-1])))
            picked = ones.astype(bool)
            sequence = np.concatenate([sequence[~picked], sequence[picked]])
        code, low, _ = self._descend(np.array([0], np.int32), np.array([self.n], np.int32))
        self.first = np.zeros(symbols, np.int32)
        self.first[code] = low

    def _descend(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code = np.zeros(len(low), np.int32)
        for zeros_before, zeros in self.levels:
            a, b = zeros_before[low], zeros_before[high]
            c, d = zeros + low - a, zeros + high - b
            left, right = b > a, d > c
            low, high = np.concatenate([a[left], c[right]]), np.concatenate([b[left], d[right]])
            code = np.concatenate([2 * code[left], 2 * code[right] + 1])
        return code, low, high

    def extensions(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every interval and symbol in it: the symbol, and how often it occurs before the interval's bounds."""
        code, low, high = self._descend(low, high)
        return code, low - self.first[code], high - self.first[code]


def class_bounds(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True at each rank whose suffix shares fewer than ``length`` symbols with the one before.

    Symbols are dense from 0, the separator. Substrings that go on after a separator are not told apart.
    """
    n = len(text)
    symbols = int(text.max()) + 1
    transform = text[order - 1]
    matrix = WaveletMatrix(transform, symbols)
    counts = np.bincount(text, minlength=symbols)
    before = (np.cumsum(counts) - counts).astype(np.int32)
    reached = np.zeros(n + 1, bool)
    reached[0] = reached[n] = True
    low, high = np.array([0], np.int32), np.array([n], np.int32)
    for level in range(length):
        code, low, high = matrix.extensions(low, high)
        if level:
            inside = code != SEPARATOR
            code, low, high = code[inside], low[inside], high[inside]
        low, high = before[code] + low, before[code] + high
        new = ~reached[high]
        low, high = low[new], high[new]
        reached[high] = True
        if not len(low):
            break
    return reached[:n]


def least_by_class(rows: np.ndarray, sizes: np.ndarray, values: np.ndarray, length: int) -> np.ndarray:
    """For each window of ``length`` bytes of each passage: the least value of the passages that hold the same window.

    ``rows`` holds the passages' bytes, one passage in a row of fixed width, ``sizes`` their lengths. Windows beyond a passage
    have the largest value.
    """
    count, width = rows.shape
    column = np.arange(width + 1)
    padded = np.zeros((count, width + 1), np.uint16)
    padded[:, :width] = rows.astype(np.uint16) + 1
    padded[column[None, :] >= sizes[:, None]] = SEPARATOR
    used = column[None, :] <= sizes[:, None]
    text = padded[used]
    alphabet = np.zeros(257, np.uint16)
    present = np.unique(text)
    alphabet[present] = np.arange(len(present), dtype=np.uint16)
    text = alphabet[text]
    windows = width - length + 1
    valid = (column[None, :] + length <= sizes[:, None])[used]
    worst = np.iinfo(np.int64).max
    value = np.where(valid, np.repeat(values, sizes + 1), worst)

    order = sorted_suffixes(text, length)
    bounds = class_bounds(text, order, length)
    least = np.minimum.reduceat(value[order], np.flatnonzero(bounds))
    found = np.empty(len(text), np.int64)
    found[order] = least[np.cumsum(bounds) - 1]
    out = np.full((count, width + 1), worst)
    out[used] = np.where(valid, found, worst)
    return out[:, :windows]
