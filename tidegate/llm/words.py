"""Words of many texts as arrays: runs of letters, or of letters and digits, lower-cased and hashed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from .bpe import LETTER, NUMBER, classes
from .frames import code_points

_MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def lower_codes() -> np.ndarray:
    """Lower-case code point of every code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@dataclass
class Words:
    """Begin and end of every word in ``low``, the lower-cased code points; ``rows`` is where each text's words begin, and the end."""

    low: np.ndarray
    part: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def whole(self) -> np.ndarray:
        """A hash of each word: a sum over its characters that depends on their places."""
        n = len(self.low)
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        begins = np.concatenate(([0], self.starts))
        place = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
        each = mixed((self.low + np.uint64(1)) * _MIX + place.astype(np.uint64))
        each[~self.part] = 0
        return mixed(np.add.reduceat(each, self.starts))

    def edges(self, sizes: tuple[int, ...], from_end: bool = False) -> list[np.ndarray]:
        """Hashes of the first, or last, characters of each word, for rising numbers of characters."""
        size = self.ends - self.starts
        h = np.zeros(len(self.starts), np.uint64)
        out = []
        for i in range(max(sizes)):
            more = np.flatnonzero(size > i)
            at = self.ends[more] - 1 - i if from_end else self.starts[more] + i
            h[more] = mixed(h[more] * _MIX + self.low[at] + np.uint64(7 if from_end else 1))
            if i + 1 in sizes:
                out.append(h.copy())
        return out


def words_of(texts: pa.Array, digits: bool = False) -> Words:
    codes, bounds, _, _ = code_points(texts)
    kind = classes()[codes]
    part = (kind == LETTER) | (kind == NUMBER) if digits else kind == LETTER
    at_text = bounds[:-1][bounds[:-1] < len(codes)]
    first, last = part.copy(), part.copy()
    first[1:] &= ~part[:-1]
    first[at_text] = part[at_text]
    last[:-1] &= ~part[1:] | first[1:]
    starts = np.flatnonzero(first)
    return Words(lower_codes()[codes].astype(np.uint64), part, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds))
