"""Word and n-gram hashes of a whole Arrow string column by array arithmetic.

The bytes of the column are read in place.  A word is a run of bytes other than
the six ASCII blanks within one row; A-Z count as a-z.  Its 64-bit hash sums a
random number per byte value times one per place in the word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE_BYTES = 512 << 10
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_random = np.random.default_rng(20)
_BYTE = _random.integers(1, 1 << 63, 256).astype(U) * U(2) + U(1)
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _random.integers(1, 1 << 63, 256).astype(U) * U(2) + U(1)
BASE, MIX = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9)


class Words:
    """``hashes`` of all words of a column; row i has words ``first[i]`` to ``first[i + 1]``.

    ``starts`` and ``ends`` are their places in ``data``.
    """

    def __init__(self, column: pa.Array):
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        _, places, data = column.buffers()
        bounds = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.data = data = data[bounds[0]:bounds[-1]]
        bounds -= bounds[0]
        inside = ~_BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        before = np.append(False, inside[:-1]) if len(data) else inside
        after = np.append(inside[1:], False) if len(data) else inside
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        """In pieces of about PIECE_BYTES, so that long texts need no wide arrays."""
        out = np.empty(len(self.starts), U)
        begin = 0
        while begin < len(out):
            stop = int(np.searchsorted(self.starts, self.starts[begin] + PIECE_BYTES, side="left"))
            stop = max(stop, begin + 1)
            starts, ends = self.starts[begin:stop], self.ends[begin:stop]
            low, lengths = starts[0], ends - starts
            place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            taken = self.data[low:ends[-1]][place + np.repeat(starts - low, lengths)]
            values = _BYTE[taken] * (_PLACE[place & 255] + (place >> 8).astype(U) * BASE)
            sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
            out[begin:stop] = _mixed(sums + lengths.astype(U) * BASE)
            begin = stop
        return out

    def grams(self, size: int) -> np.ndarray:
        """Hashes of ``size`` successive words by first word, across rows as well."""
        h = self.hashes
        if len(h) < size:
            return np.zeros(0, U)
        return fold([h[k:len(h) - size + 1 + k] for k in range(size)])

    def rows(self, size: int):
        """Per row its n-gram hashes in word order; fewer words than ``size`` are one n-gram."""
        every, first = self.grams(size), self.first
        for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
            if end - begin >= size:
                yield every[begin:end - size + 1]
            else:
                yield fold([self.hashes[k:k + 1] for k in range(begin, end)])


def fold(parts: list[np.ndarray]) -> np.ndarray:
    """One hash from the hashes of a sequence, element by element; its length counts."""
    if not parts:
        return np.zeros(0, U)
    out = np.full(len(parts[0]), len(parts), U)
    for part in parts:
        out = out * BASE + part
        out ^= out >> U(29)
    return _mixed(out)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * MIX
    return values ^ (values >> U(32))
