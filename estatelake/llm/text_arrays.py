"""Texts of an Arrow batch as byte arrays: words, hashes of words and of windows.

A word is a run of bytes other than blank and tab to carriage return, with A-Z in
lower case.  Hashes are differences of prefix sums of a polynomial modulo 2**64,
so any window of a text costs one subtraction and one product; a finaliser
spreads the bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Odd multipliers of the two independent polynomials.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
WORD = np.ones(256, dtype=bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and the n + 1 starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    starts = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column) or starts[-1] == starts[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(starts: np.ndarray, most: int, most_rows: int = 1 << 17):
    """Row ranges whose texts have about ``most`` bytes together; a longer text is alone."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = int(np.searchsorted(starts, starts[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows, first + most_rows)
        yield first, last
        first = last


def finish(values: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits after which all bits depend on all bits."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class Hasher:
    """Hashes of byte windows; made once per task, as it keeps the powers of its base.

    Work goes over ``SEGMENT`` bytes at a time, so memory is bounded for texts of any length.
    """

    SEGMENT = 1 << 20

    def __init__(self, base: int = BASES[0]):
        self._base = base
        self._up = self._down = np.ones(0, dtype=np.uint64)

    def _room(self, least: int) -> None:
        if len(self._up) < least:
            ones = np.ones(1, dtype=np.uint64)
            inverse = pow(self._base, -1, 1 << 64)
            self._up = np.cumprod(np.append(ones, np.full(least, self._base, dtype=np.uint64)))
            self._down = np.cumprod(np.append(ones, np.full(least, inverse, dtype=np.uint64)))

    def windows(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[begin:end]; ``begin`` rises."""
        result = np.empty(len(begin), dtype=np.uint64)
        at = 0
        while at < len(begin):
            low = int(begin[at])
            to = int(np.searchsorted(begin, low + self.SEGMENT, side="left"))
            high = int(end[at:to].max())
            part = data[low:high]
            self._room(len(part) + 1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self._up[: len(part)], out=sums[1:])
            first = begin[at:to] - low
            result[at:to] = finish((sums[end[at:to] - low] - sums[first]) * self._down[first])
            at = to
        return result

    def words(
        self, data: np.ndarray, starts: np.ndarray, inside: np.ndarray = WORD
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, begin and end of every word, and the number of words before each text (n + 1).

        ``inside`` says of each byte value whether it is part of a word.
        """
        begin, end = word_bounds(data, starts, inside)
        return self.windows(LOWER[data], begin, end), begin, end, np.searchsorted(begin, starts, side="left")


def word_bounds(data: np.ndarray, starts: np.ndarray, inside: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inside = inside[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[starts] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1
