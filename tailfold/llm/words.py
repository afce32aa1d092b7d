"""Words of whole Arrow batches as 64-bit hashes, without a Python object per word.

The bytes of all texts of a batch form one buffer.  A word is a run of bytes outside
``[\\x20\\x09-\\x0D]``; its hash is a polynomial over its bytes modulo 2**64, taken from prefix
sums and then mixed.  Bytes of UTF-8 sequences are never white space or ASCII letters, so working
on bytes is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text that are held as arrays at a time (a longer text is taken alone).
SLICE_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n - 1 of the base and of its inverse, modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n], _inverses[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slice:
    """Rows ``first .. first + rows - 1`` of a batch."""

    first: int
    rows: int
    data: np.ndarray      # uint8, all texts after one another
    offsets: np.ndarray   # rows + 1 byte offsets into data
    starts: np.ndarray    # of every word
    ends: np.ndarray
    bounds: np.ndarray    # rows + 1 offsets into the words

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A hash of every word; of ``data``, which has a byte for each byte, if given."""
        data = self.data if data is None else data
        powers, inverses = _tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
        return mix64((sums[self.ends] - sums[self.starts]) * inverses[self.starts])

    def lowered(self) -> np.ndarray:
        """The bytes with A-Z in lower case."""
        upper = (self.data >= 65) & (self.data <= 90)
        return self.data + (upper * np.uint8(32))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def byte_classes(symbols_apart: bool = False) -> np.ndarray:
    """The class of every byte: 0 for white space, 1 for words, 2 for symbols if they stand apart.

    Words are then runs of ASCII letters and digits and of bytes beyond ASCII.
    """
    classes = np.ones(256, np.uint8)
    classes[[32, *range(9, 14)]] = 0
    if symbols_apart:
        for byte in range(128):
            if classes[byte] and not chr(byte).isalnum():
                classes[byte] = 2
    return classes


WORDS = byte_classes()


def slices(column: pa.Array, classes: np.ndarray = WORDS,
           size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a batch in order, about ``size`` bytes at a time; words are runs of one class."""
    data, offsets = text_buffers(column)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        own = offsets[first:last + 1]
        part, own = data[own[0]:own[-1]], own - own[0]
        kind = classes[part]
        edge = np.ones(len(part) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[own] = True  # a word does not run on from one text to the next
        edges = np.flatnonzero(edge)
        word = kind[edges[:-1]] > 0
        starts, ends = edges[:-1][word], edges[1:][word]
        yield Slice(first, last - first, part, own, starts, ends,
                    np.searchsorted(starts, own, "left"))
        first = last
