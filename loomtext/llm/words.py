"""Words and word windows of whole Arrow batches as 64-bit hashes, computed with numpy.

A batch is cut into slices of about ``SLICE_BYTES`` so that memory stays bounded whatever the
batch; a text longer than that is a slice of its own. Hashes are polynomials over the bytes of a
word, mixed, so equal words always have equal hashes. Exact checks are the callers' business.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BYTE = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.uint64(0xD6E8FEB86659FD93)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_1
    h = (h ^ (h >> np.uint64(27))) * _MIX_2
    return h ^ (h >> np.uint64(31))


def _table(separators: set[int], lower: bool) -> np.ndarray:
    """Byte to 0 (separator) or 1 + the byte, lower-cased if asked."""
    out = np.arange(1, 257, dtype=np.uint16)
    if lower:
        out[65:91] += 32
    for b in separators:
        out[b] = 0
    return out


SPACES = {0x20, *range(0x09, 0x0E)}
# Bytes between words of letters and digits; A-Z count as their lower-case letters.
PUNCTUATION = {*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}

SPACED = _table(SPACES, lower=False)
SPACED_LOWER = _table(SPACES, lower=True)
PLAIN_LOWER = _table(PUNCTUATION, lower=True)

# Bytes that end a piece of text; words inside a piece are apart by blanks and tabs.
PIECE_ENDS = {*b".,;:!?", *range(0x0A, 0x0E)}
PIECED_LOWER = _table({*PIECE_ENDS, 0x20, 0x09}, lower=True)


@dataclass
class Words:
    """The words of the rows ``first`` to ``first + rows - 1`` of a batch.

    ``data`` holds the slice's bytes; word i is ``data[start[i]:end[i]]`` of row ``row[i]`` (counted
    from ``first``) and has number ``at[i]`` there; row r holds the words
    ``bounds[r]:bounds[r + 1]``.
    """

    first: int
    rows: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    at: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the window that starts at each word, and whether it ends inside its row."""
        n = len(self.hashes)
        out = np.zeros(n, dtype=np.uint64)
        if n < size:
            return out, np.zeros(n, dtype=bool)
        last = n - size + 1
        for j in range(size):
            out[:last] *= _WORD
            out[:last] += self.hashes[j : last + j]
        return mix(out), self.at + size <= np.diff(self.bounds)[self.row]

    def text(self, first: int, last: int) -> list[bytes]:
        """The bytes of the words ``first`` to ``last - 1``, as they stand in the text."""
        return [self.data[self.start[i] : self.end[i]].tobytes() for i in range(first, last)]


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _words(data: np.ndarray, cuts: np.ndarray, table: np.ndarray, first: int, base: np.uint64) -> Words:
    rows, n = len(cuts) - 1, len(data)
    values = table[data]
    inside = values != 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = cuts[:-1][cuts[:-1] < n]
    starts[heads] = inside[heads]  # a row's first byte starts a word
    start = np.flatnonzero(starts)
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        bounds = np.zeros(rows + 1, dtype=np.int64)
        return Words(first, rows, data, none, none, none, none, bounds, none.astype(np.uint64))
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | starts[1:]
    end = np.flatnonzero(ends) + 1
    length = end - start
    firsts = np.cumsum(length) - length  # of each word among the bytes inside words
    place = np.arange(firsts[-1] + length[-1]) - np.repeat(firsts, length)
    pieces = values[inside] * _powers(base, int(length.max()))[place]
    hashes = mix(np.add.reduceat(pieces, firsts))
    bounds = np.searchsorted(start, cuts)
    sizes = np.diff(bounds)
    row = np.repeat(np.arange(rows), sizes)
    return Words(first, rows, data, start, end, row, np.arange(len(start)) - np.repeat(bounds[:-1], sizes), bounds, hashes)


def batch_words(texts: pa.Array, table: np.ndarray, base: np.uint64 = _BYTE) -> Iterator[Words]:
    """The words of a string column, slice by slice; null texts have no words.

    ``base`` is the odd number whose powers weigh the bytes of a word in its hash.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(offsets[-1]) if len(offsets) else 0
    data = np.frombuffer(buffers[2], dtype=np.uint8) if size else np.zeros(0, dtype=np.uint8)
    for first, last in _slices(offsets):
        cuts = offsets[first : last + 1]
        yield _words(data[cuts[0] : cuts[-1]], cuts - cuts[0], table, first, base)
