"""Hashes of words and byte strings of whole Arrow columns, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: An odd factor has an inverse modulo 2**64, so hashes of inner strings come from prefix sums.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
#: Bytes hashed at a time; bounds the working memory to some 60 bytes each.
SLICE = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


VALUES = mixed(np.arange(1, 257, dtype=U) * U(FACTOR))
FOLDED = VALUES.copy()
FOLDED[65:91] = VALUES[97:123]

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR**i and its inverse for i below n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE + 64)
        with np.errstate(over="ignore"):
            _powers[:] = [
                np.multiply.accumulate(np.concatenate([[U(1)], np.full(size - 1, U(f))])) for f in (FACTOR, INVERSE)
            ]
    return _powers[0][:n], _powers[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL has no bytes."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


def parts(offsets: np.ndarray, size: int = SLICE):
    """Ranges of rows that have about size bytes together, or one row that has more."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, last
        first = last


def _word_hashes(data: np.ndarray, starts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of data; none goes across the given places."""
    word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts_at] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | cut[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | cut[1:-1]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(len(data) + 1)
    sums = np.concatenate([[U(0)], np.cumsum(FOLDED[data] * up[:-1], dtype=U)])
    return mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(U)), s


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """Yields (row, hashes of its words after lower-casing A-Z); words are what white space of ASCII parts."""
    for first, last in parts(offsets):
        base = int(offsets[first])
        if last == first + 1 and offsets[last] - base > SLICE:
            yield first, _long(data[base : offsets[last]])
            continue
        inner = offsets[first : last + 1] - base
        hashes, at = _word_hashes(data[base : offsets[last]], inner)
        bounds = np.searchsorted(at, inner)
        for row in range(last - first):
            yield first + row, hashes[bounds[row] : bounds[row + 1]]


def _long(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, slice by slice, cut at white space."""
    out, at = [], 0
    while at < len(data):
        end = at + SLICE
        if end < len(data):
            near = np.flatnonzero(SPACE[data[at:end]])
            while not len(near) and end < len(data):
                end += SLICE
                near = np.flatnonzero(SPACE[data[at:end]])
            end = at + int(near[-1]) + 1 if len(near) else len(data)
        out.append(_word_hashes(data[at:end], np.zeros(1, np.int64))[0])
        at = end
    return np.concatenate(out)
