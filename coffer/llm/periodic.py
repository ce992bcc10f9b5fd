"""Periodic runs of words, found with a run-length grammar made by recompression.

Blocks of one repeated symbol and then pairs of neighbouring symbols are replaced by new symbols, again and again. Equal
stretches get equal symbols except near their ends, so the length of the common extension of two places follows from
climbing the levels while symbols agree and descending where they part: a few steps a level, no suffix arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from coffer.llm.rolling import SPACE, U, mixed, parts, utf8

#: A run has at least LEAST words and REPEATS periods.
LEAST = 6
REPEATS = 4
#: Candidates looked at together, and bytes of text; they bound the working memory, except for one longer text.
CHUNK = 1 << 18
PART = 1 << 20


@dataclass
class Level:
    """Symbols of one level. up and head lead to the next one: the parent's index, and whether a symbol begins it;
    reach is how many symbols to step over where two agree (the rest of a block, or one in a level of pairs); down
    leads from a symbol to the first of those it stands for, one level below."""

    symbol: np.ndarray
    down: np.ndarray | None = None
    up: np.ndarray | None = None
    head: np.ndarray | None = None
    reach: np.ndarray | None = None
    blocks: bool = False

    def mirrored(self) -> Level:
        """The same level read from right to left."""
        out = Level(self.symbol[::-1], blocks=self.blocks)
        if self.up is not None:
            first = np.flatnonzero(self.head)
            sizes = np.diff(np.append(first, len(self.head)))
            out.up = (self.up[-1] - self.up)[::-1]
            out.head = np.append(self.head[1:], True)[::-1]
            passed = np.arange(1, len(self.head) + 1, dtype=np.int32)
            out.reach = (passed - np.repeat(first.astype(np.int32), sizes))[::-1] if self.blocks else self.reach
        return out


def _named(keys: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of equal keys, and which of them stand once; what is single already gets a symbol of its own."""
    out, once = np.empty(len(keys), np.int32), np.ones(len(keys), bool)
    _, names, counts = np.unique(keys[~single], return_inverse=True, return_counts=True)
    out[~single] = names
    out[single] = len(counts) + np.arange(np.count_nonzero(single), dtype=np.int32)
    once[~single] = counts[names] == 1
    return out, once


def grammar(symbols: np.ndarray) -> list[Level]:
    """Levels of a sequence whose first and last symbol stand once.

    What stands once cannot be part of a common extension: neighbours of that kind become one symbol. The last level
    has no two neighbours that stand more than once, so a common extension there is one symbol.
    """
    symbol, single = _named(symbols, np.zeros(len(symbols), bool))
    levels, turn = [Level(symbol)], 0
    while np.any(~single[1:] & ~single[:-1]):
        head = np.ones(len(symbol), bool)
        head[1:] = (symbol[1:] != symbol[:-1]) & ~(single[1:] & single[:-1])
        if not head.all():
            sizes = np.diff(np.append(np.flatnonzero(head), len(head)))
            keys = symbol[head].astype(np.int64) * (sizes.max() + 1) + sizes
            symbol, single = _raised(levels, head, sizes, keys, single[head], True)
        # Symbols take sides by a hash; a left one followed by a right one becomes a pair. Each turn deals anew.
        turn += 1
        with np.errstate(over="ignore"):
            left = (mixed(symbol.astype(U) * U(2 * turn + 1) + U(turn)) & U(1)).astype(bool)
        pair = np.zeros(len(symbol), bool)
        pair[:-1] = left[:-1] & ~left[1:] & ~single[:-1] & ~single[1:]
        if pair.any():
            head = np.ones(len(symbol), bool)
            head[1:] = ~pair[:-1]
            follower = np.where(pair, np.append(symbol[1:], 0) + 1, 0)
            sizes = np.diff(np.append(np.flatnonzero(head), len(head)))
            keys = symbol[head].astype(np.int64) * (len(symbol) + 2) + follower[head]
            symbol, single = _raised(levels, head, sizes, keys, single[head], False)
    return levels


def _raised(levels: list[Level], head: np.ndarray, sizes: np.ndarray, keys: np.ndarray, single: np.ndarray, blocks: bool):
    """Completes the last level and adds the next one; head marks where its symbols begin, sizes how many each takes."""
    first, last = np.flatnonzero(head), levels[-1]
    last.head, last.up, last.blocks = head, np.cumsum(head, dtype=np.int32) - np.int32(1), blocks
    places = np.arange(len(head), dtype=np.int32)
    last.reach = np.repeat((first + sizes).astype(np.int32), sizes) - places if blocks else np.ones(len(head), np.int32)
    symbol, single = _named(keys, single)
    levels.append(Level(symbol, down=first.astype(np.int32)))
    return symbol, single


def mirror(levels: list[Level]) -> list[Level]:
    out = [level.mirrored() for level in levels]
    for below, level in zip(levels, out[1:]):
        ends = np.append(np.flatnonzero(below.head)[1:], len(below.head)) - 1
        level.down = (len(below.head) - 1 - ends).astype(np.int32)[::-1]
    return out


def common_extension(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols of the lowest level agree from each place a and b on; a and b differ."""
    x, y = a.copy(), b.copy()
    parted = np.zeros(len(a), np.int16)
    alive = np.arange(len(a))
    for k, level in enumerate(levels):
        same = level.symbol[x[alive]] == level.symbol[y[alive]]
        parted[alive[~same]] = k
        alive = alive[same]
        if not len(alive):
            break
        i, j = x[alive], y[alive]
        if level.up is None:
            # The neighbours of what agrees here stand once.
            x[alive], y[alive], parted[alive] = i + 1, j + 1, k
            break
        step = np.where(level.head[i] & level.head[j], 0, np.minimum(level.reach[i], level.reach[j]))
        i, j = i + step, j + step
        both = level.head[i] & level.head[j]
        x[alive], y[alive] = np.where(both, level.up[i], i), np.where(both, level.up[j], j)
        parted[alive[~both]] = k
        alive = alive[both]
    rest = np.flatnonzero(parted)
    for k in range(int(parted.max(initial=0)), 0, -1):
        rest = rest[parted[rest] > 0]
        here = rest[parted[rest] == k]
        below = levels[k - 1]
        i, j = levels[k].down[x[here]], levels[k].down[y[here]]
        step = np.where(below.symbol[i] == below.symbol[j], np.minimum(below.reach[i], below.reach[j]), 0)
        x[here], y[here], parted[here] = i + step, j + step, k - 1
    return x - a


def _candidates(symbol: np.ndarray, first: np.ndarray, n: np.ndarray):
    """Yields (place, period) where a run may pass: all periods q, a place every 3q words.

    A run of at least REPEATS periods agrees with itself, one period on, over that many words, so it covers a place.
    """
    periods = n // REPEATS * (n >= LEAST)
    doc = np.repeat(np.arange(len(n)), periods)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(LEAST - q, (REPEATS - 1) * q)
    counts = -(-(n[doc] - q) // step)
    ends = np.cumsum(counts)
    at = 0
    while at < len(doc):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
        c = counts[at:to]
        turn = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        place = np.repeat(first[doc[at:to]], c) + turn * np.repeat(step[at:to], c)
        period = np.repeat(q[at:to], c)
        hit = symbol[place] == symbol[place + period]
        yield place[hit], period[hit]
        at = to


def find_runs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, length, period) of all runs in rows of words, by row, start and period.

    words are numbers, row i holding words[offsets[i]:offsets[i + 1]]. A run is a maximal stretch with smallest period
    q and at least max(LEAST, REPEATS * q) words.
    """
    n = np.diff(offsets)
    row = np.repeat(np.arange(len(n)), n)
    # Words of different rows never agree, nor do the ends.
    inner = row * (int(words.max(initial=0)) + 1) + words.astype(np.int64)
    end = int(inner.max(initial=0)) + 1
    symbols = np.concatenate([[end], inner, [end + 1]])
    first = offsets[:-1] + 1
    levels = grammar(symbols)
    back, size = mirror(levels), len(symbols)
    found = []
    for place, q in _candidates(levels[0].symbol, first, n):
        ahead = common_extension(levels, place, place + q)
        behind = common_extension(back, size - place, size - place - q)
        length = ahead + behind + q
        kept = length >= np.maximum(LEAST, REPEATS * q)
        found.append(np.stack([place - behind, length, q])[:, kept])
    start, length, q = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    # A run is met at several places, and with multiples of its period too: the smallest comes first.
    order = np.lexsort([q, length, start])
    start, length, q = start[order], length[order], q[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[smallest], length[smallest], q[smallest]
    order = np.lexsort([q, start])
    start, length, q = start[order], length[order], q[order]
    of = np.searchsorted(first, start, side="right") - 1
    return of, start - first[of], length, q


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as one array, and where each text's words begin in it."""
    word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | cut[1:-1]
    at = np.flatnonzero(begins)
    bounds = np.concatenate([[0], np.cumsum(word)])[np.append(at, len(data))].astype(np.int32)
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[word]))]
    return pa.BinaryArray.from_buffers(pa.binary(), len(at), buffers), np.searchsorted(at, offsets)


def _of_part(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    words, bounds = _words(data, offsets)
    codes = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, np.int32)
    row, start, length, q = find_runs(codes, bounds)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, bounds[row] + start + q, 1)
    np.add.at(change, bounds[row] + start + length, -1)
    kept = np.cumsum(change)[:-1] == 0
    left = np.concatenate([[0], np.cumsum(kept)])[bounds].astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(left), words.filter(pa.array(kept))), b" ")
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, q)], ["start", "length", "period"])
    of_rows = pa.array(np.searchsorted(row, np.arange(len(offsets))).astype(np.int32))
    return [pa.array(np.diff(bounds).astype(np.int64)), pa.ListArray.from_arrays(of_rows, runs), joined.cast(pa.string())]


def collapsed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs and collapsed of every row.

    Words are what white space of ASCII parts, in the whole text, case kept. runs has every (start, length, period) by
    start and then period, start being a word's number from zero. collapsed is the text's words joined by one space,
    without those that any run holds after its first period. NULL and empty texts have no words, no runs and an empty
    collapsed text. Every row gives a row, repeated ones too, with or without doc_id; other columns are left out.

    No row moves; the working memory is bounded by PART bytes of text, or by one longer text.
    """
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in parts(offsets, PART):
                inner = offsets[first : last + 1] - offsets[first]
                columns = _of_part(data[offsets[first] : offsets[last]], inner)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *columns], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words bigint, runs {runs}, collapsed string")
