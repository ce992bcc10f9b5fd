"""Near duplicates by SimHash fingerprints, joined on a grid of bit counts.

A fingerprint is cut into segments of two bits; the bit counts of its segments place it on an integer grid. Every
differing bit moves one count by one at most, so the Manhattan distance on the grid never exceeds the Hamming distance.
Of two fingerprints that differ in three bits or fewer, one half of the counts is at most one step apart. The join
therefore looks, for each half, at a fingerprint's own cell and those one step away, and then compares all bits.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.llm.components import connected_components
from coffer.llm.rolling import SLICE, SPACE
from coffer.llm.shared import Scratch

SEED = 42
#: Fingerprints that are compared with each other at a time, each list against another.
BLOCK = 512
#: Fingerprints link at this many differing bits or fewer. Each half of the grid is searched to MOST // 2 steps: one.
MOST = 3
HALVES = 2
#: Segments of two bits in a half.
SEGMENTS = 16
#: For each value of a byte, its bits as eight bytes in one integer: up to 255 of them add up without a carry.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _pieces(data: bytes):
    """The text in stretches of about SLICE bytes, cut at white space."""
    at = 0
    while len(data) - at > SLICE:
        end = at + SLICE
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def shingle_hashes(data: bytes, width: int):
    """Arrays of the XXH64 of each shingle of the text, repeats included."""
    carried: list[bytes] = []
    found = False
    for piece in _pieces(data.lower()):
        words = carried + piece.split()
        carried = words[len(words) - min(len(words), width - 1) :]
        if len(words) >= width:
            found = True
            shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - width + 1)
    if carried and not found:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)], np.uint64)


def fingerprint(data: bytes, width: int) -> int:
    """Each bit is set if it is in more than half of the shingles' hashes; as a signed integer."""
    n, counts = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(data, width):
        bits = SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(bits, np.arange(0, len(hashes), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and the 64-bit fingerprint of every row's whole text; zero without words (NULL has none)."""

    def run(batches):
        for batch in batches:
            found = [fingerprint((text or "").encode(), width) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint bigint")


def _on_grid(points: DataFrame) -> DataFrame:
    """Rows (half, cell, point, home): each point in its own cell of either half and, where the half's bit count is
    even, also in the cells one step away. One step changes that count's parity, so pairs one step apart meet where
    the odd one is at home.
    """
    parts = [f"shiftrightunsigned(point, {32 * half}) & 4294967295" for half in range(HALVES)]
    halves = F.array(*[F.struct(F.lit(i).cast("byte").alias("half"), F.expr(bits).alias("bits")) for i, bits in enumerate(parts)])
    # Neighbouring bits add up to a count of two bits: the counts of a half are one integer, and so name a cell.
    own = F.expr("(bits & 1431655765L) + (shiftrightunsigned(bits, 1) & 1431655765L)")
    placed = points.select("point", F.inline(halves)).select("half", "point", own.alias("own"), (F.bit_count("bits") % 2 == 0).alias("even"))
    step = "shiftleft(1L, 2 * s)"
    count = "(shiftrightunsigned(own, 2 * s) & 3)"
    around = (
        f"flatten(transform(sequence(0, {SEGMENTS - 1}), s -> "
        f"filter(array(if({count} < 2, own + {step}, null), if({count} > 0, own - {step}, null)), c -> c is not null)))"
    )
    home = placed.select("half", F.col("own").alias("cell"), "point", F.lit(True).alias("home"))
    away = placed.where("even").select("half", F.explode(F.expr(around)).alias("cell"), "point", F.lit(False).alias("home"))
    return home.union(away)


def _blocks(points: DataFrame, block: int) -> DataFrame:
    """Points of each cell in lists of about block points: (half, cell, home, part, members).

    Cells in which nothing can meet are left out. Cells are counted before anything is gathered, so no list grows with
    its cell, and a crowded cell becomes many lists in many tasks.
    """
    grid = _on_grid(points)
    sizes = grid.groupBy("half", "cell").agg(F.count_if("home").alias("at_home"), F.count(F.lit(1)).alias("all"))
    sizes = sizes.where("at_home > 0 and all > 1")
    size = F.when(F.col("home"), F.col("at_home")).otherwise(F.col("all") - F.col("at_home"))
    part = F.pmod(F.xxhash64("point"), F.ceil(size / block)).cast("int")
    return (
        grid.join(sizes, ["half", "cell"])
        .groupBy("half", "cell", "home", part.alias("part"))
        .agg(F.collect_list("point").alias("members"))
    )


def _joined(left: np.ndarray, right: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what lies within most bits: every point with the first one of its group, so fewer pairs than points."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= most
    n = len(left)
    of_left, of_right = np.arange(n), n + np.arange(len(right))
    while True:
        best = np.minimum(of_right, np.where(near, of_left[:, None], n + len(right)).min(0))
        following = np.minimum(of_left, np.where(near, best[None, :], n + len(right)).min(1))
        if np.array_equal(best, of_right) and np.array_equal(following, of_left):
            break
        of_left, of_right = following, best
    points = np.concatenate([left, right])
    firsts = points[np.concatenate([of_left, of_right])]
    differ = points != firsts
    return points[differ], firsts[differ]


def links(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) over which points (column point, distinct) at MOST differing bits or fewer are connected.

    Lists of a cell are compared two at a time, all bits of their members at once; only links that connect new members
    leave a comparison, never all pairs of a group.
    """
    blocks = _blocks(points, block)
    at_home = blocks.where("home").select("half", "cell", "part", "members")
    others = blocks.select("half", "cell", "home", F.col("part").alias("other_part"), F.col("members").alias("others"))
    meeting = at_home.join(others, ["half", "cell"]).where("not home or part < other_part or (part = other_part and size(others) > 1)")

    def run(batches):
        for batch in batches:
            members, others = batch.column(0), batch.column(1)
            found = [
                _joined(m.values.to_numpy().view(np.uint64), o.values.to_numpy().view(np.uint64), MOST)
                for m, o in zip(members, others)
            ]
            a, b = (np.concatenate([f[i] for f in found]).view(np.int64) if found else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return meeting.select("members", "others").mapInArrow(run, "a bigint, b bigint").distinct()


def as_hex(column: str) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def near_duplicates(docs: DataFrame, width: int = 3, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (bigint) and component_id of every row.

    Texts are lower-cased (A-Z) and cut at white space of ASCII; a shingle is width words joined by spaces, repeats
    count, a shorter text is one shingle, and a text without words (NULL too) has fingerprint zero, which links like any
    other. component_id is the smallest doc_id reachable over links of MOST differing bits or fewer, itself included.

    Every row gives a row, repeated ones too. Rows are linked by their fingerprints alone, so rows that share a doc_id
    are linked only if their texts are. Rows without doc_id link like others but never name a component: it is NULL
    where no row of it has a doc_id. Other columns are left out, whatever their names; doc_id may be of any type that
    has an order. Rows of one fingerprint become one point before anything is joined.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.table(fingerprints(docs, width), "fingerprints")
    points = scratch.table(rows.groupBy(F.col("fingerprint").alias("point")).agg(F.min("doc_id").alias("first")), "points")
    found = scratch.table(links(points.select("point"), block), "links")
    components = scratch.table(connected_components(found, scratch), "components")
    linked = points.join(components, F.col("point") == F.col("node"))
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    joined = components.join(least, "component").select("node", "least")
    named = points.join(joined, F.col("point") == F.col("node"), "left").select(
        "point", F.when(F.col("node").isNotNull(), F.col("least")).otherwise(F.col("first")).alias("component_id")
    )
    return rows.join(named, F.col("fingerprint") == F.col("point")).select("doc_id", "fingerprint", "component_id")
