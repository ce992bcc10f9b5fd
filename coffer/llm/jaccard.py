"""Exact set-similarity join on word n-grams that skips by the relations between sets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coffer.llm.components import connected_components
from coffer.llm.rolling import FACTOR, U, mixed, utf8, word_hashes
from coffer.llm.shared import Scratch, perhaps_in

WORDS = 5
#: Two sets are linked when 100 * shared >= 75 * all, that is 4 * shared >= 3 * all.
NUMERATOR, DENOMINATOR = 3, 4
#: Shingles whose counts order the sets; a bound on what is broadcast. The order decides only how much work is skipped.
KNOWN_COUNTS = 1 << 20
#: Shingles counted together in a task.
COUNTED = 1 << 21
#: Rows that a task hands on at a time.
HANDED = 1 << 17
#: Sizes of linked sets differ by a factor of 4 / 3 at most, so by one block at most.
BLOCK_LOG = math.log(DENOMINATOR / NUMERATOR) * 1.0001


def shingles(hashes: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of size words; of the whole sequence if it is shorter; none of no words."""
    n = min(len(hashes), size)
    if not n:
        return hashes[:0]
    grams = np.full(len(hashes) - n + 1, U(n))
    for k in range(n):
        grams = grams * U(FACTOR) + hashes[k : len(hashes) - n + 1 + k]
    grams = np.sort(mixed(grams))
    return grams[np.concatenate([[True], grams[1:] != grams[:-1]])]


def signature(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        a, b = grams.sum(dtype=U), mixed(grams ^ U(FACTOR)).sum(dtype=U)
    return int(a.view(np.int64)), int(b.view(np.int64))


def document_sets(batch: pa.RecordBatch, column: int = 1):
    data, offsets = utf8(batch.column(column))
    for row, hashes in word_hashes(data, offsets):
        yield row, shingles(hashes)


def _ids(batch: pa.RecordBatch) -> list:
    return batch.column(0).to_pylist()


SUMMARY = "doc bigint, n bigint, a bigint, b bigint"


def _summaries(batches):
    """A row for each document: doc, size and signature of its set. A row with n = -count for shingle a, for shingles
    that several sets of one task have; equal sets count once."""
    seen, waiting, held = set(), [], 0
    out = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def counted():
        grams, counts = np.unique(np.concatenate(waiting), return_counts=True)
        often = counts > 1
        none = pa.nulls(int(often.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(-counts[often]), pa.array(grams[often].view(np.int64)), none], schema=out)

    for batch in batches:
        ids, rows = _ids(batch), []
        for row, grams in document_sets(batch):
            name = signature(grams)
            rows.append((ids[row], len(grams), *name))
            if name not in seen:
                seen.add(name)
                waiting.append(grams)
                held += len(grams)
                if held > COUNTED:
                    yield counted()
                    waiting, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=out)
    if waiting:
        yield counted()


def _postings(shared):
    """Rows (shingle, doc, n, pos, prev) of each set's prefix: its n - ceil(3 n / 4) + 1 first shingles in the common
    order, rare before frequent, then by hash; prev is the one before. Linked sets share one in their prefixes. Equal
    sets of a task come once."""
    out = pa.schema([("shingle", pa.int64()), ("doc", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("prev", pa.int64())])

    def ordered_prefix(grams: np.ndarray, known: np.ndarray, counts: np.ndarray, coarse: np.ndarray) -> np.ndarray:
        n = len(grams)
        length = n - -(-NUMERATOR * n // DENOMINATOR) + 1
        frequent = np.flatnonzero(coarse[(grams & U((1 << 22) - 1)).astype(np.int64)])
        at = np.searchsorted(known, grams[frequent])
        at[at == len(known)] = 0
        hit = known[at] == grams[frequent] if len(known) else np.zeros(len(frequent), bool)
        frequent, count = frequent[hit], counts[at[hit]]
        rare = np.ones(n, bool)
        rare[frequent] = False
        rest = frequent[np.lexsort((grams[frequent], count))]
        return np.concatenate([grams[rare], grams[rest]])[:length]

    def rows(kept):
        lengths = [len(p) for _, _, p in kept]
        shingle = np.concatenate([p for _, _, p in kept]).view(np.int64)
        columns = [
            shingle,
            np.repeat(np.array([d for d, _, _ in kept], np.int64), lengths),
            np.repeat(np.array([n for _, n, _ in kept], np.int32), lengths),
            np.concatenate([np.arange(k, dtype=np.int32) for k in lengths]),
            np.concatenate([shingle[:1], shingle[:-1]]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=out)

    def run(batches):
        known, counts = shared.value
        # A coarse look-up spares the search for most shingles.
        coarse = np.zeros(1 << 22, bool)
        coarse[(known & U((1 << 22) - 1)).astype(np.int64)] = True
        seen, kept, held = set(), [], 0
        for batch in batches:
            ids = _ids(batch)
            for row, grams in document_sets(batch):
                if not len(grams) or ids[row] is None:
                    continue
                name = signature(grams)
                if name in seen:
                    continue
                seen.add(name)
                kept.append((ids[row], len(grams), ordered_prefix(grams, known, counts, coarse)))
                held += len(kept[-1][2])
                if held > HANDED:
                    yield rows(kept)
                    kept, held = [], 0
        if kept:
            yield rows(kept)

    return run


LISTS = "shingle bigint, block int, doc bigint, n int, pos int, prev bigint, c_doc bigint, c_n int, c_pos int"


def _lists(batches):
    """Lists of two or more sets that share a prefix shingle, from rows sorted by (shingle, n, doc).

    Each list is cut into blocks by set size; a row names the first set of its block, the centre. What is kept between
    batches is one row and one centre, however long a list is.
    """
    names = ["shingle", "doc", "n", "pos", "prev"]
    out = pa.schema([("shingle", pa.int64()), ("block", pa.int32()), ("doc", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("prev", pa.int64()), ("c_doc", pa.int64()), ("c_n", pa.int32()), ("c_pos", pa.int32())])
    held, followed, centre = None, False, None  # the last row, whether it goes on a list, its block's centre

    def emitted(rows: dict, last: bool):
        nonlocal held, followed, centre
        n = len(rows["shingle"])
        block = np.floor(np.log(np.maximum(rows["n"], 1)) / BLOCK_LOG).astype(np.int32)
        same = rows["shingle"][1:] == rows["shingle"][:-1]
        before, after = np.concatenate([[followed], same]), np.concatenate([same, [False]])
        fresh = np.concatenate([[True], ~(same & (block[1:] == block[:-1]))])
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        c = {k: rows[k][first] for k in names[1:]}
        if centre is not None and centre["shingle"] == rows["shingle"][0] and centre["block"] == block[0]:
            for k in names[1:]:
                c[k][first == 0] = centre[k]
        keep = before | after
        if not last:
            keep[-1] = False
            held, followed = {k: rows[k][-1:] for k in names}, bool(before[-1])
            centre = {"shingle": rows["shingle"][-1], "block": block[-1]} | {k: c[k][-1] for k in names[1:]}
        columns = [rows["shingle"], block, rows["doc"], rows["n"], rows["pos"], rows["prev"], c["doc"], c["n"], c["pos"]]
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in columns], schema=out)

    for batch in batches:
        if batch.num_rows:
            rows = {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names)}
            if held is not None:
                rows = {k: np.concatenate([held[k], rows[k]]) for k in names}
            yield emitted(rows, False)
    if held is not None:
        yield emitted(held, True)


def _possible(n1: str, pos1: str, n2: str, pos2: str) -> Column:
    """Whether two sets whose first shared shingle is at these places can be linked, by their sizes and places."""
    a, b = F.col(n1), F.col(n2)
    sizes = (F.least(a, b) * DENOMINATOR >= F.greatest(a, b) * NUMERATOR)
    rest = F.least(a - F.col(pos1), b - F.col(pos2))
    return sizes & (rest * (NUMERATOR + DENOMINATOR) >= (a + b) * NUMERATOR)


def sketch(grams: np.ndarray) -> np.ndarray:
    """A bitmap of at least two bits an element: bit h mod size for each hash h. Bitmaps of other sizes fold into it."""
    size = max(64, 1 << (2 * len(grams) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(grams & U(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def _at_most(x: np.ndarray, n_x: int, y: np.ndarray, n_y: int) -> int:
    """The most that two sets can share, by their sketches: what only one sketch has is not shared."""
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
    only_x, only_y = (int(np.bitwise_count(z).sum()) for z in (x & ~y, y & ~x))
    return min(n_x - only_x, n_y - only_y)


def _sets(docs: DataFrame, needed: DataFrame, whole: bool) -> DataFrame:
    """(doc, n, sketch or items) of the documents in needed, from their texts. No texts move: a filter of fixed size
    stands for needed; it may let some others pass, which meet no pair."""
    name = "items" if whole else "sketch"
    out = pa.schema([("doc", pa.int64()), ("n", pa.int32()), (name, pa.binary())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = _ids(part)
                rows = [(ids[row], len(g), (g if whole else sketch(g)).tobytes()) for row, g in document_sets(part) if len(g)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out)

    likely = perhaps_in(docs.where("doc is not null").select("doc", "text"), needed, "doc", "_needed").where("_needed")
    return likely.select("doc", "text").mapInArrow(run, f"doc bigint, n int, {name} binary")


def _promising(batches):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        keep = []
        for x, n_x, y, n_y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
            most = _at_most(np.frombuffer(x, np.uint8), n_x, np.frombuffer(y, np.uint8), n_y)
            keep.append(DENOMINATOR * most >= NUMERATOR * (n_x + n_y - most))
        yield pa.RecordBatch.from_arrays(batch.select([0, 1]).filter(pa.array(keep, pa.bool_())).columns, schema=out)


def _shared(batches):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int32()), ("n_a", pa.int32()), ("n_b", pa.int32())])
    for batch in batches:
        rows = []
        for at in range(0, batch.num_rows, 256):
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                place = np.searchsorted(large, small)
                place[place == len(large)] = 0
                rows.append((a, b, int((large[place] == small).sum()), len(x), len(y)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out)


def _with_ends(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("doc").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
    return pairs.select("a", "b", *[f"{c}_{end}" for end in ("a", "b") for c in columns])


def _verified(docs: DataFrame, pairs: DataFrame, sketches: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, shared, n_a, n_b) of the pairs whose sketches allow a link, from their whole sets."""
    allowed = _with_ends(pairs, sketches, "sketch", "n").mapInArrow(_promising, "a bigint, b bigint")
    allowed = scratch.table(allowed, "allowed")
    needed = allowed.select(F.col("a").alias("doc")).union(allowed.select("b")).distinct()
    sets = scratch.table(_sets(docs, needed, True), "sets")
    return _with_ends(allowed, sets, "items").mapInArrow(_shared, "a bigint, b bigint, shared int, n_a int, n_b int")


LINKED = f"{DENOMINATOR} * shared >= {NUMERATOR} * (n_a + n_b - shared)"


def _of_first(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """Pairs (a, b) of the first documents that have the same sets, each once."""
    for end in ("a", "b"):
        first = copies.select(F.col("doc").alias(end), F.col("first").alias("_first"))
        pairs = pairs.join(first, end, "left").withColumn(end, F.coalesce("_first", end)).drop("_first")
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _unsettled(lists: DataFrame, components: DataFrame) -> DataFrame:
    """Rows of the lists that more than one component meets in, with their component and that of their block's centre.

    A list whose sets are all in one component has nothing to add.
    """
    member = components.select(F.col("node").alias("doc"), "component")
    rows = lists.drop("component", "c_component").join(member, "doc", "left")
    rows = rows.withColumn("component", F.coalesce("component", "doc"))
    whole, block = Window.partitionBy("shingle"), Window.partitionBy("shingle", "block")
    rows = rows.withColumns({"low": F.min("component").over(whole), "high": F.max("component").over(whole)})
    rows = rows.where("low <> high").drop("low", "high")
    of_centre = F.max(F.when(F.col("doc") == F.col("c_doc"), F.col("component"))).over(block)
    return rows.withColumn("c_component", of_centre)


def _remaining(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) of one list that no component joins yet and that may still be linked.

    Blocks whose sizes rule each other out never meet. Two sets whose distances to their common centre are known skip
    each other if those differ by over 1/4, since the Jaccard distance obeys the triangle inequality. Two sets whose
    shingles before this one are the same meet in that one's list, so each pair is left to the lists where it begins.
    """
    distance = (1 - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("_far")
    ends = [F.col("a").alias("c_doc"), F.col("b").alias("doc")], [F.col("b").alias("c_doc"), F.col("a").alias("doc")]
    distances = known.select(*ends[0], distance).union(known.select(*ends[1], distance))
    rows = rows.join(distances, ["c_doc", "doc"], "left")
    rows = rows.withColumn("far", F.when(F.col("c_doc") == F.col("doc"), 0.0).otherwise(F.col("_far"))).drop("_far")
    names = ["doc", "n", "pos", "prev", "component", "c_doc", "far"]
    small = rows.select("shingle", "block", *[F.col(c).alias(f"{c}_1") for c in names])
    large = rows.select(
        "shingle", F.explode(F.array("block", F.col("block") - 1)).alias("block"), *[F.col(c).alias(f"{c}_2") for c in names]
    )
    apart = (F.col("c_doc_1") == F.col("c_doc_2")) & (F.abs(F.col("far_1") - F.col("far_2")) > 1 - NUMERATOR / DENOMINATOR + 1e-9)
    met_before = (F.col("prev_1") == F.col("prev_2")) & (F.col("pos_1") > 0) & (F.col("pos_2") > 0)
    met = small.join(large, ["shingle", "block"]).where(
        ((F.col("n_1") < F.col("n_2")) | ((F.col("n_1") == F.col("n_2")) & (F.col("doc_1") < F.col("doc_2"))))
        & (F.col("component_1") != F.col("component_2"))
        & _possible("n_1", "pos_1", "n_2", "pos_2")
        & ~met_before
        & ~F.coalesce(apart, F.lit(False))
    )
    return met.select(F.col("doc_1").alias("a"), F.col("doc_2").alias("b")).distinct()


def _known_counts(summaries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and their counts, sorted by shingle: KNOWN_COUNTS at most.

    The bound is kept by a least count, found from sums over steps of counts, so only what is kept comes to the driver.
    """
    counts = summaries.where("n < 0").groupBy("a").agg(F.sum(-F.col("n")).alias("count"))
    counts = counts.withColumn("step", F.floor(8 * F.log2("count")).cast("int"))
    steps = sorted(((r["step"], r["rows"]) for r in counts.groupBy("step").agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True)
    least, total = 1 << 30, 0
    for step, rows in steps:
        total += rows
        if total > KNOWN_COUNTS:
            break
        least = step
    kept = counts.where(F.col("step") >= least).select("a", F.least("count", F.lit(1 << 30)).cast("int").alias("count")).toArrow()
    shingle = kept["a"].to_numpy().view(U)
    order = np.argsort(shingle)
    return shingle[order], kept["count"].to_numpy()[order]


def _ordered_lists(spark: SparkSession, docs: DataFrame, summaries: DataFrame) -> DataFrame:
    known = spark.sparkContext.broadcast(_known_counts(summaries))
    prefix = docs.select("doc", "text").mapInArrow(_postings(known), "shingle bigint, doc bigint, n int, pos int, prev bigint")
    return prefix.repartition("shingle").sortWithinPartitions("shingle", "n", "doc").mapInArrow(_lists, LISTS)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    component_id is the smallest doc_id reachable over links, itself included. Sets are the distinct 5-word shingles of
    the whole text after lower-casing A-Z; a shorter text is one shingle; one without words has the empty set and no
    links. Shingles are held as 64-bit hashes. Every row gives a row; rows that share a doc_id are one node; rows
    without doc_id are not linked and have no component. Other columns are left out.

    Equal sets first become one class. Sets meet in lists of a shared prefix shingle. Round one compares each set with
    one centre of its lists, round two with the centres of lists that hold several components still; what is near a
    centre inherits its component. Round three compares the pairs that are in different components and that neither
    sizes, places, known distances nor an earlier list rules out.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    summaries = scratch.table(docs.mapInArrow(_summaries, SUMMARY), "summaries")
    nodes = summaries.where("n >= 0")
    lists = scratch.table(_ordered_lists(spark, docs, summaries), "lists")

    named = nodes.where("n > 0 and doc is not null")
    first = named.groupBy("a", "b", "n").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    copies = scratch.table(named.join(first, ["a", "b", "n"]).where("doc <> first").select("doc", "first").distinct(), "copies")
    needed = lists.select("doc").distinct().union(copies.select("first").distinct())
    sketches = scratch.table(_sets(docs, needed, False), "sketches")

    def star_pairs(stars):
        return _of_first(stars.select(F.col("c_doc").alias("a"), F.col("doc").alias("b")).distinct(), copies)

    def grown(components, near):
        """Components once the links of near are added."""
        joined = components.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        return scratch.table(connected_components(joined.union(near.where(LINKED).select("a", "b")), scratch), "components")

    # Each set meets one centre first. That joins most of a group of near copies, whose lists are then settled.
    stars = lists.where("c_doc <> doc").where(_possible("c_n", "c_pos", "n", "pos"))
    first_near = scratch.table(_verified(docs, star_pairs(stars.groupBy("doc").agg(F.min("c_doc").alias("c_doc"))), sketches, scratch), "near")
    links = first_near.where(LINKED).select("a", "b").union(copies.select("doc", "first"))
    components = scratch.table(connected_components(links, scratch), "components")

    # Then sets meet the other centres of lists that are not settled, and at last one another.
    rows = scratch.table(_unsettled(lists, components), "unsettled")
    stars = rows.where("c_doc <> doc and component <> c_component").where(_possible("c_n", "c_pos", "n", "pos"))
    near = scratch.table(_verified(docs, star_pairs(stars), sketches, scratch), "near")
    components = grown(components, near)

    rows = scratch.table(_unsettled(rows, components), "unsettled")
    rest = _of_first(_remaining(rows, first_near.union(near)), copies)
    components = grown(components, _verified(docs, rest, sketches, scratch))
    return nodes.join(components, F.col("doc") == F.col("node"), "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )
