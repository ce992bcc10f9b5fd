"""Ranked lexical search: hashed max-sketches bound every document's score, exact rescoring follows the bounds down.

A document's term counts are hashed into coordinates that each keep the largest count. An impact grows with the count,
so the largest count of a coordinate gives the largest impact: looking a query's terms up in a sketch bounds its score
from above. The documents of highest bound are scored from their texts; the k-th best of these scores is a threshold,
and only documents whose bound reaches it can still be among the k best.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coffer.llm.rolling import SLICE
from coffer.llm.shared import Scratch, perhaps_in

#: Coordinates per distinct term, and the fewest of a sketch; sizes are powers of two.
LOAD = 4
LEAST = 64
#: Counts from here on are held as this one, which bounds their impact by that of any count.
MANY = 255
#: A term's slot in the filter of wanted terms is the upper bits of its hash.
SLOT_BITS = 20
#: Query terms looked up together, and bounds computed at a time.
TERMS = 1 << 14
CELLS = 1 << 21
#: Documents per item and task that are scored to find the threshold, as a multiple of k.
SEEDS = 2

_KEPT = set(range(0x30, 0x3A)) | set(range(0x41, 0x5B)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes((b + 32 if 0x41 <= b < 0x5B else b) if b in _KEPT else 0x20 for b in range(256))


def counted(text: str | None) -> Counter:
    """Occurrences of each term: letters, digits and whatever is not ASCII, with A-Z lower-cased; of the whole text."""
    data = (text or "").encode().translate(_FOLD)
    out, at = Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        out.update(data[at:end].split())
        at = end
    return out


def sketch(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The largest count, MANY at most, of the terms that share a coordinate."""
    size = max(LEAST, 1 << (LOAD * len(hashes) - 1).bit_length())
    out = np.zeros(size, np.uint8)
    order = np.argsort(counts, kind="stable")
    out[hashes[order] & np.uint32(size - 1)] = np.minimum(counts[order], MANY)
    return out


def weight(documents: Column, found: Column) -> Column:
    """floor(1000 * ln((2 N + 2) / (2 df + 1)))."""
    return F.floor(1000 * F.log((2.0 * documents + 2) / (2 * found + 1))).cast("long")


def length_factor(n: int, documents: int, terms: int) -> int:
    return 10 + 90 * n * documents // terms


def impact(counts, factor):
    return (1_000_000_000 * counts) // (1000 * counts + 8 * factor)


def _indexed(docs: DataFrame, slots) -> DataFrame:
    """key, n and sketch of every document that has a term; further rows have terms of wanted slots and in how many of
    a batch's documents each stands."""

    def run(batches):
        wanted = np.unpackbits(np.frombuffer(slots.value, np.uint8)).astype(bool)
        for batch in batches:
            keys, sizes, sketches, found = [], [], [], Counter()
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = counted(text)
                if not terms:
                    continue
                hashes = np.fromiter(map(crc32, terms), np.uint32, len(terms))
                counts = np.fromiter(terms.values(), np.int64, len(terms))
                names = list(terms)
                found.update(names[i] for i in np.flatnonzero(wanted[hashes >> np.uint32(32 - SLOT_BITS)]).tolist())
                keys.append(key)
                sizes.append(int(counts.sum()))
                sketches.append(sketch(hashes, counts).tobytes())
            keys, sizes, sketches = [*keys, None], [*sizes, None], [*sketches, None]
            none = [None] * (len(keys) - 1)
            columns = [
                pa.array(keys, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(sketches, pa.binary()),
                pa.array([*none, [t.decode() for t in found]], pa.list_(pa.string())),
                pa.array([*none, list(found.values())], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n", "sketch", "terms", "found"])

    kinds = "key bigint, n bigint, sketch binary, terms array<string>, found array<bigint>"
    return docs.select("key", "text").mapInArrow(run, kinds)


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), once each; rows that share an item_id are one item."""

    def run(batches):
        for batch in batches:
            terms = [[t.decode() for t in counted(text)] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<string>")
    return found.select("item_id", F.explode("terms").alias("term")).distinct()


class _Block:
    """Queries that are looked up together: the hashes, weights and terms of all, and where each one begins."""

    def __init__(self, rows: list, documents: int, terms: int):
        self.query = [r["q"] for r in rows]
        self.term = [r["term"].encode() for r in rows]
        self.weight = np.array([r["w"] for r in rows], np.int64)
        self.hash = np.array([crc32(t) for t in self.term], np.uint32)
        self.first = np.flatnonzero(np.diff(self.query, prepend=-1))
        self.documents, self.terms = documents, terms

    def bounds(self, batch: pa.RecordBatch):
        """Yields (rows of the batch, their bounds for every query)."""
        n, column = batch.column(1).to_pylist(), batch.column(2)
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2], np.uint8)
        factors = np.array([length_factor(x, self.documents, self.terms) for x in n], np.int64)
        sizes = np.diff(offsets)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            places, of_term = np.unique(self.hash & np.uint32(size - 1), return_inverse=True)
            step = max(1, CELLS // len(self.hash))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                counts = data[offsets[some][:, None] + places[None, :]].astype(np.int64)
                impacts = impact(counts, factors[some][:, None])
                impacts[counts == MANY] = 1_000_000
                yield some, np.add.reduceat(impacts[:, of_term] * self.weight, self.first, axis=1)

    def scores(self, text: str, queries: list[int]):
        """Yields (query, exact score) of the named queries."""
        counts = counted(text)
        factor = length_factor(counts.total(), self.documents, self.terms)
        ends = np.append(self.first[1:], len(self.term))
        for q in queries:
            score = 0
            for i in range(int(self.first[q]), int(ends[q])):
                count = counts.get(self.term[i])
                if count:
                    score += int(self.weight[i]) * impact(count, factor)
            yield q, score


def _highest(sketches: DataFrame, block, most: int) -> DataFrame:
    """(q, key, bound): of every task, the documents with the highest bounds of each query."""

    def run(batches):
        b = block.value
        keys = np.zeros((0, len(b.first)), np.int64)
        best = np.zeros((0, len(b.first)), np.int64)
        for batch in batches:
            of = batch.column(0).to_numpy()
            for rows, bounds in b.bounds(batch):
                best = np.concatenate([best, bounds])
                keys = np.concatenate([keys, np.broadcast_to(of[rows][:, None], bounds.shape)])
                if len(best) > most:
                    top = np.argpartition(best, len(best) - most, axis=0)[-most:]
                    best, keys = np.take_along_axis(best, top, 0), np.take_along_axis(keys, top, 0)
        q = np.broadcast_to(np.arange(best.shape[1], dtype=np.int32), best.shape)
        kept = best > 0
        yield pa.RecordBatch.from_arrays([pa.array(q[kept]), pa.array(keys[kept]), pa.array(best[kept])], ["q", "key", "bound"])

    return sketches.mapInArrow(run, "q int, key bigint, bound bigint")


def _reaching(sketches: DataFrame, block, least: np.ndarray) -> DataFrame:
    """(q, key) of all documents whose bound reaches the query's threshold."""

    def run(batches):
        b = block.value
        for batch in batches:
            of = batch.column(0).to_numpy()
            for rows, bounds in b.bounds(batch):
                row, q = np.nonzero(bounds >= least)
                yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(of[rows[row]])], ["q", "key"])

    return sketches.mapInArrow(run, "q int, key bigint")


def _scored(docs: DataFrame, pairs: DataFrame, block, scratch: Scratch) -> DataFrame:
    """(q, doc_id, score) of the documents named by pairs (q, key), scored from their texts; only their texts move."""
    wanted = scratch.table(pairs.groupBy("key").agg(F.collect_set("q").alias("queries")), "wanted")
    marked = perhaps_in(docs, wanted, "key", "_wanted").where("_wanted")
    named = marked.join(wanted, "key").select("doc_id", "text", "queries")

    def run(batches):
        b = block.value
        for batch in batches:
            rows = zip(range(len(batch)), batch.column(1).to_pylist(), batch.column(2).to_pylist())
            found = [(i, q, s) for i, text, queries in rows for q, s in b.scores(text, queries) if s > 0]
            i, q, s = (np.array([f[k] for f in found], np.int64) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int32)), batch.column(0).take(pa.array(i)), pa.array(s)], ["q", "doc_id", "score"]
            )

    return named.mapInArrow(run, f"q int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint")


def _best(scores: DataFrame, k: int, *ties: Column) -> DataFrame:
    ranked = Window.partitionBy("q").orderBy(F.col("score").desc(), *ties)
    return scores.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _thresholds(scores: DataFrame, k: int, n: int) -> np.ndarray:
    """For each query the k-th best of these scores, or one where there are fewer."""
    least = np.ones(n, np.int64)
    for r in _best(scores, k).where(F.col("rank") == k).select("q", "score").collect():
        least[r["q"]] = r["score"]
    return least


def _answers(docs: DataFrame, sketches: DataFrame, block, k: int, scratch: Scratch) -> DataFrame:
    n = len(block.value.first)
    highest = _highest(sketches, block, SEEDS * k).withColumnRenamed("bound", "score")
    first = _best(highest, SEEDS * k).select("q", "key").distinct()
    least = _thresholds(_scored(docs, first, block, scratch), k, n)
    rest = _reaching(sketches, block, least).distinct()
    return _best(_scored(docs, rest, block, scratch), k, F.col("doc_id").asc_nulls_last())


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of every item's k best documents, best first, ties by ascending doc_id.

    Terms are stretches of letters, digits and characters beyond ASCII, A-Z lower-cased, of whole texts. A term's
    weight is floor(1000 ln((2N+2)/(2df+1))), its impact (10^9 tf) div (1000 tf + 8m) with m = 10 + 90 n N div L: N is
    the number of documents with a term, L of all their terms, n of the document's, df of documents with the term, tf of
    its occurrences. A score adds weight times impact over the item's different terms; only scores above zero count.

    NULL and texts without terms are no documents and match nothing; an item without terms, or that meets none, gives
    no row. Repeated documents are documents of their own, each with a rank; a NULL doc_id comes last among ties. Rows
    that share an item_id (NULL too) are one item with the terms of all. Other columns are left out, whatever their
    names; ids may be of any type that has an order.

    Items are looked up in blocks of about TERMS query terms; only a block and a filter of 2**SLOT_BITS bits are
    broadcast. Every document is bounded by its sketch, and every one whose bound reaches the threshold is rescored.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "lexical")
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    asked = scratch.table(_item_terms(items), "asked")
    slot = F.shiftrightunsigned(F.crc32(F.col("term").cast("binary")), 32 - SLOT_BITS).cast("int")
    slots = np.zeros(1 << SLOT_BITS, bool)
    slots[asked.select(slot.alias("slot")).distinct().toArrow()["slot"].to_numpy()] = True
    index = scratch.table(_indexed(docs, spark.sparkContext.broadcast(np.packbits(slots).tobytes())), "sketches")
    sketches = index.where("key is not null").select("key", "n", "sketch")
    documents, terms = index.where("key is not null").agg(F.count("key"), F.sum("n")).first()

    found = index.where("key is null").select(F.explode(F.arrays_zip("terms", "found")).alias("x"))
    found = found.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.found").alias("df"))
    weighted = asked.join(found, "term").select("item_id", "term", weight(F.lit(documents), F.col("df")).alias("w"))
    weighted = scratch.table(weighted.where("w > 0"), "weighted")
    blocks = -(-weighted.count() // TERMS)
    if not blocks:
        kinds = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}"
        return spark.createDataFrame([], f"{kinds}, score bigint")
    of_item = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    numbered = weighted.select("item_id", of_item.alias("block")).distinct()
    order = Window.partitionBy("block").orderBy("item_id")
    numbered = scratch.table(numbered.withColumn("q", F.row_number().over(order) - 1), "items")
    same = weighted["item_id"].eqNullSafe(numbered["item_id"])
    queries = scratch.table(weighted.join(numbered, same).select("block", "q", "term", "w"), "queries")
    out = []
    for block in range(blocks):
        rows = queries.where(F.col("block") == block).orderBy("q", "term").collect()
        if rows:
            shared = spark.sparkContext.broadcast(_Block(rows, documents, terms))
            named = numbered.where(F.col("block") == block).select("q", "item_id")
            out.append(_answers(docs, sketches, shared, k, scratch).join(named, "q").select("item_id", "rank", "doc_id", "score"))
    result = out[0]
    for more in out[1:]:
        result = result.union(more)
    return result
