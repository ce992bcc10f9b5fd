"""Removal of long byte strings that an earlier document has, by prefix ranks at growing offsets over sampled places."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coffer.llm.rolling import SLICE, VALUES, U, mixed, parts, powers, utf8
from coffer.llm.shared import Scratch, perhaps_in

#: Bytes of a string that is removed if an earlier document has it.
LENGTH = 50
#: Bytes of the first rank. Of the LENGTH - FIRST + 1 places inside a string the one with the least rank stands for it.
FIRST = 18
#: Bytes of the middle rank, half way to LENGTH.
MIDDLE = (FIRST + LENGTH) // 2
#: Sampled places, or strings, that a task ranks together before it hands them on.
RANKED = 2_000_000

PLACES = pa.schema([("first", pa.int64()), ("second", pa.int64()), ("doc", pa.int64()), ("place", pa.int64())])


class _Bytes:
    """Rolling hashes of a stretch of bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.concatenate([[U(0)], np.cumsum(VALUES[data] * up[:-1], dtype=U)])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def _stretches(data: np.ndarray, offsets: np.ndarray):
    """Stretches (bytes, rows' bounds, first row, byte offset in that row) of a column. A long text is cut into
    overlapping stretches, so that each string of LENGTH bytes starts in one of them and lies whole in it."""
    for first, last in parts(offsets):
        low, high = int(offsets[first]), int(offsets[last])
        if last > first + 1 or high - low <= SLICE:
            yield data[low:high], offsets[first : last + 1] - low, first, 0
            continue
        for at in range(low, high - LENGTH + 1, SLICE):
            some = data[at : min(high, at + SLICE + LENGTH - 1)]
            yield some, np.array([0, len(some)]), first, at - low


def _sampled(data: np.ndarray, bounds: np.ndarray):
    """Runs of starts that share the place standing for their strings: (row, place, first start, last start), with the
    hash of FIRST bytes at the place and of all bytes that the run's strings cover."""
    n = len(data) - LENGTH + 1
    if n < 1:
        return None
    rolled = _Bytes(data)
    at = np.arange(len(data) - FIRST + 1)
    grams = mixed(rolled.between(at, at + FIRST))
    # The place in the low bits: equal ranks go to the first, as in every copy of the string.
    low = U(21)
    least = (grams >> low << low) | at.astype(U)
    width = 1
    while width < LENGTH - FIRST + 1:
        step = min(width, LENGTH - FIRST + 1 - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & U((1 << 21) - 1)).astype(np.int64)
    row = np.searchsorted(bounds, np.arange(n), side="right") - 1
    valid = np.arange(n) + LENGTH <= bounds[row + 1]
    fresh = valid.copy()
    fresh[1:] &= (place[1:] != place[:-1]) | ~valid[:-1] | (row[1:] != row[:-1])
    start = np.flatnonzero(fresh)
    if not len(start):
        return None
    stop = valid.copy()
    stop[:-1] &= fresh[1:] | ~valid[1:]
    end = np.flatnonzero(stop)
    place = place[start]
    whole = mixed(rolled.between(start, end + LENGTH) + ((place - start) * 64 + (place - end)).astype(U))
    return row[start], place, start, end, grams[place], whole


def _earliest(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row the smallest doc among the rows of its key."""
    order = np.lexsort((doc, key))
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    out = np.empty(len(key), doc.dtype)
    out[order] = doc[order][fresh][np.cumsum(fresh) - 1]
    return out


def _joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of documents with overlapping and touching ones made one; lengths per document are below 2**40."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    fresh_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
    # Ends on a line on which a later document lies beyond all earlier ones, so one running maximum serves all.
    lift = (np.cumsum(fresh_doc) - 1) * (1 << 40)
    reach = np.maximum.accumulate(end + lift)
    fresh = fresh_doc.copy()
    fresh[1:] |= start[1:] + lift[1:] > reach[:-1]
    last = np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(doc) - 1]])
    return doc[fresh], start[fresh], (reach - lift)[last]


def _spans_batch(doc, start, end) -> pa.RecordBatch:
    """Known spans as rows without ranks: first is NULL, second the start and place the end."""
    doc, start, end = _joined(doc, start, end)
    return pa.RecordBatch.from_arrays([pa.nulls(len(doc), pa.int64()), pa.array(start), pa.array(doc), pa.array(end)], schema=PLACES)


def _handed_on(held: list):
    """What a task has ranked: of rows with one second rank the first document's; the others' strings are repeated."""
    first, second, doc, place = (np.concatenate(x) for x in zip(*held, strict=True))
    repeated = _earliest(second, doc) < doc
    kept = ~repeated
    yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (first, second, doc, place)], schema=PLACES)
    if repeated.any():
        at = place[repeated] >> 12
        yield _spans_batch(doc[repeated], at - (place[repeated] >> 6 & 63), at - (place[repeated] & 63) + LENGTH)


def _place_ranks(batches):
    """Rows (first, second, doc, place) of the sampled places of whole texts: the rank of FIRST bytes and that of all
    bytes of the run. place packs the byte offset and the run's extent before it. Of equal rows of one task only the
    first document's stay; the others' strings are known to be repeated and come as spans."""
    held, count = [], 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = utf8(batch.column(1))
        for some, bounds, first_row, base in _stretches(data, offsets):
            found = _sampled(some, bounds)
            if found is None:
                continue
            row, place, start, end, gram, whole = found
            packed = (place - bounds[row] + base) << 12 | (place - start) << 6 | (place - end)
            held.append((gram.view(np.int64), whole.view(np.int64), ids[first_row + row], packed))
            count += len(row)
            if count > RANKED:
                yield from _handed_on(held)
                held, count = [], 0
    if held:
        yield from _handed_on(held)


def _runs_of(text: np.ndarray, packed: list):
    """Stretches of one text with the runs that start in them: (rolling hashes, first byte, place, first, last start)."""
    packed = np.sort(np.array(packed, np.int64))
    place = packed >> 12
    low, high = place - (packed >> 6 & 63), place - (packed & 63)
    for at in range(0, max(1, len(text) - LENGTH + 1), SLICE):
        inside = (low >= at) & (low < at + SLICE) if len(text) > SLICE else slice(None)
        if len(low[inside]):
            yield _Bytes(text[at : at + SLICE + 2 * LENGTH]), at, place[inside], low[inside], high[inside]


def _opened(batches):
    """(doc, runs) of the texts and places that come from a join."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for row, (doc, packed) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            for runs in _runs_of(data[offsets[row] : offsets[row + 1]], packed):
                yield doc, *runs


def _side_ranks(batches):
    """Rows as in _place_ranks for MIDDLE bytes. A string that starts MIDDLE - FIRST or more before its place holds as
    many bytes before it; any other holds them after it. So each run falls into a left and a right part."""
    held, count = [], 0
    reach = MIDDLE - FIRST
    for doc, rolled, at, place, low, high in _opened(batches):
        for first, last, start, side in (
            (low, np.minimum(high, place - reach), place - reach, 1),
            (np.maximum(low, place - reach + 1), high, place, 2),
        ):
            some = first <= last
            if not some.any():
                continue
            f, e, s, p = first[some], last[some], start[some], place[some]
            rank = mixed(rolled.between(s - at, s - at + MIDDLE) + U(side))
            whole = mixed(rolled.between(f - at, e - at + LENGTH) + ((p - f) * 64 + (p - e)).astype(U))
            held.append((rank.view(np.int64), whole.view(np.int64), np.full(len(p), doc, np.int64), p << 12 | (p - f) << 6 | (p - e)))
            count += len(p)
        if count > RANKED:
            yield from _handed_on(held)
            held, count = [], 0
    if held:
        yield from _handed_on(held)


def _string_ranks(batches):
    """Rows as in _place_ranks of every string of LENGTH bytes that starts in the runs: each is a run by itself."""
    held, count = [], 0
    for doc, rolled, at, _, low, high in _opened(batches):
        lengths = high - low + 1
        starts = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        rank = mixed(rolled.between(starts - at, starts - at + LENGTH)).view(np.int64)
        held.append((rank, rank, np.full(len(starts), doc, np.int64), starts << 12))
        count += len(starts)
        if count > RANKED:
            yield from _handed_on(held)
            held, count = [], 0
    if held:
        yield from _handed_on(held)


def _round(ranked: DataFrame) -> DataFrame:
    """(doc, start, end, place) of one round: spans that are repeated, or with place the runs that stay open.

    Dropped are runs whose first rank no other document has, and runs that are the first of their bytes and of their
    first rank alone.
    """
    # Known spans ride along; they are spread, since they meet nothing.
    known = F.col("first").isNull()
    rows = ranked.select(
        F.coalesce("first", F.xxhash64("doc", "second")).alias("first"), "second", "doc", "place", known.alias("known")
    )
    by_first, by_run = Window.partitionBy("first"), Window.partitionBy("first", "second")
    rows = rows.repartition("first").withColumn("earliest", F.min("doc").over(by_run))
    rows = rows.withColumns({"low": F.min("doc").over(by_first), "high": F.max("doc").over(by_first)})
    at = F.shiftright("place", 12)
    decided = F.col("known") | (F.col("doc") > F.col("earliest"))
    start = F.when(F.col("known"), F.col("second")).otherwise(at - F.shiftright("place", 6).bitwiseAND(63))
    end = F.when(F.col("known"), F.col("place")).otherwise(at - F.col("place").bitwiseAND(63) + LENGTH)
    return rows.where(decided | (F.col("low") < F.col("high"))).select(
        "doc",
        F.when(decided, start).alias("start"),
        F.when(decided, end).alias("end"),
        F.when(~decided, F.col("place")).alias("place"),
    )


def _with_open(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, text, places) of the documents that have open runs; only texts that may have some move."""
    opened = found.where("place is not null").groupBy("doc").agg(F.collect_list("place").alias("places"))
    likely = perhaps_in(docs, found.where("place is not null").select("doc"), "doc", "_open").where("_open").select("doc", "text")
    return likely.join(opened, "doc").select("doc", "text", "places")


def repeated_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, start, end): byte spans of documents (doc, text) that a string of LENGTH bytes covers which also starts in
    a document with a smaller doc. Spans may overlap; rows without doc or with fewer bytes have none."""
    named = docs.where("doc is not null").select("doc", "text")
    ranks = "first bigint, second bigint, doc bigint, place bigint"
    one = scratch.table(_round(named.mapInArrow(_place_ranks, ranks)), "round-one")
    two = scratch.table(_round(_with_open(named, one).mapInArrow(_side_ranks, ranks)), "round-two")
    three = scratch.table(_round(_with_open(named, two).mapInArrow(_string_ranks, ranks)), "round-three")
    found = one.union(two).union(three).where("place is null")
    return found.select("doc", "start", "end")


def _cut(as_text: bool):
    """Texts without their spans: n_bytes, kept, starts and ends in place of the spans."""
    kind = pa.string() if as_text else pa.binary()
    out = pa.schema([("n_bytes", pa.int64()), ("kept", kind), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            rows = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True):
                text = (text or "").encode()
                start = end = np.zeros(0, np.int64)
                if found:
                    pairs = np.minimum(np.array([(s["start"], s["end"]) for s in found], np.int64), len(text))
                    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
                    if len(pairs):
                        _, start, end = _joined(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
                edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(text)]
                left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(text), left.decode(errors="ignore") if as_text else left, start.tolist(), end.tolist()))
            new = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), out.types, strict=True)] if rows else [pa.array([], t) for t in out.types]
            carried = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name not in ("text", "found")]
            names = [n for n in batch.schema.names if n not in ("text", "found")] + out.names
            yield pa.RecordBatch.from_arrays([*carried, *new], names)

    return run


def without_repeats(docs: DataFrame, carried: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """doc_id, the carried columns, n_bytes, kept, starts and ends of the maximal removed runs, for every row.

    kept is what remains: bytes, or as_text a string, in which bytes of a character that a run cut in two are left out.
    Texts are UTF-8 bytes and judged on the input; NULL is empty. Rows that share a doc_id have one set of spans, cut
    at each text's end. Rows without doc_id neither lose bytes nor cost others any. Other columns are left out.

    Rounds rank pairs of prefixes at growing offsets: FIRST, MIDDLE and LENGTH bytes. Each sorts rows by the rank of
    that many bytes and by the rank of all bytes of their run. A run whose first rank is unique drops out, one whose
    bytes an earlier document has is decided, and the others go on. Ranks are 64-bit hashes, which are the same in
    every task, so no ranks are sent back between rounds; and round one samples places, of which every string of LENGTH
    bytes has one, chosen by its bytes alone.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    extra = {f"_{i}": name for i, name in enumerate(carried)}
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), "text", *[F.col(name).alias(i) for i, name in extra.items()])
    spans = repeated_spans(docs.select("doc", "text"), scratch)
    grouped = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    # Only texts that may have spans move to meet them.
    marked = perhaps_in(docs, spans.select("doc"), "doc", "_touched")
    touched = marked.where("_touched").drop("_touched").join(grouped, "doc", "left")
    others = marked.where("not _touched").drop("_touched").withColumn("found", F.lit(None).cast(touched.schema["found"].dataType))
    whole = touched.select("doc", *extra, "text", "found").union(others.select("doc", *extra, "text", "found"))
    new = f"n_bytes bigint, kept {'string' if as_text else 'binary'}, starts array<bigint>, ends array<bigint>"
    schema = T.StructType([*whole.drop("text", "found").schema, *T.StructType.fromDDL(new)])
    return whole.mapInArrow(_cut(as_text), schema).withColumnsRenamed({"doc": "doc_id"} | extra)
