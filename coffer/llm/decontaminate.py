"""Benchmark decontamination by winnowing: fingerprints meet first, then whole windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.llm.shared import let

#: Words of a window; a shared span of this length is always found.
WINDOW = 10
#: Words of a hashed gram. Every window of WINDOW words holds WINDOW - GRAM + 1 grams, of which the least hash is kept.
GRAM = 5
SLIDE = WINDOW - GRAM + 1
#: Fingerprints and windows of the benchmark are broadcast up to this many rows of some 50 bytes, else joined by a shuffle.
BROADCAST_ROWS = 1_000_000
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text after lower-casing A-Z; no words for NULL.

    lower() is right for ASCII texts and much faster than translate(), which leaves other letters alone.
    """
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    words = F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BREAKS), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _gram(hashes: Column, start: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(hashes, start + k) for k in range(size)])


def _grams(hashes: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: _gram(hashes, i, size))


def fingerprints(hashes: Column, short: tuple[int, ...] = ()) -> Column:
    """Array of (print, at, words): winnowed grams (words = 0) and all grams of the short lengths asked for.

    A gram is kept where it is least in some slide of SLIDE grams; equal least grams are all kept, so two texts that
    share WINDOW words keep the same grams at the same places of them.
    """

    def winnowed(grams: Column) -> Column:
        least = F.transform(
            F.sequence(F.lit(0), F.size(grams) - SLIDE), lambda j: F.array_min(F.slice(grams, j + 1, SLIDE))
        )

        def kept(minima: Column) -> Column:
            def near(i: Column) -> Column:
                first = F.greatest(F.lit(0), i - (SLIDE - 1))
                last = F.least(i, F.size(minima) - 1)
                return F.slice(minima, first + 1, last - first + 1)

            places = F.filter(
                F.sequence(F.lit(0), F.size(grams) - 1), lambda i: F.array_contains(near(i), F.get(grams, i))
            )
            return F.transform(places, lambda i: _print(F.get(grams, i), i, 0))

        return let(least, kept)

    none = F.expr("cast(array() as array<struct<print:bigint,at:int,words:int>>)")
    parts = [F.when(F.size(hashes) >= WINDOW, let(_grams(hashes, GRAM), winnowed)).otherwise(none)]

    def every(size: int) -> Column:
        return let(_grams(hashes, size), lambda grams: F.transform(grams, lambda x, i: _print(x, i, size)))

    parts += [F.when(F.size(hashes) >= size, every(size)).otherwise(none) for size in short]
    return F.concat(*parts)


def _print(value: Column, at: Column, words: int) -> Column:
    return F.struct(value.alias("print"), at.cast("int").alias("at"), F.lit(words).alias("words"))


def _windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, hashes, n): items that have an id and at least one word."""
    items = benchmark.where("item_id is not null").select("item_id", word_hashes(F.col("text")).alias("hashes"))
    return items.where(F.size("hashes") > 0).withColumn("n", F.least(F.size("hashes"), F.lit(WINDOW)))


def _bounded(table: DataFrame) -> DataFrame:
    """Broadcast after a check of the row count; beyond the bound the planner joins by a shuffle."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Spans of each document that occur in the benchmark.

    Columns: doc_id, n_words, spans (array of start and words, sorted), items (ids of the items with occurring
    windows). One row per different (doc_id, text): repeated rows are one document, while rows that share an id, or
    have none, stay apart if their texts differ. Items without id or words take no part. Other columns are left out.
    """
    items = _windows(benchmark)
    short = tuple(sorted(r["n"] for r in items.where(F.col("n") < WINDOW).select("n").distinct().collect()))
    of_item = items.select("item_id", "n", F.explode(fingerprints(F.col("hashes"), short)).alias("f"))
    prints = of_item.where("f.words = 0 or f.words = n").select(F.col("f.print").alias("known")).distinct()
    windows = items.select("item_id", F.explode(_whole(F.col("hashes"), F.col("n"), short)).alias("window"))
    windows = windows.groupBy("window").agg(F.collect_set("item_id").alias("items"))

    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("hashes"))
    # One more entry, which meets nothing and is always kept, carries the word count of documents without hits.
    alone = F.struct(F.xxhash64("doc_id", "text_hash").alias("print"), F.lit(-1).alias("at"), F.lit(-1).alias("words"))
    at, words = F.col("f.at"), F.col("f.words")
    first = F.greatest(F.lit(0), at - (SLIDE - 1))
    candidates = base.select(
        "doc_id", "text_hash", "hashes", F.explode(F.concat(F.array(alone), fingerprints(F.col("hashes"), short))).alias("f")
    ).select(
        "doc_id",
        "text_hash",
        F.col("f.print").alias("print"),
        at.alias("at"),
        words.alias("words"),
        F.size("hashes").alias("n_words"),
        F.when(words == 0, first).alias("first"),
        F.when(words == 0, F.slice("hashes", first + 1, 2 * WINDOW - GRAM)).alias("around"),
    )
    met = candidates.join(_bounded(prints), F.col("print") == F.col("known"), "left").where("words = -1 or known is not null")
    itself = F.array(F.struct(F.col("at").alias("start"), F.col("words").alias("words"), F.col("print").alias("hash")))
    whole = F.transform(
        F.sequence(F.lit(0), F.least(F.col("at") - F.col("first"), F.size("around") - WINDOW)),
        lambda j: F.struct((F.col("first") + j).cast("int").alias("start"), F.lit(WINDOW).alias("words"), _gram(F.col("around"), j, WINDOW).alias("hash")),
    )
    spans = met.select("doc_id", "text_hash", "n_words", F.explode(F.when(F.col("words") == 0, whole).otherwise(itself)).alias("s"))
    found = spans.join(_bounded(windows), F.col("s.hash") == F.col("window"), "left").where("s.start < 0 or window is not null")
    span = F.when(F.col("s.start") >= 0, F.struct("s.start", "s.words"))
    return (
        found.groupBy("doc_id", "text_hash")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.sort_array(F.collect_set(span)).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .drop("text_hash")
    )


def _whole(hashes: Column, n: Column, short: tuple[int, ...]) -> Column:
    """Hashes of an item's windows: all of WINDOW words, or the item itself if it has fewer."""
    choice = F.when(n == WINDOW, _grams(hashes, WINDOW))
    for size in short:
        choice = choice.when(n == size, F.array(_gram(hashes, F.lit(0), size)))
    return choice


def covered_words(spans: Column) -> Column:
    """How many words lie in at least one of the spans, which are sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("words"))

    def add(now: Column, s: Column) -> Column:
        end = s["start"] + s["words"]
        new = F.greatest(F.lit(0), end - F.greatest(s["start"], now["end"]))
        return F.struct(F.greatest(end, now["end"]).alias("end"), (now["words"] + new).alias("words"))

    return F.aggregate(spans, zero, add, lambda end: end["words"])
