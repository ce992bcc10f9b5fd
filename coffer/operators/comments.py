"""Comments on facts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from coffer.functions.keys import entry_id, moved_id
from coffer.schemas import ACCOUNT_COLUMNS, CLIENT, COMMENTS, GRAIN
from coffer.sinks.snapshots import (
    append_snapshot,
    compact_snapshot,
    latest_version,
    read_snapshot,
    stored_parts,
    write_snapshot,
)

# The key of the literal comment join: no part null-safe, classification left out.
LITERAL_KEY = (CLIENT, "txnDate", "parent_account", "sub_account", "child_account", "account_type")

_LATEST = ("comment_text", "comment_by", "comment_date")

# Bits of the filter of commented entries; fixed, so what is broadcast never grows with the comments.
FILTER_BITS = 1 << 24


def empty_comments(spark):
    return spark.createDataFrame([], COMMENTS)


def ensure_comments(spark, path):
    """Comments table at ``path``, created empty if absent and never wiped."""
    if latest_version(spark, path) is None:
        write_snapshot(empty_comments(spark), path)
    return read_snapshot(spark, path)


def add_comments(comments, path, compact_after=64):
    """Append comments to the table at ``path``: a new version that writes just them.

    Stored comments stay in their files.  After ``compact_after`` appends the table is
    rewritten as even files, so readers never list more than that many small ones.
    """
    spark = comments.sparkSession
    current = ensure_comments(spark, path)
    version = append_snapshot(comments.select(*current.columns), path)
    if len(stored_parts(spark, path)) > compact_after:
        version = compact_snapshot(spark, path)
    return version


def _without_ids(entries):
    """Entries as they move, their ids taken apart."""
    own, other = moved_id("entry_id")
    return entries.withColumns({"is_own": own, "other_id": other}).drop("entry_id")


def _grouped(moved, *more):
    """Entries without ids added up per grain, with their sorted ids and what else is aggregated."""
    sums = moved.groupBy(*GRAIN).agg(
        F.sum("actual").alias("actual"),
        F.sum("budget_amount").alias("budget_amount"),
        F.count_if("is_own").cast("int").alias("n_own"),
        F.collect_list("other_id").alias("other_ids"),
        *more,
    )
    ids = F.sort_array(F.concat(F.array_repeat(entry_id(), F.col("n_own")), "other_ids"))
    return sums.withColumn("entry_ids", ids).drop("n_own", "other_ids")


def group_entries(blend):
    """Facts per grain with the sorted ids of the entries behind them.

    Ids that are the hash of their grain are counted while rows move and made again
    after it; others move as they are.
    """
    grouped = _grouped(_without_ids(blend.select("entry_id", *GRAIN, "actual", "budget_amount")))
    return grouped.select(*GRAIN, "actual", "budget_amount", "entry_ids")


def latest_per_entry(comments):
    """Newest text, author and date of each entry, each chosen on its own.

    A NULL field falls back to the next older comment that has it.  Comments
    without a time are oldest; ties go to the highest comment id.  The result
    keeps the order with each value, so that groups of entries can be compared.
    """
    order = [F.col("created_at").alias("at"), F.col("comment_id").alias("id")]

    def newest(value):
        candidate = F.struct(*order, F.col(value).alias("value"))
        return F.max(F.when(F.col(value).isNotNull(), candidate))

    return comments.groupBy(CLIENT, "entry_id").agg(
        newest("comment_text").alias("comment_text"),
        newest("created_by").alias("comment_by"),
        newest("created_at").alias("comment_date"),
    )


def _perhaps_commented(entries, comments):
    """Entries without those that surely have no comment; no row moves.

    A bitmap of hashed ids, of fixed size whatever their number.  It only spares moving
    rows that cannot match, so users follow it with an exact join.
    """
    bit = F.pmod(F.xxhash64(CLIENT, "entry_id"), F.lit(FILTER_BITS))
    # Words of 64 bits: (word, bits).
    words = (
        comments.select(bit.alias("bit"))
        .groupBy((F.col("bit") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    )
    marked = entries.withColumn("bit", bit).join(F.broadcast(words), (F.col("bit") / 64).cast("int") == F.col("word"))
    mask = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    return marked.filter(F.col("bits").bitwiseAND(mask) != 0).select(*entries.columns)


def _commented(entries, comments):
    """Entries that have comments, with the newest of each; the others do not move."""
    return _perhaps_commented(entries, comments).join(latest_per_entry(comments), [CLIENT, "entry_id"])


def latest_comment(blend, comments):
    """Newest comment fields per grain; NULL where no entry has a comment.

    Comments meet the entries they are on, and these alone are compared.  All grains
    then meet the commented ones by the grain as one struct column, in which NULLs
    are equal and which the grains are dealt out by already.
    """
    grain = F.struct(*GRAIN)
    commented = _commented(blend.select(CLIENT, "entry_id", grain.alias("commented")), comments)
    newest = commented.groupBy("commented").agg(*[F.max(c)["value"].alias(c) for c in _LATEST])
    places = blend.select(grain.alias("grain")).distinct()
    met = places.join(newest, F.col("grain") == F.col("commented"), "left")
    return met.select(*[F.col("grain")[name].alias(name) for name in GRAIN], *_LATEST)


def with_comments(blend, comments, mode="intended"):
    """Facts with their newest comment and the ids behind them as JSON text.

    Comments reduce to one row per entry before they meet the facts.  ``intended``
    then takes amounts, ids and comment in a single aggregation; ``literal`` joins
    grouped facts to comments on five account keys that do not match NULLs.
    """
    if mode == "literal":
        return _with_comments_literal(blend, comments)
    if mode != "intended":
        raise ValueError(f"unknown mode {mode!r}")
    entries = blend.select("entry_id", *GRAIN, "actual", "budget_amount")
    joined = entries.join(latest_per_entry(comments), [CLIENT, "entry_id"], "left")
    return joined.groupBy(*GRAIN).agg(
        F.sum("actual").alias("actual"),
        F.sum("budget_amount").alias("budget_amount"),
        *[F.max(c)["value"].alias(c) for c in _LATEST],
        F.to_json(F.sort_array(F.collect_list("entry_id"))).alias("entry_ids_json"),
    )


def _with_comments_literal(blend, comments):
    """Grouped facts, each with the comments of every grain that its literal key matches.

    Commented entries come beside the entries, as rows without an id and amounts, so one
    aggregation gives amounts, ids and newest comment.  Rows are dealt out by the literal
    key once: it is part of the grain, so they are added up and matched where they are.
    """
    entries = _without_ids(blend.select("entry_id", *GRAIN, "actual", "budget_amount"))
    commented = _commented(blend.select("entry_id", *GRAIN), comments).drop("entry_id")
    rows =entries.unionByName(commented, allowMissingColumns=True).repartition(*LITERAL_KEY)
    facts = _grouped(rows, *[F.max(c)["value"].alias(c) for c in _LATEST])
    matched = F.collect_list(F.struct(*_LATEST)).over(Window.partitionBy(*LITERAL_KEY))
    # A key with a NULL matches nothing, not even itself.
    has_key = F.lit(True)
    for name in LITERAL_KEY:
        has_key = has_key & F.col(name).isNotNull()
    facts = facts.withColumn("matched", F.when(has_key, matched))
    return facts.withColumn("matched", F.explode_outer("matched")).select(
        *GRAIN,
        "actual",
        "budget_amount",
        *[F.col("matched")[name].alias(name) for name in _LATEST],
        F.to_json("entry_ids").alias("entry_ids_json"),
    )


def reading_order(facts):
    """Sorted for a reader; never sort inside a pipeline."""
    return facts.orderBy(CLIENT, "txnDate", *ACCOUNT_COLUMNS)
