"""Actual and budget side by side, with row ids that survive refreshes."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from coffer.functions.keys import entry_id, moved_id, random_entry_id, restored_id
from coffer.schemas import CLIENT, GRAIN

BLEND_COLUMNS = (
    "entry_id",
    CLIENT,
    "txnDate",
    "parent_account",
    "sub_account",
    "child_account",
    "classification",
    "account_type",
    "actual",
    "budget_amount",
    "last_refreshed",
)

# The key of the literal refresh: four columns, only the last one null-safe.
LITERAL_KEY = (CLIENT, "txnDate", "parent_account", "sub_account")
LITERAL_NULL_SAFE = ("child_account",)


def stack_facts(pnl, budget):
    """Actual and budget rows in one shape, the other amount being zero."""
    actual = pnl.select(
        *GRAIN, F.col("amount").alias("actual"), F.lit(0).cast("int").alias("budget_amount")
    )
    planned = budget.withColumnRenamed("budget_date", "txnDate").select(
        *GRAIN, F.lit(0).cast("int").alias("actual"), "budget_amount"
    )
    return actual.unionByName(planned)


def combine(pnl, budget):
    """Actual and budget amounts added up to one grain.

    Both inputs may hold several rows per grain: this is the only aggregation they
    need.
    """
    return stack_facts(pnl, budget).groupBy(*GRAIN).agg(
        F.sum("actual").alias("actual"), F.sum("budget_amount").alias("budget_amount")
    )


def blend(pnl, budget, random_ids=False):
    """First run: combined facts with new ids.

    Random ids hold only once the result is written; read it back before using them.
    """
    return (
        combine(pnl, budget)
        .withColumn("entry_id", random_entry_id() if random_ids else entry_id())
        .withColumn("last_refreshed", F.current_timestamp())
        .select(*BLEND_COLUMNS)
    )


def blend_refresh(previous, pnl, budget, comments, mode="intended", random_ids=False):
    """Next version of the blend from its previous one.

    ``intended``: facts keep the id their grain had; rows that vanished stay as
    zeros while a comment points at them.  ``literal`` follows the text of the
    original query, which multiplies rows (see :func:`_refresh_literal`).
    Random ids go to new rows only, and hold only once the result is written.
    """
    if mode == "intended":
        refreshed = _refresh_intended(previous, stack_facts(pnl, budget), comments)
    elif mode == "literal":
        refreshed = _refresh_literal(previous, stack_facts(pnl, budget), comments)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    new_id = random_entry_id() if random_ids else entry_id()
    return refreshed.withColumn("entry_id", F.coalesce("entry_id", new_id)).select(*BLEND_COLUMNS)


def _without_ids(previous, *key):
    """Previous rows with a key to move by, their ids taken apart."""
    own, other = moved_id("entry_id")
    return previous.select(own.alias("is_own"), other.alias("other_id"), "last_refreshed", *key)


def _refresh_intended(previous, stacked, comments):
    """One full outer join tells carried, new and vanished rows apart.

    The whole grain is one struct column, which is both what the facts are added up
    by and what they are joined on: fields that are NULL on both sides are equal in
    it, and a single exchange of the facts, after their map-side sums, serves both.
    Previous rows move once as well, by the grain and without the ids it tells.

    The first of a grain's previous rows carries the amounts; there is one, unless a
    version from elsewhere repeats a grain.  Rows under comments stay as zeros.  These
    alone are looked up, by rows that carry nothing; the others are dealt out by their
    grain there, where the planner does not broadcast the commented entries.
    """
    grain = F.struct(*GRAIN).alias("grain")
    new = stacked.groupBy(grain).agg(
        F.sum("actual").alias("actual"), F.sum("budget_amount").alias("budget_amount"), F.lit(True).alias("is_new")
    )
    by_id = Window.partitionBy("grain").orderBy("entry_id")
    repeats = F.lag("entry_id").over(by_id).eqNullSafe(F.col("entry_id"))
    fields = [f"grain.{name}" for name in GRAIN]
    old = (
        _without_ids(previous, grain)
        .repartition("grain")
        .select(restored_id(F.col("is_own"), F.col("other_id"), *fields).alias("entry_id"), "last_refreshed", "grain")
        .withColumns({"nth": F.row_number().over(by_id), "repeats": repeats})
        .filter("nth = 1 or not repeats")
        .select("entry_id", "last_refreshed", "nth", F.col("grain").alias("old_grain"))
    )
    is_new = F.col("is_new").isNotNull()
    carries = is_new & F.coalesce(F.col("nth") == 1, F.lit(True))
    place = F.coalesce("grain", "old_grain")
    met = new.join(old, F.col("grain") == F.col("old_grain"), "full_outer").select(
        "entry_id", "last_refreshed", "actual", "budget_amount", carries.alias("carries"), place.alias("place")
    )
    # A row that carries amounts has no client to look up, so this key meets no comment.
    looks = ~F.col("carries") & F.col("entry_id").isNotNull()
    met = met.withColumns({
        "looked_client": F.when(looks, F.col("place")[CLIENT]),
        "looked_id": F.when(looks, F.col("entry_id")).otherwise(F.xxhash64("place").cast("string")),
    })
    commented = comments.select(F.col(CLIENT).alias("looked_client"), F.col("entry_id").alias("looked_id")).distinct()
    commented = commented.withColumn("commented", F.lit(True))
    rows = met.join(commented, ["looked_client", "looked_id"], "left").filter("carries or commented")
    return rows.select(
        "entry_id",
        *[F.col("place")[name].alias(name) for name in GRAIN],
        F.when(F.col("carries"), F.col("actual")).otherwise(F.lit(0)).alias("actual"),
        F.when(F.col("carries"), F.col("budget_amount")).otherwise(F.lit(0)).alias("budget_amount"),
        F.when(F.col("carries"), F.current_timestamp()).otherwise(F.col("last_refreshed")).alias("last_refreshed"),
    )


def _refresh_literal(previous, stacked, comments):
    """The refresh as its original text has it.

    It matches on five columns, only the last one null-safe, and emits every commented
    row again as zero once per comment, so rows can multiply from run to run.

    Facts and previous rows meet once, in a full outer join: a match or a fact alone
    gives a row with amounts, a match or a previous row alone a zero row per comment.
    What they match on is one struct column.  The facts are dealt out by it before they
    are added up, which serves the join as well; previous rows move without the ids
    that their grain tells.
    Comments are counted per entry, so a row comes out of their join as it went in.
    A fact alone has no entry to look up: it is dealt out by its grain there, as all
    such rows would be one key otherwise.
    """
    place = F.struct(*LITERAL_KEY, *LITERAL_NULL_SAFE).alias("place")
    rest = [name for name in GRAIN if name not in LITERAL_KEY + LITERAL_NULL_SAFE]
    facts = (
        stacked.select(place, *rest, "actual", "budget_amount")
        .repartition("place")
        .groupBy("place", *rest)
        .agg(F.sum("actual").alias("actual"), F.sum("budget_amount").alias("budget_amount"))
    )
    old = _without_ids(previous, place, *rest).alias("old")
    new = facts.withColumn("is_new", F.lit(True)).alias("new")
    # NULL fields are equal in a struct, which holds for the null-safe ones alone.
    match = F.col("old.place") == F.col("new.place")
    for name in LITERAL_KEY:
        match = match & F.col(f"new.place.{name}").isNotNull()

    def fields(side):
        return [f"{side}.{name}" if name in rest else f"{side}.place.{name}" for name in GRAIN]

    old_id = restored_id(F.col("old.is_own"), F.col("old.other_id"), *fields("old"))
    met = new.join(old, match, "full_outer").select(
        old_id.alias("entry_id"),
        *[F.struct(*[F.col(x).alias(n) for x, n in zip(fields(s), GRAIN)]).alias(f"{s}_grain") for s in ("new", "old")],
        F.when(old_id.isNotNull(), F.col("old.place.client")).alias(CLIENT),
        "new.actual",
        "new.budget_amount",
        F.col("new.is_new").isNotNull().alias("is_new"),
        "old.last_refreshed",
    )
    # Without an entry there is no client either, so this key meets no comment.
    key = F.coalesce(F.col("entry_id"), F.xxhash64("new_grain", "old_grain").cast("string"))
    counted = comments.groupBy(CLIENT, F.col("entry_id").alias("entry_key")).agg(
        F.count("*").cast("int").alias("n_comments")
    )
    rows = met.withColumn("entry_key", key).join(counted, [CLIENT, "entry_key"], "left")

    def row(grain, actual, budget_amount, refreshed):
        return F.struct(
            "entry_id",
            *[F.col(grain)[name].alias(name) for name in GRAIN],
            actual.alias("actual"),
            budget_amount.alias("budget_amount"),
            refreshed.alias("last_refreshed"),
        )

    zeros = [F.lit(0).cast(facts.schema[name].dataType) for name in ("actual", "budget_amount")]
    fact = row("new_grain", F.col("actual"), F.col("budget_amount"), F.current_timestamp())
    repeated = row("old_grain", *zeros, F.col("last_refreshed"))
    # Numbers of the rows to give: 0 is the one with amounts, the others are one per comment.
    first = F.when(F.col("is_new"), F.lit(0)).otherwise(F.lit(1))
    last = F.coalesce("n_comments", F.lit(0))
    rows = rows.withColumn("nth", F.explode(F.when(first <= last, F.sequence(first, last))))
    return rows.select(F.when(F.col("nth") == 0, fact).otherwise(repeated).alias("row")).select("row.*")
