"""Account tree, three levels deep, and its flattening into report columns."""

from pyspark.sql import functions as F

from coffer.functions.json_text import scalar_at
from coffer.schemas import CLIENT

# Where the second level of the hierarchy comes from, by kind of transaction.
FULL = "full"  # parent's parent, or the parent's own type when it is a root
SHORT = "short"  # parent's parent only
MIXED = "mixed"  # FULL for the account types below, SHORT for the others

LAYOUTS = {
    "deposits": FULL,
    "payments": FULL,
    "sales_receipts": FULL,
    "purchases": SHORT,
    "bill_payments": SHORT,
    "journal_entries": MIXED,
}
MIXED_FULL_TYPES = ("Income", "Cost of Goods Sold")

ACCOUNT = "account"
ITEM = "item"

_ATTRIBUTES = ("account_name", "classification", "account_type", "level1", "level2_full", "level2_short")


def account_dim(accounts):
    """One row per account with the names its two upper levels contribute.

    Two left joins on the parent id.  Nothing is broadcast by hand: the planner
    broadcasts the account table while it is under the session's threshold and
    sorts and merges beyond it.
    """
    base = accounts.select(
        CLIENT,
        F.col("Id").alias("account_id"),
        F.col("Name").alias("account_name"),
        F.col("Classification").alias("classification"),
        F.col("AccountType").alias("account_type"),
        F.coalesce("SubAccount", F.lit(False)).alias("is_sub"),
        scalar_at("ParentRef", "$.value").alias("parent_id"),
    )
    parent = base.select(
        CLIENT,
        F.col("account_id").alias("parent_id"),
        F.col("account_name").alias("p_name"),
        F.col("account_type").alias("p_type"),
        F.col("is_sub").alias("p_is_sub"),
        F.col("parent_id").alias("grandparent_id"),
    )
    grandparent = base.select(
        CLIENT,
        F.col("account_id").alias("grandparent_id"),
        F.col("account_name").alias("g_name"),
    )
    return (
        base.join(parent, [CLIENT, "parent_id"], "left")
        .join(grandparent, [CLIENT, "grandparent_id"], "left")
        .select(
            CLIENT,
            "account_id",
            "account_name",
            "classification",
            "account_type",
            F.when(F.col("is_sub"), F.col("p_name"))
            .otherwise(F.col("account_type"))
            .alias("level1"),
            F.when(F.col("p_is_sub"), F.col("g_name")).otherwise(F.col("p_type")).alias("level2_full"),
            F.col("g_name").alias("level2_short"),
        )
    )


def resolve_items(items, dim):
    """Sales items with the attributes of their income account."""
    refs = items.select(
        CLIENT,
        F.col("Id").alias("item_id"),
        scalar_at("IncomeAccountRef", "$.value").alias("account_id"),
    )
    return refs.join(dim, [CLIENT, "account_id"])


def posting_targets(dim, items=None):
    """Everything a transaction line can point at, by kind of reference and id."""
    accounts = dim.select(
        CLIENT, F.lit(ACCOUNT).alias("ref_kind"), F.col("account_id").alias("ref_id"), *_ATTRIBUTES
    )
    if items is None:
        return accounts
    sold = resolve_items(items, dim).select(
        CLIENT, F.lit(ITEM).alias("ref_kind"), F.col("item_id").alias("ref_id"), *_ATTRIBUTES
    )
    return accounts.unionByName(sold)


def second_level(layout):
    """Second hierarchy level under a layout given as a column of layout names."""
    mixed_full = F.coalesce(F.col("account_type").isin(*MIXED_FULL_TYPES), F.lit(False))
    use_full = (layout == FULL) | ((layout == MIXED) & mixed_full)
    return F.when(use_full, F.col("level2_full")).otherwise(F.col("level2_short"))


def layout_of(source):
    """Layout name of a column of source names."""
    column = F.lit(None).cast("string")
    for name, layout in LAYOUTS.items():
        column = F.when(source == name, F.lit(layout)).otherwise(column)
    return column


def flatten_hierarchy(df, layout):
    """Replace the level columns by ``parent_account, sub_account, child_account``.

    ``layout`` is a layout name or a column of layout names.
    """
    layout = F.lit(layout) if isinstance(layout, str) else layout
    level2 = F.col("_level2")
    two_levels = level2.isNull()
    flat = {
        "parent_account": F.when(two_levels, F.col("level1")).otherwise(level2),
        "sub_account": F.when(two_levels, F.col("account_name")).otherwise(F.col("level1")),
        "child_account": F.when(two_levels, F.lit(None).cast("string")).otherwise(
            F.col("account_name")
        ),
    }
    return (
        df.withColumn("_level2", second_level(layout))
        .withColumns(flat)
        .drop("_level2", "account_name", "level1", "level2_full", "level2_short")
    )
