"""Budget sheets: cleaned cells, long form, account attributes."""

from pyspark.sql import functions as F

from coffer.functions.json_text import scalar_at
from coffer.functions.text import budget_cell, month_labels, month_start, path_head, path_tail
from coffer.schemas import CLIENT, FIRST_MONTH_FIELD

BUDGET_COLUMNS = (
    CLIENT,
    "parent_account",
    "sub_account",
    "child_account",
    "classification",
    "account_type",
    "budget_date",
    "budget_amount",
)


def stage_budget(sheet, start="2025-01", n_months=36, amount_type="double", *more):
    """Named columns from a positional sheet: account path split, cells as numbers; ``more`` are kept."""
    path = F.col("string_field_1")
    months = [
        budget_cell(f"string_field_{FIRST_MONTH_FIELD + i}", amount_type).alias(label)
        for i, label in enumerate(month_labels(start, n_months))
    ]
    return sheet.select(
        CLIENT,
        F.col("string_field_0").alias("parent_account"),
        path_head(path).alias("sub_account"),
        path_tail(path).alias("child_account"),
        *months,
        *more,
    )


def month_columns(staged):
    return [c for c in staged.columns if c.endswith("_budget")]


def _pack_months(df):
    """The month columns as one array, which keeps rows narrow through a join."""
    months = month_columns(df)
    return df.select(*[c for c in df.columns if c not in months], F.array(*months).alias("months"))


def _unpack_months(df, labels):
    """One row per element of ``months`` holding a value; its label as a date."""
    ids = [c for c in df.columns if c != "months"]
    # The outer explode keeps the planner from testing the array, and so cleaning
    # every cell twice, below; empty months go with the filter.
    value = F.posexplode_outer("months").alias("month", "budget_amount")
    label = F.get(F.array(*[F.lit(m) for m in labels]), F.col("month"))
    long = df.select(*ids, value).filter(F.col("budget_amount").isNotNull())
    return long.select(*ids, month_start(label).alias("budget_date"), "budget_amount")


def unpivot_months(df):
    """One row per month column holding a value; the month as a date."""
    return _unpack_months(_pack_months(df), month_columns(df))


def budget_accounts(accounts):
    """Accounts by name with the name of their parent."""
    base = accounts.select(
        CLIENT,
        F.col("Id").alias("account_id"),
        F.col("Name").alias("account_name"),
        F.col("Classification").alias("classification"),
        F.col("AccountType").alias("account_type"),
        scalar_at("ParentRef", "$.value").alias("parent_id"),
    )
    parent = base.select(
        CLIENT, F.col("account_id").alias("parent_id"), F.col("account_name").alias("parent_name")
    )
    return base.join(parent, [CLIENT, "parent_id"], "left").select(
        CLIENT,
        F.col("account_name").alias("sub_account"),
        F.coalesce("parent_name", "account_type").alias("parent_account"),
        "classification",
        "account_type",
    )


def budget_long(staged, accounts):
    """Budget per account and month with account attributes.

    Sheet rows meet their account while still wide, so the join handles one row per
    account and not one per month.  Names without an account stay, with NULLs; a
    name shared by several accounts yields a row for each.
    """
    wide = _pack_months(staged.drop("parent_account")).join(
        budget_accounts(accounts), [CLIENT, "sub_account"], "left"
    )
    return _unpack_months(wide, month_columns(staged)).select(*BUDGET_COLUMNS)


def duplicate_account_names(accounts):
    """Names that several accounts of a client share, which count a budget twice."""
    return (
        accounts.groupBy(CLIENT, "Name")
        .agg(F.count("*").alias("n_accounts"))
        .filter(F.col("n_accounts") > 1)
    )
