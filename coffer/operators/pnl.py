"""Cash-basis profit and loss over the account hierarchy."""

from pyspark.sql import functions as F

from coffer.operators.accounts import account_dim, flatten_hierarchy, layout_of, posting_targets
from coffer.operators.lines import SOURCES, all_lines
from coffer.schemas import ACCOUNT_COLUMNS, CLIENT, GRAIN

JOURNAL_TYPES = ("Income", "Expense", "Cost of Goods Sold", "Equity")

PNL_COLUMNS = (
    CLIENT,
    "txnDate",
    "classification",
    "account_type",
    "parent_account",
    "sub_account",
    "child_account",
)


def daily_postings(lines):
    """Lines added up per day, reference and posting side.

    Runs before the account join: an account that takes a large share of all lines
    shrinks in the map tasks to a row per day, so it does not skew that join when
    the account table is too large to broadcast.
    """
    keys = (CLIENT, "source", "posting", "txnDate", "ref_kind", "ref_id")
    return lines.groupBy(*keys).agg(F.sum("amount").alias("amount"))


def signed_amount():
    """Amount with the sign its source gives it.

    Purchases: income accounts and credits count negative, never twice.
    Journal entries: credits count negative, on income accounts debits do.
    """
    amount = F.col("amount")
    income = F.col("account_type") == "Income"
    not_income = F.col("account_type") != "Income"
    source, posting = F.col("source"), F.col("posting")
    negative = ((source == "purchases") & (income | (posting == "Credit"))) | (
        (source == "journal_entries")
        & (((posting == "Credit") & not_income) | ((posting == "Debit") & income))
    )
    return F.when(negative, -amount).otherwise(amount)


def posted(postings, targets):
    """Join postings to their accounts, drop foreign journal types, sign, flatten."""
    kept = (F.col("source") != "journal_entries") | F.col("account_type").isin(*JOURNAL_TYPES)
    rows = postings.join(targets, [CLIENT, "ref_kind", "ref_id"]).filter(kept)
    rows = rows.withColumn("amount", signed_amount())
    return flatten_hierarchy(rows, layout_of(F.col("source"))).select(
        CLIENT, "source", "txnDate", *ACCOUNT_COLUMNS, "amount"
    )


def pnl_rows(ledger, sources=tuple(SOURCES)):
    """Signed, flattened postings, several per grain; for a consumer that groups."""
    needs_items = {"payments", "sales_receipts"} & set(sources)
    items = ledger.table("items") if needs_items else None
    return postings_to_rows(daily_postings(all_lines(ledger, sources)), ledger.table("accounts"), items)


def postings_to_rows(postings, accounts, items=None):
    """Daily postings, from a ledger or as they were staged, as signed and flattened rows."""
    return posted(postings, posting_targets(account_dim(accounts), items))


def profit_and_loss(ledger, sources=tuple(SOURCES)):
    """Amount per client, day and place in the account hierarchy."""
    return (
        pnl_rows(ledger, sources)
        .groupBy(*GRAIN)
        .agg(F.sum("amount").alias("amount"))
        .select(*PNL_COLUMNS, "amount")
    )


def newest_first(pnl):
    """Sorted for a reader; never sort inside a pipeline."""
    return pnl.orderBy(F.col("txnDate").desc())
