"""The six kinds of transactions as rows of one shape.

Each function gives ``client, source, posting, txnDate, ref_kind, ref_id, amount``:
one row per transaction line that carries a reference, unsigned as written in the
document.  Signs depend on the account and are set after the account join.
"""

from pyspark.sql import functions as F

from coffer.functions.json_text import elements, scalar
from coffer.operators.accounts import ACCOUNT, ITEM
from coffer.schemas import CLIENT, LINE_ELEMENTS

# Where a line of each document names its account or item.
REFERENCES = {
    "deposits": "DepositLineDetail.AccountRef",
    "purchases": "AccountBasedExpenseLineDetail.AccountRef",
    "journal_entries": "JournalEntryLineDetail.AccountRef",
    "invoices": "SalesItemLineDetail.ItemRef",
    "bills": "AccountBasedExpenseLineDetail.AccountRef",
    "sales_receipts": "SalesItemLineDetail.ItemRef",
}


def parsed_lines(table):
    """The ``Line`` column of ``table`` as an array of structs."""
    return elements("Line", LINE_ELEMENTS[table])


def explode_lines(df, table, *keep):
    """One row per line of each document; documents without lines vanish."""
    return df.select(*keep, F.explode(parsed_lines(table)).alias("line"))


def _reference(df, table):
    """Add ``ref_id``, the account or item of each line, keeping lines that have one."""
    return df.withColumn("ref_id", scalar(f"line.{REFERENCES[table]}.value")).filter(
        F.col("ref_id").isNotNull()
    )


def _rows(df, source, ref_kind, amount, posting=None):
    posting = F.lit(None) if posting is None else posting
    return df.select(
        CLIENT,
        F.lit(source).alias("source"),
        posting.cast("string").alias("posting"),
        "txnDate",
        F.lit(ref_kind).alias("ref_kind"),
        "ref_id",
        amount.alias("amount"),
    )


def _line_amount(ledger):
    return scalar("line.Amount").cast(ledger.amount_type)


def _date():
    return F.col("txnDate").cast("date").alias("txnDate")


def deposits_lines(ledger):
    lines = explode_lines(ledger.table("deposits"), "deposits", CLIENT, _date())
    lines = _reference(lines, "deposits")
    return _rows(lines, "deposits", ACCOUNT, _line_amount(ledger))


def purchases_lines(ledger):
    lines = explode_lines(ledger.table("purchases"), "purchases", CLIENT, _date(), "credit")
    lines = _reference(lines, "purchases")
    posting = F.when(F.col("credit"), F.lit("Credit"))
    return _rows(lines, "purchases", ACCOUNT, _line_amount(ledger), posting)


def journal_lines(ledger):
    table = "journal_entries"
    lines = explode_lines(ledger.table(table), table, CLIENT, _date())
    lines = _reference(lines, table)
    posting = scalar("line.JournalEntryLineDetail.PostingType")
    return _rows(lines, table, ACCOUNT, _line_amount(ledger), posting)


def sales_receipt_lines(ledger):
    table = "sales_receipts"
    lines = explode_lines(ledger.table(table), table, CLIENT, _date())
    lines = _reference(lines, table)
    return _rows(lines, table, ITEM, _line_amount(ledger))


def linked_payments(ledger, table, rows=None):
    """Paid amount, as text, and document of each payment: first line, first link.

    The first line comes out of an explode of a one-element slice: filters on what
    was parsed cannot sink below it, where they would parse each payment again.
    """
    first = F.explode(F.slice(parsed_lines(table), 1, 1)).alias("first")
    return (
        (ledger.table(table) if rows is None else rows)
        .select(CLIENT, "txnDate", first)
        .select(
            CLIENT,
            "txnDate",
            scalar("get(first.LinkedTxn, 0).TxnId").alias("document_id"),
            scalar("first.Amount").alias("paid"),
        )
        .filter(F.col("document_id").isNotNull())
    )


def documents(ledger, table):
    """Invoices or bills, one compact row per document with its parsed lines."""
    return ledger.table(table).select(
        CLIENT, F.col("Id").alias("document_id"), "TotalAmt", parsed_lines(table).alias("lines")
    )


def paid_documents(ledger, payments_table, documents_table):
    """Documents joined to what was paid on them, one row per document and day.

    Payments of a document on one day are added up before the join, so a document
    paid in very many instalments costs at most one row per day, and the join
    moves documents with their lines still packed; lines unpack after it.
    """
    paid = (
        linked_payments(ledger, payments_table)
        .groupBy(CLIENT, "document_id", _date())
        .agg(F.sum(F.coalesce(F.col("paid").cast("double"), F.lit(0.0))).alias("paid"))
    )
    return documents(ledger, documents_table).join(paid, [CLIENT, "document_id"])


def paid_share(ledger):
    """Paid part of a document's total."""
    total = F.col("TotalAmt").cast("double")
    if ledger.on_zero_total == "null":
        return F.try_divide(F.col("paid"), total)
    return F.col("paid") / total


def _allocated_lines(ledger, payments_table, documents_table, ref_kind):
    paid = paid_documents(ledger, payments_table, documents_table)
    # The outer explode keeps the planner from testing the size of the parsed lines
    # below the join, which would parse every document twice.  Lines without a
    # reference, and so documents without lines, go with the next filter.
    line = F.explode_outer("lines").alias("line")
    lines = _reference(paid.select(CLIENT, "txnDate", "paid", "TotalAmt", line), documents_table)
    amount = scalar("line.Amount").cast("double") * paid_share(ledger)
    return _rows(lines, payments_table, ref_kind, amount.cast(ledger.amount_type))


def payment_lines(ledger):
    """Customer payments allocated over the lines of the invoices they pay."""
    return _allocated_lines(ledger, "payments", "invoices", ITEM)


def bill_payment_lines(ledger):
    """Bill payments allocated over the lines of the bills they pay."""
    return _allocated_lines(ledger, "bill_payments", "bills", ACCOUNT)


SOURCES = {
    "deposits": deposits_lines,
    "purchases": purchases_lines,
    "journal_entries": journal_lines,
    "payments": payment_lines,
    "bill_payments": bill_payment_lines,
    "sales_receipts": sales_receipt_lines,
}

# Raw tables each source reads.
SOURCE_TABLES = {
    "deposits": ("deposits",),
    "purchases": ("purchases",),
    "journal_entries": ("journal_entries",),
    "payments": ("payments", "invoices"),
    "bill_payments": ("bill_payments", "bills"),
    "sales_receipts": ("sales_receipts",),
}


# Kind of reference in each source's lines.
REF_KINDS = {name: ITEM if name in ("payments", "sales_receipts") else ACCOUNT for name in SOURCES}


def all_lines(ledger, sources=tuple(SOURCES)):
    """Lines of the given sources in one frame."""
    frames = [SOURCES[name](ledger) for name in sources]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union
