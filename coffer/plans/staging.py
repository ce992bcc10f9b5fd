"""The books read once: typed rows, and beside them what is wrong with them.

Each raw table is scanned and each JSON document parsed one time.  Values that a
strict cast would raise on become NULL and are counted, so that the checks of a
refresh and its facts come from the same stored rows.
"""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coffer.functions.json_text import scalar
from coffer.operators.budget import stage_budget
from coffer.operators.lines import REF_KINDS, REFERENCES, SOURCE_TABLES, linked_payments, parsed_lines
from coffer.schemas import CLIENT
from coffer.sinks.snapshots import layer_path, read_snapshot, write_snapshot
from coffer.sources.ledger import BAD_BOOLEANS, unparsable
from coffer.sources.sheet import MALFORMED

POSTING_KEYS = (CLIENT, "source", "posting", "txnDate", "ref_kind", "ref_id")
# What can be wrong with a posting's documents; counted once per document or line.
POSTING_FAULTS = ("bad_dates", "bad_amounts", BAD_BOOLEANS, "bad_totals", "zero_totals")
PAYMENT_FAULTS = ("bad_dates", "bad_paid")

STAGED = ("payments", "postings", "accounts", "budget", "client_problems", "settled_blend")

_DIRECT = {name: tables[0] for name, tables in SOURCE_TABLES.items() if len(tables) == 1}
_PAID = {name: tables[1] for name, tables in SOURCE_TABLES.items() if len(tables) == 2}


@dataclass(frozen=True)
class StagedBooks:
    """Accounts, payments added up per document and day, postings added up per day and reference, budget rows."""

    accounts: DataFrame
    payments: DataFrame
    postings: DataFrame
    budget: DataFrame | None = None


def _flag(condition):
    return F.expr(f"CAST(coalesce({condition}, FALSE) AS BIGINT)")


def _no_faults(*present):
    return [F.lit(0).cast("bigint").alias(name) for name in POSTING_FAULTS if name not in present]


def payment_rows(ledger):
    """Payments of both kinds per client, document and day: what was paid, and how many are bad."""

    def of(table):
        linked = linked_payments(ledger, table, ledger.checked(table))
        return linked.select(
            CLIENT,
            F.lit(table).alias("table"),
            "document_id",
            F.expr("try_cast(txnDate AS DATE)").alias("txnDate"),
            F.expr("coalesce(try_cast(paid AS DOUBLE), 0D)").alias("paid"),
            _flag(unparsable("txnDate", "date")).alias("bad_dates"),
            _flag(unparsable("paid", "double")).alias("bad_paid"),
        )

    union = reduce(lambda a, b: a.unionByName(b), [of(table) for table in _PAID])
    sums = [F.sum(name).alias(name) for name in ("paid", *PAYMENT_FAULTS)]
    return union.groupBy(CLIENT, "table", "document_id", "txnDate").agg(*sums)


def _amount(ledger):
    return scalar("line.Amount"), f"({unparsable('amount_text', ledger.amount_type)} AND ref_id IS NOT NULL)"


def _reference(table):
    return scalar(f"line.{REFERENCES[table]}.value").alias("ref_id")


def _direct_postings(ledger, source):
    """Lines of a kind of transaction that posts by itself.

    The outer explode keeps documents without lines, whose date may be wrong.
    """
    table = _DIRECT[source]
    raw = ledger.checked(table)
    side = {"purchases": "IF(credit, 'Credit', NULL)", "journal_entries": None}.get(source, "CAST(NULL AS STRING)")
    kept = [CLIENT, "txnDate", BAD_BOOLEANS, *(["credit"] if source == "purchases" else [])]
    lines = raw.select(*kept, F.posexplode_outer(parsed_lines(table)).alias("place", "line"))
    posting = scalar("line.JournalEntryLineDetail.PostingType") if side is None else F.expr(side)
    amount, bad_amount = _amount(ledger)
    rows = lines.select(
        *kept, "place", posting.alias("posting"), _reference(table), amount.alias("amount_text")
    )
    first = "coalesce(place, 0) = 0"
    return rows.select(
        CLIENT,
        F.lit(source).alias("source"),
        "posting",
        F.expr("try_cast(txnDate AS DATE)").alias("txnDate"),
        F.lit(REF_KINDS[source]).alias("ref_kind"),
        "ref_id",
        F.expr(f"try_cast(amount_text AS {ledger.amount_type})").alias("amount"),
        _flag(f"{first} AND {unparsable('txnDate', 'date')}").alias("bad_dates"),
        _flag(bad_amount).alias("bad_amounts"),
        F.expr(f"CAST(IF({first}, {BAD_BOOLEANS}, 0) AS BIGINT)").alias(BAD_BOOLEANS),
        *_no_faults("bad_dates", "bad_amounts", BAD_BOOLEANS),
    )


def _allocated_postings(ledger, source, payments):
    """Lines of documents, each with the share of it that was paid on a day.

    Documents without payments stay for the faults of their lines, and post nothing.
    A document's own faults count on the first day it was paid.
    """
    table = _PAID[source]
    of_document = Window.partitionBy(CLIENT, "document_id").orderBy("txnDate")
    paid = (
        payments.filter(F.col("table") == source)
        .select(CLIENT, "document_id", "txnDate", "paid", F.row_number().over(of_document).alias("nth"))
    )
    documents = ledger.checked(table).select(
        CLIENT, F.col("Id").alias("document_id"), "TotalAmt", parsed_lines(table).alias("lines")
    )
    met = documents.join(paid, [CLIENT, "document_id"], "left")
    lines = met.select(CLIENT, "txnDate", "paid", "nth", "TotalAmt", F.posexplode_outer("lines").alias("place", "line"))
    amount, bad_amount = _amount(ledger)
    rows = lines.select(
        CLIENT, "txnDate", "paid", "nth", "TotalAmt", "place", _reference(table), amount.alias("amount_text")
    )
    total = "try_cast(CAST(TotalAmt AS STRING) AS DOUBLE)"
    once = "coalesce(nth, 1) = 1"
    document = f"{once} AND coalesce(place, 0) = 0 AND paid IS NOT NULL"
    zero = "FALSE" if ledger.on_zero_total == "null" else f"{document} AND {total} = 0"
    share = f"try_divide(paid, {total})"
    return rows.select(
        CLIENT,
        F.lit(source).alias("source"),
        F.lit(None).cast("string").alias("posting"),
        "txnDate",
        F.lit(REF_KINDS[source]).alias("ref_kind"),
        # What was never paid posts nothing, and is no reason to keep its line.
        F.expr("IF(paid IS NULL, NULL, ref_id)").alias("ref_id"),
        F.expr(f"try_cast(try_cast(amount_text AS DOUBLE) * {share} AS {ledger.amount_type})").alias("amount"),
        _flag(f"{once} AND {bad_amount}").alias("bad_amounts"),
        _flag(f"{document} AND {unparsable('TotalAmt', 'double')}").alias("bad_totals"),
        _flag(zero).alias("zero_totals"),
        *_no_faults("bad_amounts", "bad_totals", "zero_totals"),
    )


def posting_rows(ledger, payments, sources=tuple(SOURCE_TABLES)):
    """Postings of all sources per day and reference, with the number of faults behind them.

    Rows without a reference post nothing; they carry faults.
    """
    frames = [
        _direct_postings(ledger, s) if s in _DIRECT else _allocated_postings(ledger, s, payments) for s in sources
    ]
    union = reduce(lambda a, b: a.unionByName(b), frames)
    faulty = " + ".join(POSTING_FAULTS)
    sums = [F.sum(name).alias(name) for name in ("amount", *POSTING_FAULTS)]
    return union.filter(f"ref_id IS NOT NULL OR {faulty} > 0").groupBy(*POSTING_KEYS).agg(*sums)


def budget_rows(ledger, sheet, start, n_months):
    """Cleaned budget rows, with a mark on those that are malformed; frames without the mark have none."""
    sheet = ledger.in_scope(sheet)
    mark = F.col(MALFORMED) if MALFORMED in sheet.columns else F.lit(False)
    return stage_budget(sheet, start, n_months, ledger.amount_type, mark.alias(MALFORMED))


def staged(ledger):
    """The staged books as plans, none of which runs yet."""
    payments = payment_rows(ledger)
    return StagedBooks(ledger.checked("accounts"), payments, posting_rows(ledger, payments))


def stage(ledger, output_root, sheet, start="2025-01", n_months=36):
    """The staged books as stored tables, each written once and read from then on."""
    spark = ledger.spark

    def stored(df, name):
        path = layer_path(output_root, "staging", name)
        write_snapshot(df, path)
        return read_snapshot(spark, path)

    # Independent jobs overlap: the small tables are done while payments and postings run.
    with ThreadPoolExecutor(3) as pool:
        accounts = pool.submit(lambda: stored(ledger.checked("accounts"), "accounts"))
        budget = pool.submit(lambda: stored(budget_rows(ledger, sheet, start, n_months), "budget"))
        payments = stored(payment_rows(ledger), "payments")
        postings = stored(posting_rows(ledger, payments), "postings")
        return StagedBooks(accounts.result(), payments, postings, budget.result())
