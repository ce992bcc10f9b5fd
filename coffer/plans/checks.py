"""Input checks per client, so that one client's bad data does not stop the others."""

from functools import reduce

from pyspark.sql import functions as F

from coffer.operators.lines import SOURCE_TABLES
from coffer.plans.staging import staged
from coffer.schemas import CLIENT
from coffer.sources.ledger import BAD_BOOLEANS
from coffer.sources.sheet import MALFORMED

# Problems by column of the staged postings; those of documents that payments point at have their table's name.
_LINE_PROBLEMS = {"bad_dates": "txnDate", "bad_amounts": "Amount", BAD_BOOLEANS: "credit"}
_TOTAL_PROBLEMS = {"zero_totals": "TotalAmt", "bad_totals": "unparsable_TotalAmt"}
_PAYMENT_PROBLEMS = {"bad_dates": "txnDate", "bad_paid": "Amount"}
_ACCOUNT_PROBLEMS = {BAD_BOOLEANS: "SubAccount"}


def _report(df, table, problems):
    """Client, table, problem and count, from a number per row and problem; ``table`` is a column."""
    sums = df.groupBy(CLIENT, table.alias("table")).agg(*[F.sum(n).alias(p) for n, p in problems.items()])
    return (
        sums.unpivot([CLIENT, "table"], list(problems.values()), "problem", "n")
        .filter("n > 0")
        .select(CLIENT, "table", "problem", "n")
    )


def _document_table():
    """Table whose documents a source's lines come from."""
    table = F.lit(None).cast("string")
    for source, tables in SOURCE_TABLES.items():
        table = F.when(F.col("source") == source, F.lit(tables[-1])).otherwise(table)
    return table


def problems_of(books):
    """Problems of staged books: client, table, problem and how many.

    These are sums over stored counts: no raw table is read and nothing parsed again.
    """
    checks = [
        _report(books.postings, _document_table(), _LINE_PROBLEMS | _TOTAL_PROBLEMS),
        _report(books.payments, F.col("table"), _PAYMENT_PROBLEMS),
        _report(books.accounts, F.lit("accounts"), _ACCOUNT_PROBLEMS),
    ]
    if books.budget is not None:
        malformed = books.budget.select(CLIENT, F.col(MALFORMED).cast("bigint").alias(MALFORMED))
        checks.append(_report(malformed, F.lit("budget_sheet"), {MALFORMED: "columns"}))
    return reduce(lambda a, b: a.unionByName(b), checks)


def client_problems(ledger):
    """Rows that would fail a refresh: client, table, problem and how many.

    Checks what the strict casts and the division would raise on: dates, amounts of
    lines that carry a reference, paid amounts, booleans, and totals of paid documents
    that are zero or no number.
    """
    return problems_of(staged(ledger))
