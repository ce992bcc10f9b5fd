"""Hand-made books of one or two clients."""

import json

from pyspark.sql import functions as F

from coffer.schemas import CLIENT, GRAIN
from coffer.sources.ledger import Ledger

RAW = {
    "accounts": "client string, Id string, Name string, Classification string, "
    "AccountType string, SubAccount boolean, ParentRef string",
    "items": "client string, Id string, IncomeAccountRef string",
    "deposits": "client string, txnDate string, Line string",
    "purchases": "client string, txnDate string, credit boolean, Line string",
    "journal_entries": "client string, txnDate string, Line string",
    "invoices": "client string, Id string, TotalAmt double, Line string",
    "payments": "client string, txnDate string, Line string",
    "bills": "client string, Id string, TotalAmt double, Line string",
    "bill_payments": "client string, txnDate string, Line string",
    "sales_receipts": "client string, txnDate string, Line string",
}
DAY = "2025-03-05"


def ref(value):
    return json.dumps({"value": value})


def account(id, kind="Expense", parent=None, sub=None, client="c", name=None, classification="X"):
    is_sub = (parent is not None) if sub is None else sub
    return (client, id, name or id, classification, kind, is_sub, ref(parent) if parent else None)


def tree(kind, prefix, client="c"):
    """A root, a child, a grandchild and a great-grandchild of one type."""
    names = [f"{prefix}{i}" for i in range(4)]
    return [
        account(name, kind, names[i - 1] if i else None, client=client)
        for i, name in enumerate(names)
    ]


def line(detail, field, target, amount, **extra):
    return {"Amount": amount, detail: {field: {"value": target}, **extra}}


def deposit(target, amount):
    return line("DepositLineDetail", "AccountRef", target, amount)


def expense(target, amount):
    return line("AccountBasedExpenseLineDetail", "AccountRef", target, amount)


def journal(target, amount, side):
    return line("JournalEntryLineDetail", "AccountRef", target, amount, PostingType=side)


def sale(item, amount):
    return line("SalesItemLineDetail", "ItemRef", item, amount)


def paid(amount, *documents):
    return {"Amount": amount, "LinkedTxn": [{"TxnId": d} for d in documents]}


def lines(*items):
    return json.dumps(list(items))


def ledger(spark, **tables):
    options = {k: tables.pop(k) for k in ("amount_type", "on_zero_total") if k in tables}
    frames = {name: spark.createDataFrame(tables.get(name, []), s) for name, s in RAW.items()}
    return Ledger(spark, frames=frames, **options)


def rows(df, *names):
    """Rows as plain tuples, sorted, NULLs first."""
    picked = df.select(*names) if names else df
    plain = [tuple(str(v) if hasattr(v, "isoformat") else v for v in r) for r in picked.collect()]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


PNL_SCHEMA = (
    "client string, txnDate date, parent_account string, sub_account string, "
    "child_account string, classification string, account_type string, amount double"
)


def pnl(spark, *facts):
    """P&L rows from (parent, sub, child, amount) with optional classification and type."""
    data = []
    for parent, sub, child, amount, *rest in facts:
        classification, kind = (list(rest) + ["Expense", "Expense"])[:2] if rest else ("Expense", "Expense")
        data.append(("c", DAY, parent, sub, child, classification, kind, amount))
    schema = PNL_SCHEMA.replace("txnDate date", "txnDate string")
    return spark.createDataFrame(data, schema).withColumn("txnDate", F.col("txnDate").cast("date"))


def no_budget(spark):
    names = [CLIENT, "budget_date", *GRAIN[2:]]
    kinds = ["date" if n == "budget_date" else "string" for n in names]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds)) + ", budget_amount double"
    return spark.createDataFrame([], schema)
