import pytest
from pyspark.sql import functions as F

import books
from books import DAY, account, deposit, expense, journal, ledger, lines, paid, ref, rows, sale, tree
from coffer.operators.accounts import account_dim, flatten_hierarchy
from coffer.operators.lines import deposits_lines, linked_payments, paid_documents, purchases_lines
from coffer.operators.pnl import newest_first, profit_and_loss

SHAPE = ("parent_account", "sub_account", "child_account", "amount")


def amounts(book, *sources):
    return rows(profit_and_loss(book, sources), *SHAPE)


def by_account(book, *sources):
    """Amount per account name, the last filled level."""
    name = F.coalesce("child_account", "sub_account").alias("name")
    return dict(rows(profit_and_loss(book, sources).select(name, "amount")))


FULL = [
    ("Income", "I0", None, 1.0), ("Income", "I0", "I1", 2.0),
    ("I0", "I1", "I2", 3.0), ("I1", "I2", "I3", 4.0),
]
SHORT = [
    ("Income", "I0", None, 1.0), ("I0", "I1", None, 2.0),
    ("I0", "I1", "I2", 3.0), ("I1", "I2", "I3", 4.0),
]


def _sorted(facts):
    return sorted(facts, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_full_layout_by_depth(spark):
    four = lines(*[deposit(f"I{i}", i + 1) for i in range(4)])
    book = ledger(spark, accounts=tree("Income", "I"), deposits=[("c", DAY, four)])
    assert amounts(book, "deposits") == _sorted(FULL)


def test_short_layout_by_depth(spark):
    four = lines(*[expense(f"I{i}", -(i + 1)) for i in range(4)])
    book = ledger(spark, accounts=tree("Income", "I"), purchases=[("c", DAY, None, four)])
    assert amounts(book, "purchases") == _sorted(SHORT)


@pytest.mark.parametrize("kind,full", [("Income", True), ("Cost of Goods Sold", True), ("Expense", False), ("Equity", False)])
def test_mixed_layout_follows_account_type(spark, kind, full):
    four = lines(*[journal(f"I{i}", i + 1, "?") for i in range(4)])
    book = ledger(spark, accounts=tree(kind, "I"), journal_entries=[("c", DAY, four)])
    expected = FULL if full else SHORT
    swap = {"Income": kind}
    expected = [(swap.get(p, p), s, c, a) for p, s, c, a in expected]
    assert amounts(book, "journal_entries") == _sorted(expected)


def test_sources_and_their_layouts(spark):
    accounts = tree("Income", "I")
    book = ledger(
        spark,
        accounts=accounts,
        items=[("c", "it", ref("I1"))],
        sales_receipts=[("c", DAY, lines(sale("it", 5)))],
        invoices=[("c", "inv", 10.0, lines(sale("it", 10)))],
        payments=[("c", DAY, lines(paid(5, "inv")))],
        bills=[("c", "bill", 10.0, lines(expense("I1", 10)))],
        bill_payments=[("c", DAY, lines(paid(2.5, "bill")))],
    )
    assert amounts(book, "sales_receipts") == [("Income", "I0", "I1", 5.0)]
    assert amounts(book, "payments") == [("Income", "I0", "I1", 5.0)]
    assert amounts(book, "bill_payments") == [("I0", "I1", None, 2.5)]
    assert amounts(book, "payments", "sales_receipts", "bill_payments") == [
        ("I0", "I1", None, 2.5), ("Income", "I0", "I1", 10.0),
    ]


def test_parents_that_are_missing_or_not_sub(spark):
    accounts = [
        account("lost", parent="nowhere"),
        account("null_sub", parent="root", sub=False),
        account("root"),
        ("c", "unknown", "unknown", "X", "Expense", None, ref("root")),
        account("list_ref"),
    ]
    book = ledger(
        spark, accounts=accounts,
        deposits=[("c", DAY, lines(*[deposit(a[1], 1) for a in accounts]))],
    )
    assert set(amounts(book, "deposits")) == {
        (None, "lost", None, 1.0),
        ("Expense", "Expense", "null_sub", 1.0),
        ("Expense", "root", None, 1.0),
        ("Expense", "Expense", "unknown", 1.0),
        ("Expense", "list_ref", None, 1.0),
    }


def test_purchase_signs(spark):
    book = ledger(
        spark,
        accounts=[account("in", "Income"), account("ex"), account("none", None)],
        purchases=[
            ("c", DAY, True, lines(expense("in", 10), expense("ex", 5), expense("none", 3))),
            ("c", DAY, None, lines(expense("in", 1), expense("ex", 2), expense("none", 1))),
            ("c", DAY, False, lines(expense("ex", 7))),
        ],
    )
    assert by_account(book, "purchases") == {"in": -11.0, "ex": 4.0, "none": -2.0}


def test_journal_signs_and_types(spark):
    kinds = {"in": "Income", "ex": "Expense", "eq": "Equity", "cogs": "Cost of Goods Sold", "bank": "Bank", "none": None}
    entries = [journal(a, 10, "Credit") for a in kinds] + [journal(a, 1, "Debit") for a in kinds]
    entries += [journal("ex", 100, None), journal("in", 100, "Other")]
    book = ledger(
        spark, accounts=[account(a, k) for a, k in kinds.items()],
        journal_entries=[("c", DAY, lines(*entries))],
    )
    assert by_account(book, "journal_entries") == {"in": 109.0, "ex": 91.0, "eq": -9.0, "cogs": -9.0}


def test_line_edge_cases(spark):
    book = ledger(
        spark, accounts=[account("a")],
        deposits=[
            ("c", DAY, None), ("c", DAY, "[]"), ("c", DAY, "{}"), ("c", DAY, "junk"),
            ("c", DAY, lines({"Amount": 9}, {"Amount": 9, "DepositLineDetail": "odd"})),
            ("c", DAY, lines({"Amount": 9, "DepositLineDetail": {"AccountRef": {"value": {"x": 1}}}})),
            ("c", DAY, lines(deposit("a", "3.5"), deposit("gone", 100), deposit("a", 1))),
            ("c", "2025-03-05T23:00:00", lines(7, deposit("a", 2))),
            ("c", DAY, lines(deposit("a", None))),
        ],
    )
    assert amounts(book, "deposits") == [("Expense", "a", None, 6.5)]


def test_bad_text_raises(spark):
    accounts = [account("a")]
    bad_amount = ledger(spark, accounts=accounts, deposits=[("c", DAY, lines(deposit("a", "12x")))])
    bad_date = ledger(spark, accounts=accounts, deposits=[("c", "soon", lines(deposit("a", 1)))])
    for book in (bad_amount, bad_date):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            amounts(book, "deposits")


def test_only_first_payment_line_and_link_count(spark):
    book = ledger(
        spark,
        accounts=[account("a", "Income"), account("b", "Income")],
        items=[("c", "ia", ref("a")), ("c", "ib", ref("b"))],
        invoices=[
            ("c", "1", 100.0, lines(sale("ia", 60), sale("ib", 40))),
            ("c", "2", 50.0, lines(sale("ia", 50))),
            ("c", "unpaid", 10.0, lines(sale("ia", 10))),
        ],
        payments=[
            ("c", DAY, lines(paid(50, "1", "2"), paid(7, "2"))),
            ("c", DAY, lines(paid(25, "1"))),
            ("c", DAY, lines(paid(None, "2"))),
            ("c", DAY, lines(paid(9, "nothing"))),
            ("c", DAY, None), ("c", DAY, "[]"), ("c", DAY, lines({"Amount": 3})),
        ],
    )
    assert by_account(book, "payments") == {"a": 45.0, "b": 30.0}
    assert rows(linked_payments(book, "payments"), "document_id", "paid") == [
        ("1", "25"), ("1", "50"), ("2", None), ("nothing", "9"),
    ]


def test_zero_total_raises_or_gives_null(spark):
    data = dict(
        accounts=[account("a")],
        bills=[("c", "1", 0.0, lines(expense("a", 10))), ("c", "2", 10.0, lines(expense("a", 10)))],
        bill_payments=[("c", DAY, lines(paid(5, "1"))), ("c", DAY, lines(paid(5, "2")))],
    )
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        amounts(ledger(spark, **data), "bill_payments")
    assert by_account(ledger(spark, on_zero_total="null", **data), "bill_payments") == {"a": 5.0}


def test_duplicate_ids_fan_out_as_joins_do(spark):
    book = ledger(
        spark, accounts=[account("a"), account("a", name="again")],
        deposits=[("c", DAY, lines(deposit("a", 1)))],
    )
    assert by_account(book, "deposits") == {"a": 1.0, "again": 1.0}


def test_clients_do_not_mix(spark):
    book = ledger(
        spark,
        accounts=[account("a", "Income", name="ours"), account("a", "Expense", client="d", name="theirs")],
        items=[("c", "i", ref("a"))],
        deposits=[("c", DAY, lines(deposit("a", 1))), ("d", DAY, lines(deposit("a", 2)))],
        sales_receipts=[("d", DAY, lines(sale("i", 5)))],
        invoices=[("c", "1", 10.0, lines(sale("i", 10)))],
        payments=[("d", DAY, lines(paid(10, "1")))],
    )
    assert rows(profit_and_loss(book), "client", "sub_account", "amount") == [
        ("c", "ours", 1.0), ("d", "theirs", 2.0),
    ]
    only = book.with_options(clients=("d",))
    assert rows(profit_and_loss(only), "client") == [("d",)]


def test_decimal_sums_are_exact(spark):
    tenth = [("c", DAY, lines(deposit("a", 0.1)))] * 10
    book = ledger(spark, accounts=[account("a")], deposits=tenth, amount_type="decimal(18,4)")
    assert [str(r.amount) for r in profit_and_loss(book).collect()] == ["1.0000"]


def test_sum_is_kept_through_join_and_flatten(spark):
    accounts = tree("Income", "I") + tree("Expense", "E")
    docs = [("c", f"2025-01-{d:02d}", lines(*[deposit(f"{p}{i}", d) for p in "IE" for i in range(4)])) for d in range(1, 29)]
    book = ledger(spark, accounts=accounts, deposits=docs)
    total = deposits_lines(book).agg(F.sum("amount")).first()[0]
    assert profit_and_loss(book).agg(F.sum("amount")).first()[0] == total == 8 * sum(range(1, 29))


def test_lines_keep_purchase_credit(spark):
    book = ledger(spark, purchases=[("c", DAY, True, lines(expense("a", 1))), ("c", DAY, None, lines(expense("a", 2)))])
    assert rows(purchases_lines(book), "posting", "amount") == [(None, 2.0), ("Credit", 1.0)]


def test_reader_order(spark):
    book = ledger(
        spark, accounts=[account("a")],
        deposits=[("c", d, lines(deposit("a", 1))) for d in ("2025-01-01", "2025-01-03", "2025-01-02")],
    )
    days = [str(r.txnDate) for r in newest_first(profit_and_loss(book)).collect()]
    assert days == ["2025-01-03", "2025-01-02", "2025-01-01"]


def test_dimension_levels(spark):
    book = ledger(spark, accounts=tree("Income", "I"))
    dim = account_dim(book.table("accounts"))
    assert rows(dim, "account_name", "level1", "level2_full", "level2_short") == [
        ("I0", "Income", None, None), ("I1", "I0", "Income", None),
        ("I2", "I1", "I0", "I0"), ("I3", "I2", "I1", "I1"),
    ]
    flat = flatten_hierarchy(dim, "short")
    assert "level1" not in flat.columns and books.CLIENT in flat.columns


def test_hot_document_and_hot_account(spark):
    """One invoice and one account hold most rows; sums stay whole and join rows few."""
    pages = spark.range(3000).select(
        F.lit("c").alias("client"), F.lit("hot").alias("Id"), F.lit(30000.0).alias("TotalAmt"),
        F.lit(lines(sale("i", 4), sale("j", 6))).alias("Line"),
    )
    instalments = spark.range(2000).select(
        F.lit("c").alias("client"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("txnDate"),
        F.lit(lines(paid(3, "hot"))).alias("Line"),
    )
    book = ledger(
        spark, accounts=[account("a", "Income"), account("b", "Income")],
        items=[("c", "i", ref("a")), ("c", "j", ref("b"))], amount_type="decimal(18,4)",
    )
    book.frames.update(invoices=pages, payments=instalments)
    assert paid_documents(book, "payments", "invoices").count() == 3000 * 2
    got = rows(profit_and_loss(book, ("payments",)), "txnDate", "sub_account", "amount")
    assert [(d, s, float(a)) for d, s, a in got] == [
        ("2025-01-01", "a", 1200.0), ("2025-01-01", "b", 1800.0),
        ("2025-01-02", "a", 1200.0), ("2025-01-02", "b", 1800.0),
    ]
