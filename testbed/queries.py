"""Contract queries: every operator on the ledger derived from the given tables."""

from pyspark.sql import functions as F

from coffer.functions.json_text import scalar_at
from coffer.functions.keys import entry_id
from coffer.functions.text import (
    budget_cell,
    month_labels,
    month_start,
    path_head,
    path_tail,
    sheet_address,
)
from coffer.operators import accounts as accounts_op
from coffer.operators import comments as comments_op
from coffer.operators import lines as lines_op
from coffer.operators.blend import blend, blend_refresh
from coffer.operators.budget import (
    budget_accounts,
    budget_long,
    duplicate_account_names,
    stage_budget,
    unpivot_months,
)
from coffer.operators.pnl import (
    JOURNAL_TYPES,
    newest_first,
    pnl_rows,
    profit_and_loss,
)
from coffer.operators.profit import profit
from coffer.plans.refresh import BLEND, COMMENTED, PROFIT, refresh
from coffer.schemas import ACCOUNT_COLUMNS, CLIENT, FIRST_MONTH_FIELD, GRAIN, RAW_COLUMNS
from coffer.sinks.snapshots import current_versions, layer_path, read_snapshot, write_snapshot
from coffer.sinks.views import register_views
from coffer.sources.catalog import table_exists
from coffer.sources.sheet import MALFORMED, read_budget_sheet
from testbed.derive import (
    AMOUNT_TYPE,
    BLEND_START,
    N_MONTHS,
    landed,
    read,
)

SLICE = dict(first_row=4, last_row=69, last_letters="U", n_columns=21)


def _doubles(df, *names):
    """Exact decimal sums shown as doubles, the money type of the source systems."""
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _count(df, **constants):
    return df.select(
        *[F.lit(value).alias(name) for name, value in constants.items()],
    ).groupBy(*constants).agg(F.count("*").alias("n_rows"))


# Sources and sinks


def scan_budget_sheet(spark, sf_dir):
    return landed(spark, sf_dir).sheet.drop(MALFORMED)


def slice_sheet_range(spark, sf_dir):
    """A range of the whole tabs, rows counted while their files are read."""
    tabs = landed(spark, sf_dir).tab_path
    sheet_range = f"Budget!A{SLICE['first_row']}:{SLICE['last_letters']}{SLICE['last_row']}"
    return read_budget_sheet(spark, tabs, sheet_range, skip_leading_rows=0, keep_rows=True)


def _scanned(ledger, name):
    """A raw table read whole: transactions line by line, whatever document holds them, other tables row by row."""
    rows = ledger.table(name)
    if name not in lines_op.REFERENCES:
        return rows
    # The subtotal and the note that a document adds to its lines have no detail.
    detail = F.col(f"line.{lines_op.REFERENCES[name]}")
    return lines_op.explode_lines(rows, name, CLIENT).filter(detail.isNotNull())


def scan_ledger_tables(spark, sf_dir):
    """Rows of every ledger table and client; of transactions, every line is read and counted."""
    ledger = landed(spark, sf_dir).ledger
    union = None
    for name in RAW_COLUMNS:
        counts = (
            _scanned(ledger, name)
            .groupBy(CLIENT)
            .agg(F.count("*").alias("n_rows"))
            .select(F.lit(name).alias("table_name"), CLIENT, "n_rows")
        )
        union = counts if union is None else union.unionByName(counts)
    return union


def table_exists_check(spark, sf_dir):
    """Row count of each ledger table that exists; names that do not exist give 0."""
    ledger = landed(spark, sf_dir).ledger
    union = None
    for name in (*RAW_COLUMNS, "credit_memos"):
        present = table_exists(spark, ledger.path(name))
        rows = ledger.table(name) if present else ledger.table("accounts").filter(F.lit(False))
        counts = rows.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(present).alias("is_present"), "n_rows"
        )
        union = counts if union is None else union.unionByName(counts)
    return union


def view_roundtrip(spark, sf_dir):
    pnl = _doubles(profit_and_loss(landed(spark, sf_dir).ledger), "amount")
    register_views({"p_l_view": pnl}, prefix="roundtrip_")
    return spark.sql("SELECT * FROM roundtrip_p_l_view")


def table_roundtrip(spark, sf_dir):
    data = landed(spark, sf_dir)
    path = data.fresh("table_roundtrip")
    pnl = _doubles(profit_and_loss(data.ledger), "amount")
    write_snapshot(pnl.filter(F.lit(False)), path)
    write_snapshot(pnl, path)
    return read_snapshot(spark, path)


def write_partitioned_by_client(spark, sf_dir):
    data = landed(spark, sf_dir)
    path = layer_path(data.fresh("layers"), "core", "p_l_view")
    write_snapshot(profit_and_loss(data.ledger), path, even=False)
    stored = read_snapshot(spark, path)
    return _doubles(
        stored.groupBy(CLIENT).agg(
            F.count("*").alias("n_rows"), F.sum("amount").alias("amount")
        ),
        "amount",
    )


def comments_init(spark, sf_dir):
    """Created empty, filled, and left alone by the next call."""
    data = landed(spark, sf_dir)
    path = data.fresh("comments")
    comments_op.ensure_comments(spark, path)
    comments_op.add_comments(data.comments, path)
    return comments_op.ensure_comments(spark, path)


def pl_by_client(spark, sf_dir):
    """Facts by client after a second refresh, of three clients without their deposits.

    One of the three has a purchase without a proper date: it keeps the rows of the
    first refresh, as do the clients that are not part of the second.
    """
    data = landed(spark, sf_dir)
    purchases = data.ledger.raw("purchases")
    bad = purchases.filter(F.col(CLIENT) == "client_1").limit(1).withColumn("txnDate", F.lit("soon"))
    changed = {"deposits": data.ledger.raw("deposits").filter(F.lit(False)), "purchases": purchases.unionByName(bad)}
    ledger = data.ledger.with_options(frames=changed, clients=("client_0", "client_1", "client_2"))
    outcome = refresh(ledger, data.sheet, data.reports, start=BLEND_START)
    path = layer_path(data.reports, "marts", BLEND)
    sums = read_snapshot(spark, path).groupBy(CLIENT, "classification", "account_type").agg(
        F.count("*").alias("n_rows"),
        F.sum("actual").alias("actual"),
        F.sum("budget_amount").alias("budget_amount"),
    )
    # Stored by the first refresh or a later one, and held back by how many problems.
    stored = current_versions(spark, path).select(CLIENT, (F.col("version") > 1).alias("is_refreshed"))
    held = outcome.problems.groupBy(CLIENT).agg(F.sum("n").cast("long").alias("n_problems"))
    return _doubles(sums.join(stored, CLIENT).join(held, CLIENT, "left"), "actual", "budget_amount")


# Expressions


def project_rename(spark, sf_dir):
    accounts = landed(spark, sf_dir).ledger.table("accounts")
    return accounts.select(
        CLIENT,
        F.col("Name").alias("account_name"),
        F.col("Classification").alias("classification"),
        F.col("AccountType").alias("account_type"),
    )


def cast_date(spark, sf_dir):
    """Transactions per day, of every table that has a date."""
    ledger = landed(spark, sf_dir).ledger
    union = None
    for name in (t for t, columns in RAW_COLUMNS.items() if "txnDate" in columns):
        days = (
            ledger.table(name)
            .groupBy(F.lit(name).alias("table_name"), CLIENT, F.col("txnDate").cast("date").alias("txnDate"))
            .agg(F.count("*").alias("n_rows"))
        )
        union = days if union is None else union.unionByName(days)
    return union


def filter_account_types(spark, sf_dir):
    accounts = landed(spark, sf_dir).ledger.table("accounts")
    return accounts.filter(F.col("AccountType").isin(*JOURNAL_TYPES)).select(
        CLIENT, F.col("Id").alias("account_id"), F.col("AccountType").alias("account_type")
    )


def clean_budget_amounts(spark, sf_dir):
    sheet = landed(spark, sf_dir).sheet
    cells = [
        budget_cell(f"string_field_{FIRST_MONTH_FIELD + i}").alias(f"month_{i}")
        for i in range(N_MONTHS)
    ]
    return sheet.select(CLIENT, "string_field_1", *cells)


def split_account_path(spark, sf_dir):
    path = F.col("string_field_1")
    return landed(spark, sf_dir).sheet.select(
        CLIENT,
        path.alias("account_path"),
        path_head(path).alias("sub_account"),
        path_tail(path).alias("child_account"),
    )


def parse_month_label(spark, sf_dir):
    """Month labels of order dates, parsed back to the first of the month."""
    orders = read(spark, sf_dir, "orders")
    label = F.concat(F.lower(F.date_format("o_orderdate", "MMMyy")), F.lit("_budget"))
    return (
        orders.select(label.alias("month_label"))
        .select("month_label", month_start(F.col("month_label")).alias("budget_date"))
        .groupBy("month_label", "budget_date")
        .agg(F.count("*").alias("n_rows"))
    )


def entry_id_assign(spark, sf_dir):
    pnl = profit_and_loss(landed(spark, sf_dir).ledger)
    return pnl.select(entry_id().alias("entry_id"), *GRAIN)


def normalize_url(spark, sf_dir):
    """Sheet addresses made from page addresses, with ``/edit`` put before the query."""
    url = F.col("url")
    tail = F.regexp_extract(url, "[?#].*$", 0)
    editable = F.concat(F.regexp_extract(url, "^[^?#]*", 0), F.lit("/edit"), tail)
    return read(spark, sf_dir, "pages").select("page_id", sheet_address(editable).alias("url"))


def json_scalar_value(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    nested = F.concat(F.lit('{"outer":'), F.col("props"), F.lit("}")).alias("nested")
    # The same characters once as text and once as an array.
    listed = F.format_string('{"text":"[%d] x","array":[%d]}', "event_id", "event_id").alias("listed")
    return events.select("event_id", "props", nested, listed).select(
        "event_id",
        scalar_at("props", "$.k").alias("k"),
        scalar_at("props", "$.K").alias("other_case"),
        scalar_at("nested", "$.outer").alias("nested_object"),
        scalar_at("nested", "$.outer.k").alias("nested_k"),
        scalar_at("listed", "$.text").alias("bracketed_text"),
        scalar_at("listed", "$.array").alias("nested_array"),
    )


# JSON and arrays


def explode_json_lines(spark, sf_dir):
    """Lines per document, the ones with a reference and all, over all six kinds."""
    ledger = landed(spark, sf_dir).ledger
    union = None
    for name, detail in lines_op.REFERENCES.items():
        lines = lines_op.explode_lines(ledger.table(name), name, CLIENT)
        counts = lines.groupBy(CLIENT).agg(
            F.count("*").alias("n_lines"),
            F.count(f"line.{detail}.value").alias("n_references"),
        )
        counts = counts.select(F.lit(name).alias("table_name"), CLIENT, "n_lines", "n_references")
        union = counts if union is None else union.unionByName(counts)
    return union


def json_line_amounts(spark, sf_dir):
    """Lines of the transactions that post by themselves."""
    direct = [name for name, tables in lines_op.SOURCE_TABLES.items() if len(tables) == 1]
    lines = lines_op.all_lines(landed(spark, sf_dir).ledger, direct)
    return _doubles(lines.select("source", CLIENT, "txnDate", "ref_id", "amount"), "amount")


def first_linked_txn(spark, sf_dir):
    ledger = landed(spark, sf_dir).ledger
    paid = None
    for name in ("payments", "bill_payments"):
        rows = lines_op.linked_payments(ledger, name).select(
            F.lit(name).alias("table_name"),
            CLIENT,
            F.col("txnDate").cast("date").alias("txnDate"),
            "document_id",
            F.col("paid").cast("double").alias("paid"),
        )
        paid = rows if paid is None else paid.unionByName(rows)
    return paid


def _twice_refreshed(data):
    """A literal refresh, whose repeated rows give groups of several entries."""
    return blend_refresh(
        data.previous,
        pnl_rows(data.ledger),
        data.budget(),
        data.comments,
        "literal",
    )


def entry_ids_per_group(spark, sf_dir):
    grouped = comments_op.group_entries(_twice_refreshed(landed(spark, sf_dir)))
    grouped = grouped.withColumn("n_entries", F.size("entry_ids").cast("long"))
    grouped = grouped.withColumn("entry_ids", F.array_join("entry_ids", ","))
    return _doubles(grouped, "actual", "budget_amount")


def explode_entry_ids(spark, sf_dir):
    grouped = comments_op.group_entries(_twice_refreshed(landed(spark, sf_dir)))
    return grouped.select(*GRAIN, F.explode("entry_ids").alias("entry_id"))


def entry_ids_json(spark, sf_dir):
    grouped = comments_op.group_entries(_twice_refreshed(landed(spark, sf_dir)))
    return grouped.select(*GRAIN, F.to_json("entry_ids").alias("entry_ids_json"))


# Joins


def account_dim(spark, sf_dir):
    return accounts_op.account_dim(landed(spark, sf_dir).ledger.table("accounts"))


def join_line_account(spark, sf_dir):
    ledger = landed(spark, sf_dir).ledger
    direct = ("deposits", "purchases", "journal_entries")
    lines = lines_op.all_lines(ledger, direct).withColumnRenamed("ref_id", "account_id")
    joined = lines.join(
        accounts_op.account_dim(ledger.table("accounts")), [CLIENT, "account_id"]
    )
    return _doubles(
        joined.select(
            "source", CLIENT, "txnDate", "account_id", "account_name", "account_type", "amount"
        ),
        "amount",
    )


def join_line_item_account(spark, sf_dir):
    ledger = landed(spark, sf_dir).ledger
    lines = lines_op.sales_receipt_lines(ledger).withColumnRenamed("ref_id", "item_id")
    sold = accounts_op.resolve_items(
        ledger.table("items"), accounts_op.account_dim(ledger.table("accounts"))
    )
    joined = lines.join(sold, [CLIENT, "item_id"])
    return _doubles(
        joined.select(CLIENT, "txnDate", "item_id", "account_id", "account_name", "amount"),
        "amount",
    )


def _paid_documents(spark, sf_dir, payments_table, documents_table):
    paid = lines_op.paid_documents(landed(spark, sf_dir).ledger, payments_table, documents_table)
    return paid.select(CLIENT, "document_id", "txnDate", "TotalAmt", "paid").withColumnRenamed(
        "TotalAmt", "total"
    )


def join_payment_invoice(spark, sf_dir):
    return _paid_documents(spark, sf_dir, "payments", "invoices")


def join_billpayment_bill(spark, sf_dir):
    return _paid_documents(spark, sf_dir, "bill_payments", "bills")


def join_budget_account(spark, sf_dir):
    """Sheet rows with their account, and how many accounts share the name."""
    data = landed(spark, sf_dir)
    accounts = data.ledger.table("accounts")
    staged = data.sheet.select(CLIENT, path_head(F.col("string_field_1")).alias("sub_account"))
    shared = duplicate_account_names(accounts).withColumnRenamed("Name", "sub_account")
    return (
        staged.join(budget_accounts(accounts), [CLIENT, "sub_account"], "left")
        .join(shared, [CLIENT, "sub_account"], "left")
        .select(
            CLIENT, "sub_account", "parent_account", "classification", "account_type", "n_accounts"
        )
    )


# P&L


def hierarchy_flatten(spark, sf_dir):
    """Every account under each of the three layouts."""
    dim = accounts_op.account_dim(landed(spark, sf_dir).ledger.table("accounts"))
    layouts = F.array(*[F.lit(x) for x in (accounts_op.FULL, accounts_op.SHORT, accounts_op.MIXED)])
    each = dim.withColumn("layout", F.explode(layouts))
    return accounts_op.flatten_hierarchy(each, F.col("layout")).select(
        CLIENT, "account_id", "layout", *ACCOUNT_COLUMNS
    )


def _source_pnl(source):
    def query(spark, sf_dir):
        return _doubles(profit_and_loss(landed(spark, sf_dir).ledger, (source,)), "amount")

    return query


deposits_pl = _source_pnl("deposits")
purchases_pl = _source_pnl("purchases")
journal_entries_pl = _source_pnl("journal_entries")
payments_pl = _source_pnl("payments")
bill_payments_pl = _source_pnl("bill_payments")
sales_receipts_pl = _source_pnl("sales_receipts")


def prorate_payments(spark, sf_dir):
    """Paid share of each document and day."""
    data = landed(spark, sf_dir)
    union = None
    for payments, documents in (("payments", "invoices"), ("bill_payments", "bills")):
        paid = lines_op.paid_documents(data.ledger, payments, documents)
        rows = paid.select(
            F.lit(payments).alias("source"),
            CLIENT,
            "document_id",
            "txnDate",
            F.round(lines_op.paid_share(data.ledger), 4).alias("paid_share"),
        )
        union = rows if union is None else union.unionByName(rows)
    return union


def union_six_sources(spark, sf_dir):
    lines = lines_op.all_lines(landed(spark, sf_dir).ledger)
    sums = lines.groupBy(CLIENT, "source", "posting", "txnDate").agg(
        F.count("*").alias("n_lines"), F.sum("amount").alias("amount")
    )
    return _doubles(sums, "amount")


def p_l_view(spark, sf_dir):
    return _doubles(profit_and_loss(landed(spark, sf_dir).ledger), "amount")


def pl_sorted(spark, sf_dir):
    return newest_first(p_l_view(spark, sf_dir))


# Budget


def stage_budget_query(spark, sf_dir):
    return stage_budget(landed(spark, sf_dir).sheet)


def unpivot_budget(spark, sf_dir):
    return unpivot_months(stage_budget(landed(spark, sf_dir).sheet))


def budget_transformed(spark, sf_dir):
    data = landed(spark, sf_dir)
    return budget_long(stage_budget(data.sheet), data.ledger.table("accounts"))


# Marts


def _facts(df):
    return _doubles(df.drop("last_refreshed"), "actual", "budget_amount")


def blend_first_run(spark, sf_dir):
    data = landed(spark, sf_dir)
    return _facts(blend(pnl_rows(data.ledger), data.budget()))


def blend_refresh_query(spark, sf_dir):
    data = landed(spark, sf_dir)
    return _facts(blend_refresh(data.previous, pnl_rows(data.ledger), data.budget(), data.comments))


def blend_refresh_literal(spark, sf_dir):
    return _facts(_twice_refreshed(landed(spark, sf_dir)))


def latest_comment(spark, sf_dir):
    data = landed(spark, sf_dir)
    return comments_op.latest_comment(data.previous, data.comments)


def pl_with_comments(spark, sf_dir):
    data = landed(spark, sf_dir)
    facts = comments_op.with_comments(data.previous, data.comments)
    return comments_op.reading_order(_doubles(facts, "actual", "budget_amount"))


def pl_with_comments_literal(spark, sf_dir):
    data = landed(spark, sf_dir)
    facts = comments_op.with_comments(data.previous, data.comments, "literal")
    return _doubles(facts, "actual", "budget_amount")


MEASURES = tuple(
    f"{name}_{suffix}"
    for name in ("gross_profit", "net_profit", "net_cash")
    for suffix in ("actual", "budget")
)


def _stored(spark, sf_dir, table):
    """A table as the first refresh stored it."""
    return read_snapshot(spark, layer_path(landed(spark, sf_dir).reports, "marts", table), version=1)


def stored_profit(spark, sf_dir):
    """The end of the chain: facts, facts with comments and profit, each made from the one stored before."""
    return _doubles(_stored(spark, sf_dir, PROFIT), *MEASURES)


def profit_by_date(spark, sf_dir):
    return _doubles(profit(_stored(spark, sf_dir, COMMENTED), "date"), *MEASURES)


def profit_by_month(spark, sf_dir):
    return _doubles(profit(_stored(spark, sf_dir, COMMENTED), "month"), *MEASURES)


QUERIES = {
    "scan_budget_sheet": scan_budget_sheet,
    "slice_sheet_range": slice_sheet_range,
    "scan_ledger_tables": scan_ledger_tables,
    "table_exists_check": table_exists_check,
    "view_roundtrip": view_roundtrip,
    "table_roundtrip": table_roundtrip,
    "write_partitioned_by_client": write_partitioned_by_client,
    "comments_init": comments_init,
    "project_rename": project_rename,
    "cast_date": cast_date,
    "filter_account_types": filter_account_types,
    "clean_budget_amounts": clean_budget_amounts,
    "split_account_path": split_account_path,
    "parse_month_label": parse_month_label,
    "entry_id_assign": entry_id_assign,
    "normalize_url": normalize_url,
    "json_scalar_value": json_scalar_value,
    "explode_json_lines": explode_json_lines,
    "json_line_amounts": json_line_amounts,
    "first_linked_txn": first_linked_txn,
    "entry_ids_per_group": entry_ids_per_group,
    "explode_entry_ids": explode_entry_ids,
    "entry_ids_json": entry_ids_json,
    "account_dim": account_dim,
    "join_line_account": join_line_account,
    "join_line_item_account": join_line_item_account,
    "join_payment_invoice": join_payment_invoice,
    "join_billpayment_bill": join_billpayment_bill,
    "join_budget_account": join_budget_account,
    "hierarchy_flatten": hierarchy_flatten,
    "deposits_pl": deposits_pl,
    "purchases_pl": purchases_pl,
    "journal_entries_pl": journal_entries_pl,
    "prorate_payments": prorate_payments,
    "payments_pl": payments_pl,
    "bill_payments_pl": bill_payments_pl,
    "sales_receipts_pl": sales_receipts_pl,
    "union_six_sources": union_six_sources,
    "p_l_view": p_l_view,
    "pl_sorted": pl_sorted,
    "pl_by_client": pl_by_client,
    "stage_budget": stage_budget_query,
    "unpivot_budget": unpivot_budget,
    "budget_transformed": budget_transformed,
    "blend_first_run": blend_first_run,
    "blend_refresh": blend_refresh_query,
    "blend_refresh_literal": blend_refresh_literal,
    "latest_comment": latest_comment,
    "pl_with_comments": pl_with_comments,
    "pl_with_comments_literal": pl_with_comments_literal,
    "stored_profit": stored_profit,
    "profit_by_date": profit_by_date,
    "profit_by_month": profit_by_month,
}
