"""A ledger with budget sheets and comments, derived from the star-schema tables.

The raw accounting tables are landed once per session and data set, as an external
loader would, and every query reads them from there.  Landing goes to the shared
folder of the cluster (``spark.checkpoint.dir``); only without one and in local mode,
as in tests, to a temporary folder.

Each order lands as one document.  ``Line`` holds its order lines, a subtotal and a
note, neither with a reference; an order has a handful of lines, whatever the scale.
"""

import hashlib
import re
import tempfile
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from coffer.operators.blend import blend
from coffer.operators.budget import budget_long, stage_budget
from coffer.operators.pnl import pnl_rows
from coffer.plans.refresh import refresh
from coffer.schemas import CLIENT, FIRST_MONTH_FIELD, SHEET_COLUMNS
from coffer.sinks.snapshots import layer_path, read_snapshot, shuffles_released, write_snapshot
from coffer.sources.ledger import Ledger
from coffer.sources.sheet import SHEET_ROW, read_budget_sheet

N_CLIENTS = 5
N_MONTHS = 36
# Budget months of the blend queries, inside the range of order dates.
BLEND_START = "1998-01"
# Exact sums: results do not depend on the order rows arrive in.
AMOUNT_TYPE = "decimal(18,4)"

# Fixed values of the derived ledger.
ACCOUNT_TYPES = {
    "ECONOMY": "Income",
    "STANDARD": "Income",
    "SMALL": "Cost of Goods Sold",
    "MEDIUM": "Expense",
    "LARGE": "Equity",
    "PROMO": "Other Expense",
}
CLASSIFICATIONS = {"Income": "Revenue", "Equity": "Equity"}
DOCUMENT_KINDS = (
    "deposits",
    "purchases",
    "journal_entries",
    "invoices",
    "bills",
    "sales_receipts",
)
# In the previous version of the blend, everything booked on these days of a month stood
# a day later.  So a refresh over all sources meets new, changed and vanished rows.
LATE_DAYS = 5


def read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def client_of(number):
    return F.concat(F.lit("client_"), F.pmod(number, F.lit(N_CLIENTS)).cast("string"))


def _for_every_client(df):
    clients = F.array(*[F.lit(f"client_{i}") for i in range(N_CLIENTS)])
    return df.select(F.explode(clients).alias(CLIENT), "*")


def _lookup(column, values, default=None):
    result = F.lit(default)
    for key, value in values.items():
        result = F.when(column == key, F.lit(value)).otherwise(result)
    return result


def _json_ref(value):
    return F.to_json(F.struct(value.alias("value")))


def _type_id():
    return F.concat(F.lit("T:"), "p_type")


def _brand_id():
    return F.concat(F.lit("B:"), "p_type", F.lit("|"), "p_brand")


def _part_id():
    return F.concat(F.lit("P:"), F.col("p_partkey").cast("string"))


def _line_account():
    """Account of a part's lines: first, second or third level by part key."""
    level = F.col("p_partkey") % 3
    return F.when(level == 0, _type_id()).when(level == 1, _brand_id()).otherwise(_part_id())


def accounts(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    no_parent = F.lit(None).cast("string")
    level1 = part.select("p_type").distinct().select(
        _type_id().alias("Id"),
        F.col("p_type").alias("Name"),
        F.lit(False).alias("SubAccount"),
        no_parent.alias("ParentRef"),
        "p_type",
    )
    level2 = part.select("p_type", "p_brand").distinct().select(
        _brand_id().alias("Id"),
        F.concat_ws("/", "p_type", "p_brand").alias("Name"),
        F.lit(True).alias("SubAccount"),
        _json_ref(_type_id()).alias("ParentRef"),
        "p_type",
    )
    level3 = part.select(
        _part_id().alias("Id"),
        F.concat_ws("#", "p_name", F.col("p_partkey").cast("string")).alias("Name"),
        F.lit(True).alias("SubAccount"),
        _json_ref(_brand_id()).alias("ParentRef"),
        "p_type",
    )
    kind = _lookup(F.col("p_type"), ACCOUNT_TYPES)
    tree = level1.unionByName(level2).unionByName(level3)
    tree = tree.withColumn("AccountType", kind).drop("p_type")
    tree = tree.withColumn(
        "Classification", _lookup(F.col("AccountType"), CLASSIFICATIONS, "Expense")
    )
    return _for_every_client(tree)


def items(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return _for_every_client(
        part.select(
            F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("Id"),
            _json_ref(_line_account()).alias("IncomeAccountRef"),
        )
    )


def _kind_of(order_key):
    return _lookup(order_key % 6, dict(enumerate(DOCUMENT_KINDS)))


def orders_with_totals(spark, sf_dir):
    """Orders with kind of document and, for invoices and bills, the total."""
    lines = read(spark, sf_dir, "lineitem")
    totals = (
        lines.filter((F.col("l_orderkey") % 6).isin(3, 4))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("TotalAmt"))
    )
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        _kind_of(F.col("o_orderkey")).alias("table"),
        client_of(F.col("o_custkey")).alias(CLIENT),
        F.col("o_orderdate").cast("date").alias("txnDate"),
        "o_orderstatus",
    )
    return orders.join(totals, "o_orderkey", "left")


def booked_late(rows):
    """Rows as the previous version of the blend had them."""
    late = F.dayofmonth("txnDate") % LATE_DAYS == 0
    return rows.withColumn("txnDate", F.when(late, F.date_add("txnDate", 1)).otherwise(F.col("txnDate")))


def order_lines(spark, sf_dir):
    """The lines of each order with what they refer to: one row per order, dealt out by its key once."""
    key = F.col("l_orderkey")
    item = F.concat(F.lit("I"), F.col("p_partkey").cast("string"))
    refers_to_item = F.coalesce(_kind_of(key).isin("invoices", "sales_receipts"), F.lit(False))
    lines = read(spark, sf_dir, "lineitem").withColumn("p_partkey", F.col("l_partkey"))
    part = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    line = F.struct(
        "l_linenumber",
        "l_extendedprice",
        F.when(F.col("l_returnflag") == "R", "Credit").otherwise("Debit").alias("side"),
        F.when(refers_to_item, item).otherwise(_line_account()).alias("ref"),
    )
    return (
        lines.join(part, "p_partkey")
        .select(key.alias("o_orderkey"), line.alias("line"))
        .repartition("o_orderkey")
        .groupBy("o_orderkey")
        .agg(F.collect_list("line").alias("lines"))
    )


def documents(spark, sf_dir):
    """The six kinds of documents in one frame, all lines of an order in one document.

    Lines meet their order as one slim row per order; their text is made after that
    and goes straight to the files.
    """
    document = ["table", CLIENT, "o_orderkey", "txnDate", "o_orderstatus", "TotalAmt"]
    orders = orders_with_totals(spark, sf_dir).groupBy(*document).agg(F.count("*").cast("int").alias("n"))
    joined = orders.join(order_lines(spark, sf_dir), "o_orderkey")

    table = F.col("table")

    def written_line(line):
        account_ref = F.struct(F.struct(line["ref"].alias("value")).alias("AccountRef"))
        journal = F.struct(line["side"].alias("PostingType"), F.struct(line["ref"].alias("value")).alias("AccountRef"))
        item_ref = F.struct(F.struct(line["ref"].alias("value")).alias("ItemRef"))
        return F.struct(
            line["l_extendedprice"].alias("Amount"),
            F.when(table == "deposits", account_ref).alias("DepositLineDetail"),
            F.when(table.isin("purchases", "bills"), account_ref).alias("AccountBasedExpenseLineDetail"),
            F.when(table == "journal_entries", journal).alias("JournalEntryLineDetail"),
            F.when(table.isin("invoices", "sales_receipts"), item_ref).alias("SalesItemLineDetail"),
        )

    def item(line):
        return F.struct(line["l_linenumber"], line["l_extendedprice"], written_line(line).alias("line"))

    # An order that comes several times is one document with its lines as many times.
    lines = F.when(F.col("n") == 1, F.col("lines")).otherwise(F.flatten(F.array_repeat("lines", F.col("n"))))
    gathered = joined.select(*document, F.sort_array(F.transform(lines, item)).alias("items"))
    written = F.transform("items", lambda item: item["line"])
    total = F.aggregate("items", F.lit(0.0), lambda total, item: total + item["l_extendedprice"])
    subtotal = F.to_json(F.array(F.struct(total.alias("Amount"), F.lit("SubTotalLineDetail").alias("DetailType"))))
    note = '[{"Amount":null,"Description":"note"}]'
    # Arrays of differently shaped lines are joined as text, as the source systems mix them.
    text = F.concat_ws(",", *[F.substring(t, 2, F.length(t) - 2) for t in (F.to_json(written), subtotal, F.lit(note))])
    return gathered.select(
        "table",
        CLIENT,
        F.col("o_orderkey").cast("string").alias("Id"),
        F.col("txnDate").cast("string").alias("txnDate"),
        F.when(table == "purchases", F.col("o_orderstatus") == "P").alias("credit"),
        "TotalAmt",
        F.concat(F.lit("["), text, F.lit("]")).alias("Line"),
    )


def payments(spark, sf_dir):
    """Two payments, a quarter and a half of the total, per paid invoice or bill."""
    paid = orders_with_totals(spark, sf_dir).filter(
        F.col("TotalAmt").isNotNull() & (F.col("o_orderstatus") != "O")
    )
    second_after = F.when(F.col("o_orderstatus") == "P", F.lit(30)).otherwise(F.lit(60))
    instalments = F.array(
        F.struct(F.lit(0.25).alias("share"), F.lit(30).alias("days")),
        F.struct(F.lit(0.5).alias("share"), second_after.alias("days")),
    )
    rows = paid.select("*", F.explode(instalments).alias("part"))
    link = F.struct(F.col("o_orderkey").cast("string").alias("TxnId"))
    other = F.struct(F.lit("ignored").alias("TxnId"))
    first = F.struct(
        (F.col("TotalAmt") * F.col("part.share")).alias("Amount"),
        F.array(link, other).alias("LinkedTxn"),
    )
    second = F.struct(F.lit(1.0).alias("Amount"), F.array(other, link).alias("LinkedTxn"))
    return rows.select(
        F.when(F.col("table") == "invoices", "payments").otherwise("bill_payments").alias("table"),
        CLIENT,
        F.date_add("txnDate", F.col("part.days")).cast("string").alias("txnDate"),
        F.to_json(F.array(first, second)).alias("Line"),
    )


def sheet_rows(spark, sf_dir):
    """Budget sheets, a row per part, with the row number in the client's sheet."""
    key = F.col("p_partkey")
    level1, level2 = F.col("p_type"), F.concat_ws("/", "p_type", "p_brand")
    level3 = F.concat_ws("#", "p_name", key.cast("string"))
    path = (
        F.when(key % 4 == 0, level1)
        .when(key % 4 == 1, level2)
        .when(key % 4 == 2, F.concat(level3, F.lit(":kid")))
        .otherwise(F.concat(F.lit("none:"), level3))
    )
    unused = F.lit(None).cast("string")

    def cell(month):
        value = (key * 37 + 101 * month) % 4000
        return F.when(value % 7 == 0, F.lit("-")).otherwise(F.format_number(value, 0))

    cells = [level1, path] + [unused] * (FIRST_MONTH_FIELD - 2) + [cell(i) for i in range(N_MONTHS)]
    return read(spark, sf_dir, "part").select(
        client_of(key).alias(CLIENT),
        (F.floor(key / N_CLIENTS) + 1).alias(SHEET_ROW),
        *[c.alias(f"string_field_{i}") for i, c in enumerate(cells[:SHEET_COLUMNS])],
    )


def comments(spark, sf_dir, facts):
    """Conversations as comments on the first entry of a client's day."""
    entries = facts.groupBy(CLIENT, "txnDate").agg(F.min("entry_id").alias("entry_id"))
    conv, turn = F.col("conv_id"), F.col("turn")
    start = F.lit("2025-01-01").cast("timestamp")
    written = start + F.make_interval(days=F.floor(turn / 2).cast("int"))
    talk = read(spark, sf_dir, "conversations").select(
        client_of(conv).alias(CLIENT),
        F.date_add(F.lit("1995-01-01").cast("date"), (conv * 7 % 2400).cast("int")).alias("txnDate"),
        F.concat_ws("-", conv.cast("string"), turn.cast("string")).alias("comment_id"),
        F.when(turn % 3 != 2, F.col("text")).alias("comment_text"),
        F.col("role").alias("created_by"),
        F.when((turn != 0) | (conv % 2 != 0), written).alias("created_at"),
        written.alias("updated_at"),
    )
    return talk.join(entries, [CLIENT, "txnDate"]).select(
        CLIENT, "comment_id", "entry_id", "comment_text", "created_by", "created_at", "updated_at"
    )


@dataclass(frozen=True)
class Landed:
    """The derived data set of one session, landed step by step as queries need it."""

    spark: SparkSession
    sf_dir: str
    base: str

    @cached_property
    def ledger(self):
        # A new folder each time: a landing that failed half-way is not added to.
        root = self.fresh("raw")
        by = ("table", CLIENT)
        # Few tables and clients: tasks write what they hold, so no text is dealt out again.
        frames = [
            documents(self.spark, self.sf_dir),
            payments(self.spark, self.sf_dir),
            accounts(self.spark, self.sf_dir).withColumn("table", F.lit("accounts")).hint("rebalance", *by),
            items(self.spark, self.sf_dir).withColumn("table", F.lit("items")).hint("rebalance", *by),
        ]
        with shuffles_released(self.spark):
            for frame in frames:
                frame.write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(root)
        return Ledger(
            self.spark, root, layout="{root}/table={table}", amount_type=AMOUNT_TYPE
        )

    @cached_property
    def sheet_path(self):
        path = self.fresh("budget_template")
        rows = sheet_rows(self.spark, self.sf_dir).drop(SHEET_ROW).hint("rebalance", CLIENT)
        with shuffles_released(self.spark):
            rows.write.partitionBy(CLIENT).option("header", True).csv(path)
        return path

    @property
    def sheet(self):
        return read_budget_sheet(self.spark, self.sheet_path, malformed="mark")

    @cached_property
    def tab_path(self):
        """Whole spreadsheet tabs, one file per client, as an export writes them."""
        path = self.fresh("budget_tabs")
        rows = sheet_rows(self.spark, self.sf_dir).repartition(CLIENT).sortWithinPartitions(CLIENT, SHEET_ROW)
        with shuffles_released(self.spark):
            rows.drop(SHEET_ROW).write.partitionBy(CLIENT).csv(path)
        return path

    def budget(self, start=BLEND_START):
        staged = stage_budget(self.sheet, start, N_MONTHS, AMOUNT_TYPE)
        return budget_long(staged, self.ledger.table("accounts"))

    @cached_property
    def marts(self):
        return f"{self.base}/reports"

    @cached_property
    def _previous_path(self):
        path = layer_path(self.marts, "marts", "previous_blend")
        write_snapshot(blend(booked_late(pnl_rows(self.ledger)), self.budget()), path, even=False)
        return path

    @property
    def previous(self):
        return read_snapshot(self.spark, self._previous_path)

    @cached_property
    def _comments_path(self):
        path = layer_path(self.marts, "marts", "comments")
        write_snapshot(comments(self.spark, self.sf_dir, self.previous), path)
        return path

    @property
    def comments(self):
        return read_snapshot(self.spark, self._comments_path)

    @cached_property
    def reports(self):
        """Root of the stored reports, after a first refresh of all clients: version 1 of each table."""
        root = self.fresh("refreshed")
        refresh(self.ledger, self.sheet, root, start=BLEND_START)
        return root

    def fresh(self, name):
        """A new place for a query that writes."""
        return f"{self.base}/{name}-{uuid.uuid4().hex}"


_landed = {}


def _own_folder(spark):
    """A folder of one's own, in local mode alone: on a cluster no other machine would see it."""
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="coffer-")


def landed(spark, sf_dir):
    """The landed data of this session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        root = spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark)
        name = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
        base = f"{root}/coffer-{key[0]}-{name}-{uuid.uuid4().hex[:8]}"
        _landed[key] = Landed(spark, sf_dir, base)
    return _landed[key]
