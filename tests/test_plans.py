"""What the plans must look like, on parquet files."""

import re

import pytest
from pyspark.sql import functions as F

from books import DAY, RAW, account, deposit, expense, lines, no_budget, paid, ref, sale
from coffer.operators.blend import blend, blend_refresh
from coffer.operators.comments import empty_comments, latest_comment, with_comments
from coffer.operators.pnl import JOURNAL_TYPES, pnl_rows, profit_and_loss
from coffer.operators.profit import profit
from coffer.sources.ledger import Ledger



@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    data = {
        "accounts": [account("a", "Income", client="007"), account("b", parent="a", client="007")],
        "items": [("007", "i", ref("a"))],
        "deposits": [("007", DAY, lines(deposit("a", 1)))],
        "purchases": [("007", DAY, True, lines(expense("b", 1)))],
        "invoices": [("007", "1", 2.0, lines(sale("i", 2)))],
        "payments": [("007", DAY, lines(paid(1, "1")))],
        "bills": [("007", "1", 2.0, lines(expense("b", 2)))],
        "bill_payments": [("007", DAY, lines(paid(1, "1")))],
    }
    for name, schema in RAW.items():
        rows = data.get(name, [("008",) + (None,) * schema.count(",")])
        df = spark.createDataFrame(rows, schema).withColumn("unused", F.lit("x"))
        df.write.partitionBy("client").parquet(f"{root}/{name}")
    return Ledger(spark, root)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def text(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_client_names_stay_text(ledger):
    assert [r.client for r in ledger.table("deposits").collect()] == ["007"]


def test_no_python_and_no_cartesian_work(ledger, spark):
    facts = blend(pnl_rows(ledger), no_budget(spark))
    frames = [
        profit_and_loss(ledger), facts, with_comments(facts, empty_comments(spark)), profit(facts, "month"),
        blend_refresh(facts, pnl_rows(ledger), no_budget(spark), empty_comments(spark)),
    ]
    for frame in frames:
        shown = plan(frame)
        assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", shown)


def test_pnl_shuffles(ledger):
    """One account join, broadcast while small, and two shuffles besides the payments'."""
    shown = plan(profit_and_loss(ledger, ("deposits", "purchases")))
    assert shown.count("Exchange hashpartitioning") == 2
    assert "BroadcastHashJoin" in shown and "SortMergeJoin" not in shown


def test_account_join_beyond_the_broadcast_limit(ledger, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(profit_and_loss(ledger))
        assert "BroadcastHashJoin" not in shown and "SortMergeJoin" in shown
        assert profit_and_loss(ledger).count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_what_is_used(ledger):
    shown = text(profit_and_loss(ledger))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", shown)
    assert schemas and not any("unused" in s for s in schemas)
    pruned = text(profit_and_loss(ledger.with_options(clients=("007",))))
    assert len(re.findall(r"PartitionFilters: \[.*client#\d+ = 007", pruned)) == pruned.count("ReadSchema")


def test_filters_reach_the_scan(ledger):
    shown = text(ledger.table("accounts").filter(F.col("AccountType").isin(*JOURNAL_TYPES)))
    assert "PushedFilters: [In(AccountType" in shown


@pytest.mark.parametrize("source", ["deposits", "purchases", "payments", "bill_payments"])
def test_each_document_is_parsed_once(ledger, source):
    shown = plan(profit_and_loss(ledger, (source,)))
    tables = 2 if source.endswith("payments") else 1
    assert shown.count("from_json(ArrayType(StructType") == tables


def test_money_is_aggregated_before_the_account_join(ledger):
    lines_ = plan(profit_and_loss(ledger, ("deposits",))).splitlines()
    join = next(i for i, s in enumerate(lines_) if "BroadcastHashJoin" in s)
    generate = next(i for i, s in enumerate(lines_) if "Generate explode" in s)
    between = "\n".join(lines_[join:generate])
    assert between.count("HashAggregate") == 2


@pytest.mark.parametrize("mode", ["intended", "literal"])
def test_refresh_computes_and_moves_its_facts_once(ledger, spark, mode):
    previous = blend(pnl_rows(ledger, ("purchases",)), no_budget(spark))
    facts = pnl_rows(ledger, ("deposits",))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(blend_refresh(previous, facts, no_budget(spark), empty_comments(spark), mode))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One parse of the deposits, and one of the purchases that the previous version is made of here.
    assert shown.count("from_json(ArrayType(StructType") == 2
    assert shown.count("FullOuter") == 1
    if mode == "intended":
        # The facts' sums and the previous rows are dealt out by the grain, and so they are joined.
        assert len(re.findall(r"Exchange hashpartitioning\((?:old_grain|grain|_groupingexpression)#", shown)) == 2
        assert "collect_set" not in shown


def test_literal_refresh_deals_out_facts_without_an_entry(ledger, spark):
    """All of them have no entry id: as one key they would be one task's work."""
    facts = pnl_rows(ledger, ("deposits",))
    previous = blend(pnl_rows(ledger, ("purchases",)), no_budget(spark))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(blend_refresh(previous, facts, no_budget(spark), empty_comments(spark), "literal"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"Exchange hashpartitioning\(client#\d+, entry_key#", shown)


def test_latest_comment_sorts_no_facts(ledger, spark):
    facts = blend(pnl_rows(ledger), no_budget(spark))
    shown = plan(latest_comment(facts, empty_comments(spark)))
    grouped = [line for line in shown.splitlines() if "SortAggregate" in line]
    assert grouped and all("commented" in line or "entry_id" in line for line in grouped)


def unbroadcast(spark, make):
    """The plan of a frame made where nothing is small enough to be broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(make())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_refresh_moves_no_previous_rows_for_their_comments(ledger, spark):
    """They meet the comments after the facts, when the planner knows how few entries are commented."""
    facts = pnl_rows(ledger, ("deposits",))
    previous = blend(pnl_rows(ledger, ("purchases",)), no_budget(spark))
    shown = unbroadcast(spark, lambda: blend_refresh(previous, facts, no_budget(spark), empty_comments(spark)))
    lines_ = shown.splitlines()
    outer = next(i for i, s in enumerate(lines_) if "FullOuter" in s)
    # That of the comments alone; before it, one of the previous rows came beside it.
    assert sum(bool(re.search(r"Exchange hashpartitioning\([^)]*(entry|looked)_id#", s)) for s in lines_[outer:]) == 1


def test_literal_refresh_deals_out_both_sides_once(ledger, spark):
    """What the facts are dealt out by for their sums serves the join."""
    facts = pnl_rows(ledger, ("deposits",))
    previous = blend(pnl_rows(ledger, ("purchases",)), no_budget(spark))
    make = lambda: blend_refresh(previous, facts, no_budget(spark), empty_comments(spark), "literal")
    shown = unbroadcast(spark, make)
    assert len(re.findall(r"Exchange hashpartitioning\(place#", shown)) == 2
    outer = next(s for s in shown.splitlines() if "FullOuter" in s)
    assert re.search(r"\[place#\d+\], \[place#\d+\]", outer)


def test_literal_comments_deal_out_facts_once(ledger, spark):
    facts = blend(pnl_rows(ledger, ("deposits",)), no_budget(spark))
    shown = unbroadcast(spark, lambda: with_comments(facts, empty_comments(spark), "literal"))
    by_key = re.findall(r"Exchange hashpartitioning\(client#\d+, txnDate#\d+, parent_account#[^)]*\), REPARTITION_BY_COL", shown)
    assert len(by_key) == 1
    # Above it nothing is dealt out again.
    assert "Exchange" not in shown.split(by_key[0])[0]


def test_only_entries_that_may_have_comments_move_to_them(ledger, spark):
    facts = blend(pnl_rows(ledger, ("deposits",)), no_budget(spark))
    lines_ = unbroadcast(spark, lambda: latest_comment(facts, empty_comments(spark))).splitlines()
    moved = next(i for i, s in enumerate(lines_) if re.search(r"Exchange hashpartitioning\(client#\d+, entry_id#", s))
    assert any("BroadcastHashJoin" in s for s in lines_[moved + 1 : moved + 4])
