"""The derived ledger and its queries, on rows of their own."""

import json
from datetime import datetime

from testbed.derive import documents
from testbed.queries import QUERIES

DAY = datetime(1998, 3, 4)


def tables(spark, path, orders, lines, parts):
    """A data set of the tables that the raw ledger is derived from."""
    frames = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"),
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_returnflag string",
        ),
        "part": (parts, "p_partkey long, p_name string, p_type string, p_brand string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


PARTS = [(1, "nut", "SMALL", "b1"), (2, "bolt", "LARGE", "b2"), (3, "cap", "ECONOMY", "b1")]


def test_a_scan_reads_every_line(spark, tmp_path):
    orders = [(key, 6 if key == 3 else 5, "F", DAY) for key in range(6)]
    lines = [(0, 1, 1, 1.0, "N"), (0, 2, 2, 2.0, "N"), (0, 3, 3, 3.0, "R"), (1, 1, 1, 4.0, "N"), (3, 2, 1, 5.0, "N")]
    lines += [(key, 1, n, 1.0, "N") for key in (2, 4, 5) for n in (1, 2)]
    sf_dir = tables(spark, tmp_path, orders, lines, PARTS)
    rows = {(r.table_name, r.client): r.n_rows for r in QUERIES["scan_ledger_tables"](spark, sf_dir).collect()}
    assert rows[("deposits", "client_0")] == 3
    assert rows[("purchases", "client_0")] == 1
    assert rows[("invoices", "client_1")] == 1
    assert rows[("sales_receipts", "client_0")] == 2
    assert rows[("payments", "client_1")] == 2


def test_documents_are_dealt_out_by_order_alone(spark, tmp_path):
    """Lines move by part and by order, never as the text of their documents."""
    orders = [(0, 5, "F", DAY), (0, 5, "F", DAY), (2, 5, "F", DAY)]
    lines = [(0, 2, 2, 2.0, "N"), (0, 1, 1, 1.0, "N"), (2, 3, 1, 4.0, "R")]
    sf_dir = tables(spark, tmp_path, orders, lines, PARTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = documents(spark, sf_dir)
        shown = frame._jdf.queryExecution().executedPlan().toString()
        rows = {r.Id: [x["Amount"] for x in json.loads(r.Line)] for r in frame.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning(table" not in shown
    # An order that comes twice has each line twice, then the subtotal and the note.
    assert rows == {"0": [1.0, 1.0, 2.0, 2.0, 6.0, None], "2": [4.0, 4.0, None]}
