from pyspark.sql import functions as F

from books import account, ledger, rows
from coffer.operators.budget import (
    budget_long,
    duplicate_account_names,
    month_columns,
    stage_budget,
    unpivot_months,
)
from coffer.schemas import SHEET_COLUMNS
from coffer.sources.sheet import read_budget_sheet, slice_range


def sheet(spark, *accounts, client="c", cells=("1,000", "-", "x", "5")):
    """Sheet rows whose first months hold ``cells``."""
    data = []
    for path in accounts:
        row = ["parent text", path] + ["skipped"] * 7 + list(cells)
        data.append(tuple([client] + row + [None] * (SHEET_COLUMNS - len(row))))
    schema = "client string, " + ", ".join(f"string_field_{i} string" for i in range(SHEET_COLUMNS))
    return spark.createDataFrame(data, schema)


def test_staging_names_and_cleans(spark):
    staged = stage_budget(sheet(spark, "A:B"))
    assert staged.columns[:4] == ["client", "parent_account", "sub_account", "child_account"]
    assert len(month_columns(staged)) == 36 and staged.columns[4] == "jan25_budget"
    assert rows(staged, "sub_account", "child_account", "jan25_budget", "feb25_budget", "mar25_budget", "apr25_budget") == [
        ("A", "B", 1000.0, None, None, 5.0),
    ]


def test_unpivot_drops_empty_months(spark):
    staged = stage_budget(sheet(spark, "A"), start="2026-12", n_months=4)
    assert rows(unpivot_months(staged), "budget_date", "budget_amount") == [
        ("2026-12-01", 1000.0), ("2027-03-01", 5.0),
    ]


def test_account_attributes(spark):
    accounts = ledger(spark, accounts=[
        account("1", "Income", name="A"), account("2", "Income", parent="1", name="B"),
        account("3", "Expense", parent="gone", name="C"),
        account("4", "Expense", name="twice"), account("5", "Income", name="twice"),
        account("6", "Equity", name="Z", client="d"),
    ]).table("accounts")
    staged = stage_budget(sheet(spark, "A", "B:kid", "C", "twice", "none", "Z", cells=("7",)))
    result = budget_long(staged, accounts)
    assert rows(result, "sub_account", "child_account", "parent_account", "account_type", "budget_amount") == [
        ("A", None, "Income", "Income", 7.0),
        ("B", "kid", "A", "Income", 7.0),
        ("C", None, "Expense", "Expense", 7.0),
        ("Z", None, None, None, 7.0),
        ("none", None, None, None, 7.0),
        ("twice", None, "Expense", "Expense", 7.0),
        ("twice", None, "Income", "Income", 7.0),
    ]
    assert rows(duplicate_account_names(accounts)) == [("c", "twice", 2)]


def test_slice_range(spark):
    df = sheet(spark, *[f"r{i}" for i in range(1, 8)]).withColumn(
        "sheet_row", F.substring("string_field_1", 2, 2).cast("int"))
    cut = slice_range(df, 3, 5, 1, 2)
    assert cut.columns == ["client", "sheet_row", "string_field_0", "string_field_1"]
    assert rows(cut, "sheet_row", "string_field_0") == [(3, "r3"), (4, "r4"), (5, "r5")]


def write_csv(path, rows_):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(",".join(f'"{c}"' for c in r) for r in rows_) + "\n")


def test_read_sheet_drops_first_row_of_each_client(spark, tmp_path):
    header = [f"h{i}" for i in range(SHEET_COLUMNS)]
    row = lambda name: [name, f"{name}:x"] + [""] * 7 + ["1,5"] * 36
    write_csv(tmp_path / "client=007" / "s.csv", [header, row("A"), row("B")])
    write_csv(tmp_path / "client=c" / "s.csv", [header, row("C")])
    df = read_budget_sheet(spark, str(tmp_path))
    assert rows(df, "client", "string_field_0", "string_field_44") == [
        ("007", "A", "1,5"), ("007", "B", "1,5"), ("c", "C", "1,5"),
    ]


def test_read_sheet_range_of_a_whole_tab(spark, tmp_path):
    title = [["title"] + [""] * 49, ["two\nlines"] + [""] * 49, [""] * 50]
    body = [[f"r{r}c{c}" for c in range(50)] for r in range(4, 90)]
    for client in ("c", "d"):
        write_csv(tmp_path / f"client={client}" / "s.csv", title + body)
    df = read_budget_sheet(spark, str(tmp_path), "Budget Summary!A4:AS69")
    assert len(df.columns) == 46
    assert df.groupBy("client").count().collect()[0][1] == 65
    ends = df.agg(F.min("string_field_0"), F.max("string_field_44"), F.count("*")).first()
    assert tuple(ends) == ("r10c0", "r9c44", 130)
    assert df.filter("string_field_0 in ('r4c0', 'r70c0')").count() == 0
    shifted = read_budget_sheet(spark, str(tmp_path), "B5:C6", skip_leading_rows=0)
    assert rows(shifted, "client", "string_field_0", "string_field_1")[:2] == [
        ("c", "r5c1", "r5c2"), ("c", "r6c1", "r6c2"),
    ]
