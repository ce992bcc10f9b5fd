import pytest

from books import rows
from coffer.operators.profit import profit

FACTS = [
    ("c", "2025-01-01", "Income", 0.0, 100.0),
    ("c", "2025-01-15", "Income", 50.0, 0.0),
    ("c", "2025-01-15", "Cost of Goods Sold", 20.0, 0.0),
    ("c", "2025-01-15", "Expense", 5.0, 0.0),
    ("c", "2025-01-15", "Other Expense", 2.0, 0.0),
    ("c", "2025-01-15", None, 1.0, 0.0),
    ("d", "2025-01-15", "Expense", 7.0, 3.0),
]
MEASURES = ("gross_profit_actual", "gross_profit_budget", "net_profit_actual",
            "net_profit_budget", "net_cash_actual", "net_cash_budget")


@pytest.fixture
def facts(spark):
    schema = "client string, txnDate string, account_type string, actual double, budget_amount double"
    df = spark.createDataFrame(FACTS, schema)
    return df.withColumn("txnDate", df.txnDate.cast("date"))


def test_by_date(facts):
    assert rows(profit(facts), "client", "txnDate", *MEASURES) == [
        ("c", "2025-01-01", 0.0, 100.0, 0.0, 100.0, 0.0, 100.0),
        ("c", "2025-01-15", 30.0, 0.0, 25.0, 0.0, 22.0, 0.0),
        ("d", "2025-01-15", 0.0, 0.0, -7.0, -3.0, -7.0, -3.0),
    ]


def test_by_month_brings_actual_and_budget_together(facts):
    assert rows(profit(facts, "month"), "client", "txnDate", *MEASURES) == [
        ("c", "2025-01-01", 30.0, 100.0, 25.0, 100.0, 22.0, 100.0),
        ("d", "2025-01-01", 0.0, 0.0, -7.0, -3.0, -7.0, -3.0),
    ]


def test_unknown_grain(facts):
    with pytest.raises(ValueError):
        profit(facts, "year")
