"""Gross profit, net profit and net cash, actual and budget."""

from pyspark.sql import functions as F

from coffer.schemas import CLIENT

COST_TYPES = ("Cost of Goods Sold",)
EXPENSE_TYPES = ("Cost of Goods Sold", "Expense")


def _measures(value, suffix):
    kind = F.col("account_type")
    amount = F.col(value)
    nothing = F.lit(0)
    income = F.sum(F.when(kind == "Income", amount).otherwise(nothing))
    cost = F.sum(F.when(kind.isin(*COST_TYPES), amount).otherwise(nothing))
    expense = F.sum(F.when(kind.isin(*EXPENSE_TYPES), amount).otherwise(nothing))
    # Everything that is not income, accounts without a type included.
    outflow = F.sum(F.when(kind == "Income", nothing).otherwise(amount))
    return {
        f"gross_profit_{suffix}": income - cost,
        f"net_profit_{suffix}": income - expense,
        f"net_cash_{suffix}": income - outflow,
    }


def profit(facts, grain="date"):
    """Six measures per client and date, or per client and month.

    Comments never change amounts, so the blend serves as well as the commented
    facts and spares their join; so do stacked rows of P&L and budget, which spare
    the blend's aggregation over the whole account hierarchy.

    Amounts add up per day and account type first: two plain sums per row, and the
    conditional sums see a few rows per day.
    """
    if grain == "date":
        day = F.col("txnDate")
    elif grain == "month":
        day = F.trunc("txnDate", "MM")
    else:
        raise ValueError(f"unknown grain {grain!r}")
    measures = {**_measures("actual", "actual"), **_measures("budget_amount", "budget")}
    columns = [
        f"{name}_{suffix}"
        for name in ("gross_profit", "net_profit", "net_cash")
        for suffix in ("actual", "budget")
    ]
    by_type = facts.groupBy(CLIENT, day.alias("txnDate"), "account_type").agg(
        F.sum("actual").alias("actual"), F.sum("budget_amount").alias("budget_amount")
    )
    return by_type.groupBy(CLIENT, "txnDate").agg(
        *[measures[name].alias(name) for name in columns]
    )
