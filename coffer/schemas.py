"""Column contracts of the raw tables and of the produced tables.

Every table carries ``client`` as its leading column: tenants are rows, not
datasets, so that one Spark job serves all of them.
"""

from pyspark.sql import types as T

CLIENT = "client"

# Grain of every fact table after ``client``.
ACCOUNT_COLUMNS = (
    "parent_account",
    "sub_account",
    "child_account",
    "classification",
    "account_type",
)
GRAIN = (CLIENT, "txnDate") + ACCOUNT_COLUMNS

# Raw columns and the type each one is read as.  ``None`` keeps the stored type
# (exports land ``txnDate`` as text, date or timestamp, and totals as any number).
RAW_COLUMNS = {
    "accounts": {
        "Id": "string",
        "Name": "string",
        "Classification": "string",
        "AccountType": "string",
        "SubAccount": "boolean",
        "ParentRef": "string",
    },
    "items": {"Id": "string", "IncomeAccountRef": "string"},
    "deposits": {"txnDate": None, "Line": "string"},
    "purchases": {"txnDate": None, "credit": "boolean", "Line": "string"},
    "journal_entries": {"txnDate": None, "Line": "string"},
    "invoices": {"Id": "string", "TotalAmt": None, "Line": "string"},
    "payments": {"txnDate": None, "Line": "string"},
    "bills": {"Id": "string", "TotalAmt": None, "Line": "string"},
    "bill_payments": {"txnDate": None, "Line": "string"},
    "sales_receipts": {"txnDate": None, "Line": "string"},
}

# JSON element of the ``Line`` array.  Every leaf is text: exports write numbers
# both bare and quoted, and only text accepts the two.
_REF = "STRUCT<value: STRING>"
LINE_ELEMENTS = {
    "deposits": f"STRUCT<Amount: STRING, DepositLineDetail: STRUCT<AccountRef: {_REF}>>",
    "purchases": f"STRUCT<Amount: STRING, AccountBasedExpenseLineDetail: STRUCT<AccountRef: {_REF}>>",
    "bills": f"STRUCT<Amount: STRING, AccountBasedExpenseLineDetail: STRUCT<AccountRef: {_REF}>>",
    "journal_entries": (
        "STRUCT<Amount: STRING, JournalEntryLineDetail: "
        f"STRUCT<PostingType: STRING, AccountRef: {_REF}>>"
    ),
    "invoices": f"STRUCT<Amount: STRING, SalesItemLineDetail: STRUCT<ItemRef: {_REF}>>",
    "sales_receipts": f"STRUCT<Amount: STRING, SalesItemLineDetail: STRUCT<ItemRef: {_REF}>>",
    "payments": "STRUCT<Amount: STRING, LinkedTxn: ARRAY<STRUCT<TxnId: STRING>>>",
    "bill_payments": "STRUCT<Amount: STRING, LinkedTxn: ARRAY<STRUCT<TxnId: STRING>>>",
}

COMMENTS = T.StructType(
    [
        T.StructField(CLIENT, T.StringType()),
        T.StructField("comment_id", T.StringType()),
        T.StructField("entry_id", T.StringType()),
        T.StructField("comment_text", T.StringType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

SHEET_COLUMNS = 45
FIRST_MONTH_FIELD = 9


def sheet_schema(n_columns=SHEET_COLUMNS):
    """Positional text columns of a spreadsheet export."""
    return T.StructType(
        [T.StructField(f"string_field_{i}", T.StringType()) for i in range(n_columns)]
    )
