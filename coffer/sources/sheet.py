"""Budget spreadsheets exported as CSV, one file per client.

Rows with more or fewer cells than they should have are read as far as they go and
marked in ``malformed``: shifted cells would otherwise pass for empty months.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from coffer.functions.text import parse_range
from coffer.schemas import CLIENT, SHEET_COLUMNS, sheet_schema

SHEET_ROW = "sheet_row"
MALFORMED = "malformed"
_RECORD = "_record"


def slice_range(df, first_row, last_row, first_col, last_col, row_column=SHEET_ROW):
    """Cells of a row and column window, columns renumbered from zero.

    Rows are found by ``row_column``, counted from one as in a spreadsheet;
    columns are positions among the ``string_field_*`` columns.
    """
    fields = [c for c in df.columns if c.startswith("string_field_")]
    carried = [c for c in df.columns if c not in fields and c != row_column]
    window = fields[first_col : last_col + 1]
    if len(window) < last_col - first_col + 1:
        raise ValueError(f"range needs {last_col + 1} columns, sheet has {len(fields)}")
    cells = [F.col(c).alias(f"string_field_{i}") for i, c in enumerate(window)]
    return df.filter(F.col(row_column).between(first_row, last_row)).select(
        *carried, row_column, *cells
    )


def _reader(spark, path, n_columns):
    """CSV reader and schema; the text of a record with another number of cells goes to its own column."""
    schema = _with_client(spark, path, sheet_schema(n_columns)).add(_RECORD, "string")
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", _RECORD).schema(schema)


def _cells(n_columns):
    """Number of cells of a record: commas outside of quotes, and one."""
    # Spark refuses to read records without any cell, so the first one comes along and adds nothing.
    nothing = F.least(F.lit(0), F.length(F.coalesce("string_field_0", F.lit(""))))
    bare = F.regexp_replace(_RECORD, r'"(?:[^"]|"")*"', "")
    counted = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return F.when(F.col(_RECORD).isNull(), F.lit(n_columns)).otherwise(counted) + nothing


def read_sheet_rows(spark, path, n_columns=SHEET_COLUMNS):
    """Every row of the exports with its row number within its file.

    A multi-line CSV file is never split, so reading order is file order; the
    window holds one spreadsheet file, whose size the spreadsheet format bounds.
    A row is malformed if it has another number of cells than its file's first row.
    """
    numbered = _reader(spark, path, n_columns).csv(path).withColumns(
        {"_file": F.col("_metadata.file_path"), "_position": F.monotonically_increasing_id()}
    )
    by_file = Window.partitionBy("_file").orderBy("_position")
    cells = _cells(n_columns)
    return (
        numbered.withColumns({SHEET_ROW: F.row_number().over(by_file), MALFORMED: cells})
        .withColumn(MALFORMED, F.col(MALFORMED) != F.first(MALFORMED).over(by_file))
        .drop("_file", "_position", _RECORD)
    )


def read_budget_sheet(
    spark, path, sheet_range=None, skip_leading_rows=1, keep_rows=False, malformed="raise"
):
    """Budget cells as text columns ``string_field_0 ...``.

    Without ``sheet_range`` the files hold just the range, of 45 columns, and their
    first row is dropped as a header.  With one (``Tab!A4:AS69``) the files hold the
    whole tab, of any width.  ``keep_rows`` adds the row number within the tab.

    A row with too few or too many cells fails the query that reads it;
    ``malformed="mark"`` adds a column that marks it instead, by which a refresh holds
    back its client alone.
    """
    if malformed not in ("raise", "mark"):
        raise ValueError(f"unknown way with malformed rows {malformed!r}")
    cells = _range_of(spark, path, sheet_range, skip_leading_rows, keep_rows)
    if malformed == "mark":
        return cells
    complaint = F.raise_error(F.lit(f"sheet row with another number of cells under {path}"))
    return cells.filter(F.when(F.col(MALFORMED), complaint.cast("boolean")).otherwise(F.lit(True))).drop(MALFORMED)


def _range_of(spark, path, sheet_range, skip_leading_rows, keep_rows):
    if sheet_range is None and skip_leading_rows == 1 and not keep_rows:
        # An explicit schema names the columns; the header option drops row one.
        cells = _reader(spark, path, SHEET_COLUMNS).option("header", True).csv(path)
        return cells.withColumn(MALFORMED, _cells(SHEET_COLUMNS) != SHEET_COLUMNS).drop(_RECORD)
    if sheet_range is None:
        first_row, last_row, first_col, last_col = 1, 2**31 - 1, 0, SHEET_COLUMNS - 1
    else:
        _, first_row, last_row, first_col, last_col = parse_range(sheet_range)
    rows = read_sheet_rows(spark, path, last_col + 1)
    cells = slice_range(rows, first_row + skip_leading_rows, last_row, first_col, last_col)
    return cells if keep_rows else cells.drop(SHEET_ROW)


def _with_client(spark, path, schema):
    """Add the client partition column when the directory is laid out by client."""
    partitions = spark.read.format("binaryFile").load(path).schema.names
    return schema.add(CLIENT, "string") if CLIENT in partitions else schema
