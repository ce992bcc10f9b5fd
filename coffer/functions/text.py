"""Text clean-up: budget cells, account paths, month labels, sheet addresses."""

import datetime
import re

from pyspark.sql import functions as F

# A decimal number, or one of the words a float cast accepts.  Spark's own cast
# also takes Java suffixes ("1d", "12f"), which are not numbers in a spreadsheet.
NUMBER_PATTERN = (
    r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"
)

# Two-digit years from this one on belong to the 1900s (POSIX %y).
YEAR_PIVOT = 69

MONTH_NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def budget_cell(text, amount_type="double"):
    """Number in the named cell: ``1,234`` is a number, ``-`` and junk are NULL."""
    bare = f"nullif(replace({text}, ',', ''), '-')"
    return F.expr(
        f"CASE WHEN {bare} RLIKE r'{NUMBER_PATTERN}' THEN try_cast({bare} AS {amount_type}) END"
    )


def path_head(path):
    """Text before the first colon, leading colons skipped; NULL if there is none."""
    return F.regexp_substr(path, F.lit("[^:]+"))


def path_tail(path):
    """Text after the first colon up to a line end; NULL without a colon."""
    return F.when(path.contains(":"), F.regexp_extract(path, r":([^\n]*)", 1))


def month_start(label):
    """First day of the month named by ``jan25`` or ``jan25_budget``."""
    parsed = F.to_date(F.replace(label, F.lit("_budget"), F.lit("")), "MMMyy")
    return F.when(F.year(parsed) >= 2000 + YEAR_PIVOT, F.add_months(parsed, -1200)).otherwise(parsed)


def month_labels(start="2025-01", n_months=36):
    """Budget column names from ``start`` (``YYYY-MM``) on: ``jan25_budget``, ..."""
    first = datetime.date.fromisoformat(f"{start}-01")
    months = range(first.month - 1, first.month - 1 + n_months)
    return [f"{MONTH_NAMES[m % 12]}{(first.year + m // 12) % 100:02d}_budget" for m in months]


def sheet_address(url):
    """Sheet URL without query, fragment and ``/edit``."""
    base = F.substring_index(F.substring_index(url, "?", 1), "#", 1)
    return F.replace(base, F.lit("/edit"), F.lit(""))


def column_index(letters):
    """Zero-based column of spreadsheet letters: A is 0, AS is 44."""
    index = 0
    for letter in letters.upper():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def parse_range(sheet_range):
    """``Tab!A4:AS69`` as (tab, first row, last row, first column, last column)."""
    match = re.fullmatch(r"(?:(.*)!)?\$?([A-Za-z]+)\$?(\d+):\$?([A-Za-z]+)\$?(\d+)", sheet_range)
    if match is None:
        raise ValueError(f"not a sheet range: {sheet_range!r}")
    tab, left, top, right, bottom = match.groups()
    window = (int(top), int(bottom), column_index(left), column_index(right))
    if window[0] < 1 or window[0] > window[1] or window[2] > window[3]:
        raise ValueError(f"empty sheet range: {sheet_range!r}")
    return (tab, *window)
