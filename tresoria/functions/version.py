"""Forecast version (``yyyy-MM``) read from a workbook file name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tresoria.functions.numeric import col_

# FIXED VALUES: accepted date shapes in a file name, tried in this order:
# year, month (``2017.10``, ``2021 2``, ``2020-10-19``); two numbers and a year
# (``31.12.2021``, ``12 31 2021``); month, year (``12-2021``); then compact
# day-month-year (``19102020``).  Groups are separated by blanks, dots or hyphens;
# digits must not touch other digits.
YEAR_MONTH_RE = "(^|[^0-9])([0-9]{4})[ .-]+([0-9]{1,2})([^0-9]|$)"
TWO_AND_YEAR_RE = "(^|[^0-9])([0-9]{1,2})[ .-]+([0-9]{1,2})[ .-]+([0-9]{4})([^0-9]|$)"
MONTH_YEAR_RE = "(^|[^0-9])([0-9]{1,2})[ .-]+([0-9]{4})([^0-9]|$)"
DAY_MONTH_YEAR_RE = "(^|[^0-9])([0-9]{2})([0-9]{2})([0-9]{4})([^0-9]|$)"
FOLDER_MARK = "mensualisées/"


def _version(year: Column, month: Column) -> Column:
    m = month.try_cast("int")
    return F.when((m >= 1) & (m <= 12) & (year != ""), F.concat(year, F.lit("-"), F.lpad(m.cast("string"), 2, "0")))


def version_from_filename(path) -> Column:
    """File name -> ``yyyy-MM``, NULL when no date shape is found (loads reject such files).

    Only the part after the forecast folder is read when the folder is in the
    path.  Of two numbers before a year the first is the month, unless only the second can be
    one (``31.12.2021``), as the reports' own free date parser reads them; strict shapes replace
    that parser elsewhere (it turned ``19102020`` into 2019-10 and failed on others)."""
    name = F.substring_index(col_(path), FOLDER_MARK, -1)

    def group(pattern: str, i: int) -> Column:
        return F.regexp_extract(name, pattern, i)

    first, second = group(TWO_AND_YEAR_RE, 2), group(TWO_AND_YEAR_RE, 3)
    return F.coalesce(
        _version(group(YEAR_MONTH_RE, 2), group(YEAR_MONTH_RE, 3)),
        _version(group(TWO_AND_YEAR_RE, 4), F.when(first.try_cast("int") > 12, second).otherwise(first)),
        # a third number before these two belongs to the shape above
        F.when(first == "", _version(group(MONTH_YEAR_RE, 3), group(MONTH_YEAR_RE, 2))),
        _version(group(DAY_MONTH_YEAR_RE, 4), group(DAY_MONTH_YEAR_RE, 3)),
    )
