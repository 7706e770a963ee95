"""Text cleaning: column-name normaliser, stringify, NaN markers, KPI text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tresoria.constants import MISSING_LABEL
from tresoria.functions.numeric import col_

# FIXED VALUES: column-name normaliser, applied in this order after
# lower-casing and trimming (plain substring replacement, left to right).
NAME_REPLACEMENTS = [
    (" ", "_"), ("'", "_"), ("-", "_"), ("é", "e"), ("è", "e"), ("...", ""), ("(", ""),
    (")", ""), ("…", ""), ("ç", "c"), (".", ""), ("/", "_"), ("___", "_"), ("__", "_"),
    ("à", ""),
]
_WS = "[ \\t\\n\\r\\f\\x0B]"


def strip_ws(c) -> Column:
    """Remove leading/trailing whitespace (blank, tab, newline...)."""
    return F.regexp_replace(col_(c), f"^{_WS}+|{_WS}+$", "")


def normalise_name(c, upper: bool = True) -> Column:
    """Column-name normaliser as an expression usable on data."""
    out = strip_ws(F.lower(col_(c)))
    for a, b in NAME_REPLACEMENTS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.upper(out) if upper else out


def normalise_name_py(s: str, upper: bool = True) -> str:
    """Same rule on a Python string (for schemas, which live on the driver)."""
    out = s.lower().strip()
    for a, b in NAME_REPLACEMENTS:
        out = out.replace(a, b)
    return out.upper() if upper else out


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name_py(c) for c in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def nan_to_null(c) -> Column:
    """Stored missing marker ``nan`` (any case) -> NULL; ``None``/``NaT`` stay."""
    c = col_(c)
    return F.when(F.lower(c) == F.lit("nan"), F.lit(None).cast("string")).otherwise(c)


def stringify(df: DataFrame) -> DataFrame:
    """Every column to text, newlines to blanks, ``nan`` to NULL, one projection."""
    return df.select(*[
        nan_to_null(F.regexp_replace(F.col(c).cast("string"), "\n", " ")).alias(c)
        for c in df.columns])


def fill_trim_label(c, fill: str = MISSING_LABEL) -> Column:
    """Missing label -> fixed text, then trim (fill first)."""
    return strip_ws(F.coalesce(col_(c), F.lit(fill)))


def null_text(c, marker: str = "null") -> Column:
    return F.nullif(col_(c), F.lit(marker))


def thousands(s: Column) -> Column:
    return F.replace(s, F.lit(","), F.lit(" "))


def amount_text(x) -> Column:
    """Whole euros, blank thousands separator, ``€`` suffix.

    ``format_number`` rounds half-even on the exact binary value of the
    double, as Python's ``round`` does (rounding the decimal text first, as
    ``bround`` does, differs on values such as -1234.565)."""
    s = F.regexp_replace(F.format_number(col_(x), 0), "^-0$", "0")
    return F.concat(thousands(s), F.lit(" €"))


def percent_text(x) -> Column:
    """Two decimals, trailing zero dropped as Python prints a rounded float."""
    s = F.format_number(col_(x), 2)
    s = F.regexp_replace(s, "(\\.[0-9])0$", "$1")
    return F.concat(thousands(s), F.lit(" %"))
