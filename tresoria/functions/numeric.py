"""Tolerant numbers and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are summed as fixed-point decimals, then turned back into doubles: the
# result does not depend on the order in which partitions are merged, which a
# double sum does.  Twelve places keep amounts in millions to the millionth of a
# unit; an amount beyond the type's 26 whole digits raises.
MONEY_TYPE = "decimal(38,12)"

#: What counts as a number: an optional sign, digits with at most one point, an optional exponent.
NUMBER = r"^[ \t]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[ \t]*$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Text -> double, NULL when the text is not a plain number (``'n/a'``, ``''``,
    ``'nan'``, ``'12d'``, ``'Infinity'``)."""
    text = col_(c).cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def money(c) -> Column:
    """A double amount as an exact decimal; NULL and NaN give NULL, an amount out of
    range raises (whatever the session's own rule for casts is)."""
    v = col_(c)
    exact = F.when(~F.isnan(v), v).try_cast(MONEY_TYPE)
    lost = v.isNotNull() & ~F.isnan(v) & exact.isNull()
    return F.when(lost, F.raise_error(F.concat(F.lit("amount out of range: "), v.cast("string"))).cast(MONEY_TYPE)).otherwise(exact)


def money_sum(c) -> Column:
    """Sum of amounts that skips missing values and is 0 over an all-missing group."""
    return F.coalesce(F.sum(money(c)), F.lit(0).cast(MONEY_TYPE)).cast("double")
