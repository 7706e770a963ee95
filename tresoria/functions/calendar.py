"""Calendar keys for ledger dates and forecast (year, month) text."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tresoria.constants import MONTHS_FR
from tresoria.functions.numeric import col_


def _formats(fmt) -> list[str]:
    return [fmt] if isinstance(fmt, str) else list(fmt)


def parse_date(c, fmt="yyyy/MM/dd") -> Column:
    """Text -> date with explicit pattern(s), the first that parses wins;
    NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(col_(c), F.lit(f)) for f in _formats(fmt)]).cast("date")


def parse_timestamp(c, fmt="yyyy/MM/dd HH:mm:ss") -> Column:
    """Text -> timestamp without time zone, pattern(s) as ``parse_date``."""
    return F.coalesce(*[F.try_to_timestamp(col_(c), F.lit(f)) for f in _formats(fmt)]).cast("timestamp_ntz")


def year_month(d) -> Column:
    """``yyyy-MM`` of a date."""
    return F.date_format(col_(d), "yyyy-MM")


def year_week_sunday(d) -> Column:
    """``yyyy-WW`` with Sunday-started weeks numbered 00-53 (days before the
    first Sunday of the year are week 00), the C ``%Y-%U`` convention."""
    d = col_(d)
    week = F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7))
    return F.format_string("%d-%02d", F.year(d), week.cast("int"))


def year_quarter(d) -> Column:
    """``yyyy-Tq`` of a date."""
    d = col_(d)
    return F.format_string("%d-T%d", F.year(d), F.quarter(d))


def forecast_year_month(annee, mois) -> Column:
    """``annee-mois`` from the stored text columns; NULL when either is NULL."""
    return F.concat(col_(annee), F.lit("-"), col_(mois))


def forecast_quarter(annee, mois) -> Column:
    """``annee-Tq`` from text year and 2-digit month text; NULL if unknown."""
    q = F.ceil(col_(mois).try_cast("int") / F.lit(3)).cast("int")
    return F.concat(col_(annee), F.lit("-T"), q.cast("string"))


def _name_to_num() -> Column:
    return F.create_map(*chain.from_iterable(
        (F.lit(n), F.lit(f"{i:02d}")) for i, n in enumerate(MONTHS_FR, start=1)))


def _num_to_name() -> Column:
    return F.create_map(*chain.from_iterable(
        (F.lit(f"{i:02d}"), F.lit(n)) for i, n in enumerate(MONTHS_FR, start=1)))


def month_number(name) -> Column:
    """French month name -> ``'01'..'12'``; anything else (``TOTAL``) -> NULL."""
    return F.try_element_at(_name_to_num(), col_(name))


def month_name(num) -> Column:
    """``'01'..'12'`` (or 1..12) -> French month name; NULL otherwise."""
    return F.try_element_at(_num_to_name(), zero_pad(num))


def zero_pad(x) -> Column:
    """Month number as 2-digit text (``3 -> '03'``)."""
    return F.lpad(col_(x).cast("string"), 2, "0")
