"""Bank-report aggregates by frequency: balances, receipts/spending, extremes.

Frequencies: ``J`` day, ``S`` Sunday week, ``M`` month, ``T`` quarter, ``A`` year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tresoria.constants import (BALANCE_LABEL, CONSOLIDATED_ACCOUNT, LEDGER_REALISED_TYPE,
                                RECEIPT_MARK, SPENDING_MARK)
from tresoria.functions.numeric import MONEY_TYPE, money, money_sum
from tresoria.operators.joins import semi_join
from tresoria.operators.ledger import PERIOD_COLUMN, label_column, with_calendar

FREQUENCIES = ["J", "S", "M", "T", "A"]


def _period(freq: str) -> str:
    return "date_montant" if freq.upper() == "J" else PERIOD_COLUMN[freq.upper()]


def _sum_by(df: DataFrame, freq: str, by: str) -> DataFrame:
    """Sum of ``montant`` by (period, ``by``); the week adds its first day.

    The week's first day is the minimum date over *all* rows of the week, so
    it is taken over the per-group minima with a window on the aggregated
    rows (one scan of the input, no self-join)."""
    freq = freq.upper()
    p = _period(freq)
    keyed = df.where(F.col(p).isNotNull())
    if freq != "S":
        return (keyed.where(F.col(by).isNotNull())
                .groupBy(p, by).agg(money_sum("montant").alias("montant")))
    g = keyed.groupBy(p, by).agg(money_sum("montant").alias("montant"),
                                 F.min("date_montant").alias("_first"))
    return (g.withColumn("date_montant", F.min("_first").over(Window.partitionBy(p)))
            .where(F.col(by).isNotNull())
            .select(p, by, "montant", "date_montant"))


def balance(sage: DataFrame, grain: str = "flux", freq: str = "J", how: str = "sum") -> DataFrame:
    """Final balance per account and period.

    ``how="sum"`` adds the daily closing balances of the period (the source
    application's behaviour); ``how="last"`` keeps the balance of the last
    day of the period instead."""
    df = sage.where(F.col(label_column(grain)) == BALANCE_LABEL)
    if freq.upper() == "J":
        return df.select("date_montant", "banque_compte", "montant")
    if how == "sum":
        return _sum_by(df, freq, "banque_compte")
    if how == "last":
        p = _period(freq)
        daily = (df.where(F.col(p).isNotNull() & F.col("banque_compte").isNotNull())
                 .groupBy(p, "banque_compte", "date_montant")
                 .agg(money_sum("montant").alias("montant")))
        return (daily.groupBy(p, "banque_compte")
                .agg(F.max_by("montant", "date_montant").alias("montant")))
    raise ValueError(f"unknown how={how!r}")


def flow_labels(sage_all: DataFrame, kind: str, grain: str = "flux",
                budget_codes: DataFrame | None = None) -> DataFrame:
    """Label set of receipts (``kind='recettes'``) or spending (``'depenses'``).

    Flow grain: distinct labels seen with type ``R`` in the whole
    (latest-file) ledger that contain ``ecette`` / ``pense``.  Budget grain:
    distinct budget codes whose first letter is R / D (NULL-safe)."""
    if grain == "flux":
        lab = "code_flux_libelle"
        mark = RECEIPT_MARK if kind == "recettes" else SPENDING_MARK
        return (sage_all.where((F.col("type_montant") == LEDGER_REALISED_TYPE)
                               & F.col(lab).contains(mark))
                .select(lab).distinct())
    lab = "code_budgetaire"
    letter = "R" if kind == "recettes" else "D"
    codes = budget_codes if budget_codes is not None else sage_all.select(lab)
    return (codes.where(F.upper(F.substring(lab, 1, 1)) == letter).select(lab).distinct())


def dimension_codes(labels: DataFrame) -> DataFrame:
    """The budget codes of the stored label dimension, for :func:`flow_labels`."""
    return labels.select(F.col("CODE_BUDGETAIRE").alias("code_budgetaire")).where("code_budgetaire is not null").distinct()


def flow_label_table(sage_all: DataFrame, grain: str = "flux",
                     budget_codes: DataFrame | None = None) -> DataFrame:
    """(kind, label) for both kinds; a label may belong to both."""
    lab = label_column(grain)
    parts = [flow_labels(sage_all, k, grain, budget_codes).withColumn("kind", F.lit(k))
             for k in ("recettes", "depenses")]
    return parts[0].unionByName(parts[1]).select("kind", lab)


def flows(sage: DataFrame, labels: DataFrame, grain: str = "flux", freq: str = "J") -> DataFrame:
    """Receipts or spending of the consolidated account by period and label.

    ``labels`` is a one-column label set (``flow_labels``), applied as a
    semi-join."""
    lab = label_column(grain)
    df = semi_join(sage.where(F.col("banque_compte") == CONSOLIDATED_ACCOUNT), labels.select(lab), lab)
    if freq.upper() == "J":
        return df.select("date_montant", lab, "montant")
    return _sum_by(df, freq, lab)


def flow_extremes(sage: DataFrame, label_table: DataFrame, grain: str = "flux",
                  freqs=FREQUENCIES) -> DataFrame:
    """Max and min over periods of the period totals, per kind and frequency.

    One scan: rows are summed per (kind, day); the day totals are exact
    decimals, so coarser periods are sums of day totals.  Each day total is
    fanned out to one row per frequency with ``stack`` (a fixed 5-way
    expansion of the *aggregated* days), grouped by (kind, frequency, period)
    and reduced to max / min."""
    lab = label_column(grain)
    rows = (sage.where((F.col("banque_compte") == CONSOLIDATED_ACCOUNT)
                       & F.col("date_montant").isNotNull())
            .join(label_table.select("kind", lab), on=lab, how="inner"))
    daily = rows.groupBy("kind", "date_montant").agg(
        F.coalesce(F.sum(money("montant")), F.lit(0).cast(MONEY_TYPE)).alias("total"))
    daily = with_calendar(daily)
    key = {"J": "cast(date_montant as string)", "S": "annee_semaine", "M": "annee_mois",
           "T": "trimestre", "A": "cast(annee as string)"}
    stack = "stack({n}, {items}) as (frequence, periode)".format(
        n=len(freqs), items=", ".join(f"'{f}', {key[f]}" for f in freqs))
    per = (daily.select("kind", "total", F.expr(stack))
           .groupBy("kind", "frequence", "periode").agg(F.sum("total").alias("total")))
    return (per.groupBy("kind", "frequence")
            .agg(F.max("total").cast("double").alias("max_total"),
                 F.min("total").cast("double").alias("min_total")))


def axis_range(extremes: DataFrame) -> DataFrame:
    """Shared y-axis of the receipts and spending charts per frequency."""
    return (extremes.groupBy("frequence")
            .agg((F.lit(1.10) * F.max("max_total")).alias("borne_haute"),
                 F.min("min_total").alias("borne_basse")))
