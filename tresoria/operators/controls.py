"""Load controls, date extent, KPIs and the data-quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tresoria.constants import (ALLOWED_LABELS, CONSOLIDATED_ACCOUNT, GATE_MONTH_WORDS,
                                GATE_TYPE_WORDS, KPI_LABELS)
from tresoria.functions.text import amount_text, percent_text
from tresoria.operators.ledger import label_column


def files_per_day(typed_raw: DataFrame) -> DataFrame:
    """Distinct export files per value date, on the raw (not deduplicated) ledger."""
    return (typed_raw.where(F.col("date_montant").isNotNull())
            .groupBy("date_montant").agg(F.countDistinct("fichier").alias("nb_fichiers")))


def label_usage(sage: DataFrame, grain: str = "flux") -> DataFrame:
    """Distinct value dates per label (most used first when ordered by the caller)."""
    lab = label_column(grain)
    return (sage.where(F.col(lab).isNotNull())
            .groupBy(lab).agg(F.countDistinct("date_montant").alias("nb_dates")))


def date_extent(sage: DataFrame) -> DataFrame:
    """First and last value date and the inclusive number of days."""
    return (sage.agg(F.min("date_montant").alias("date_debut"), F.max("date_montant").alias("date_fin"))
            .withColumn("nb_jours", (F.datediff("date_fin", "date_debut") + 1).cast("int")))


def kpi(sage: DataFrame, lag_days: int, end_date=None, accounts: Sequence[str] = (CONSOLIDATED_ACCOUNT,),
        grain: str = "flux") -> DataFrame:
    """Opening / pre-decision / final balance at the end date and ``lag_days``
    before, with the change in percent, one row per balance label.

    ``end_date`` defaults to the last value date (a scalar subquery).  Several
    matching rows resolve to the smallest amount (deterministic); a missing
    value or a zero base gives NULL."""
    lab = label_column(grain)
    end_value = (F.lit(end_date).cast("date") if end_date is not None
                 else sage.select(F.max("date_montant")).scalar())
    # the end date (a scalar subquery, computed once) is projected once and
    # then referenced by column, so the plan holds the subquery only once
    df = (sage.where(F.col(lab).isin(KPI_LABELS) & F.col("banque_compte").isin(list(accounts)))
          .select(lab, "date_montant", "montant", end_value.alias("_end"))
          .withColumn("_start", F.date_sub("_end", lag_days))
          .where((F.col("date_montant") == F.col("_end")) | (F.col("date_montant") == F.col("_start"))))
    end, start = F.col("_end"), F.col("_start")
    aggs = []
    for i, name in enumerate(KPI_LABELS):
        is_l = F.col(lab) == name
        aggs.append(F.min(F.when(is_l & (F.col("date_montant") == end), F.col("montant"))).alias(f"f{i}"))
        aggs.append(F.min(F.when(is_l & (F.col("date_montant") == start), F.col("montant"))).alias(f"d{i}"))
    one = df.agg(*aggs)
    stack = "stack({n}, {items}) as (libelle, montant_fin, montant_debut)".format(
        n=len(KPI_LABELS),
        items=", ".join(f"'{name}', f{i}, d{i}" for i, name in enumerate(KPI_LABELS)))
    out = one.select(F.expr(stack))
    evo = F.when(F.col("montant_debut") != 0,
                 F.lit(100.0) * (F.col("montant_fin") - F.col("montant_debut")) / F.col("montant_debut"))
    return out.withColumn("evolution_pct", evo)


def kpi_text(kpis: DataFrame) -> DataFrame:
    """KPI tiles as text: ``1 234 €`` and ``12.5 %``."""
    return kpis.select("libelle", amount_text("montant_fin").alias("valeur"),
                       percent_text("evolution_pct").alias("evolution"))


def _hits(c: str, words: Sequence[str]) -> F.Column:
    low = F.lower(F.col(c))
    total = None
    for w in words:
        h = F.coalesce(low.contains(w).cast("int"), F.lit(0))
        total = h if total is None else total + h
    return total


def quality_gate(fact: DataFrame, keys: Sequence[str] = ("nom_fichier", "nom_onglet"),
                 allowed: Sequence[str] = ALLOWED_LABELS) -> DataFrame:
    """Per loaded unit (workbook sheet): do month names, amount types and labels
    look right?  Month names and types count *pattern hits* that must equal
    the row count (a double hit can offset a miss, as in the source); labels
    must all be in the allowed list.  ``strict`` also requires exactly one hit
    per row.  One aggregation, partial on the map side."""
    keys = list(keys)
    mh, th = _hits("mois_nom", GATE_MONTH_WORDS), _hits("type_montant", GATE_TYPE_WORDS)
    ok_label = F.col("nature_montant").isin(list(allowed))
    g = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("nb_lignes"),
        F.sum(mh).alias("_mh"), F.sum(th).alias("_th"),
        F.count_if(ok_label).alias("_lab"),
        F.count_if((mh != 1) | (th != 1)).alias("_bad"))
    n = F.col("nb_lignes")
    return g.select(
        *keys, "nb_lignes",
        (F.col("_mh") == n).alias("mois_ok"),
        (F.col("_th") == n).alias("type_ok"),
        (F.col("_lab") == n).alias("nature_ok"),
        ((F.col("_mh") == n) & (F.col("_th") == n) & (F.col("_lab") == n)).alias("valide"),
        ((F.col("_bad") == 0) & (F.col("_lab") == n)).alias("valide_strict"))
