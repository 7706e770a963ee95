"""Forecast label harmonisation, level tags and categories."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tresoria.constants import LABEL_CATEGORIES, LABEL_RULES, SIGNED_LABEL_RULES
from tresoria.functions.numeric import col_


def _static_map() -> Column:
    # later rules never rewrite an earlier rule's output, so the ordered
    # statements collapse to one literal map (checked in tests)
    return F.create_map(*chain.from_iterable((F.lit(a), F.lit(b)) for a, b in LABEL_RULES))


def harmonise_label(label, amount) -> Column:
    """Harmonised label: static renames, then sign-dependent splits.

    A NULL amount leaves a sign-dependent label as it is after the renames."""
    lab = col_(label)
    amt = col_(amount)
    renamed = F.coalesce(F.try_element_at(_static_map(), lab), lab)
    out = renamed
    for src, neg, pos in reversed(SIGNED_LABEL_RULES):
        out = (F.when((renamed == src) & (amt < 0), F.lit(neg))
               .when((renamed == src) & (amt >= 0), F.lit(pos))
               .otherwise(out))
    return out


def harmonise(df: DataFrame, label: str = "nature_montant", amount: str = "montant_millions") -> DataFrame:
    return df.withColumn(label, harmonise_label(label, amount))


def level_tag(label, niv1: Sequence[str], niv2: Sequence[str], niv3: Sequence[str]) -> Column:
    """``niv01``/``niv02``/``niv03`` by first list holding the label; NULL label
    -> ``''``; a label in no list -> NULL."""
    lab = col_(label)
    return (F.when(lab.isin(list(niv1)), "niv01")
            .when(lab.isin(list(niv2)), "niv02")
            .when(lab.isin(list(niv3)), "niv03")
            .when(lab.isNull(), ""))


def category_table(spark: SparkSession) -> DataFrame:
    """(label, categorie): first category (in priority order) listing the label.

    Built from the fixed lists (about 40 rows), hence safe to broadcast."""
    rows, seen = [], set()
    for cat, labels in LABEL_CATEGORIES:
        for lab in labels:
            if lab not in seen:
                seen.add(lab)
                rows.append((lab, cat))
    return spark.createDataFrame(rows, "nature_montant string, categorie string")


def with_category(df: DataFrame, label: str = "nature_montant") -> DataFrame:
    cats = category_table(df.sparkSession).withColumnRenamed("nature_montant", label)
    return df.join(F.broadcast(cats), on=label, how="left")
