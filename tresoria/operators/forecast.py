"""Forecast fact: typed view, latest realised version, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tresoria.constants import FLOW_CATEGORIES, FORECAST_TYPE, REALISED_TYPES, TOTAL_MONTH_NAMES
from tresoria.functions.calendar import forecast_quarter, forecast_year_month
from tresoria.functions.numeric import MONEY_TYPE, money, money_sum, to_number
from tresoria.functions.text import lower_columns
from tresoria.operators.labels import harmonise
from tresoria.operators.latest import keep_latest

FACT_KEYS = ["annee", "mois", "mois_nom", "type_montant", "nature_montant"]


def typed_forecast(raw: DataFrame) -> DataFrame:
    """Lower-case names, amount as double (``n/a`` -> NULL)."""
    df = lower_columns(raw)
    return df.withColumn("montant_millions", to_number("montant_millions"))


def store_typed_forecast(raw: DataFrame, path: str) -> None:
    """Write the typed forecast fact partitioned by ``annee``: a year filter
    then reads only that year's folder.  Reading it back gives an integer
    ``annee`` partition column, which ``clean_forecast`` accepts as well."""
    typed_forecast(raw).write.mode("overwrite").partitionBy("annee").parquet(path)


def latest_realised(df: DataFrame) -> DataFrame:
    """Realised rows of the latest version per (year, month, type, label),
    ties kept, plus every forecast row of every version; other types dropped."""
    realised = df.where(F.col("type_montant").isin(REALISED_TYPES))
    forecast = df.where(F.col("type_montant") == FORECAST_TYPE)
    return keep_latest(realised, FACT_KEYS, "version_prev").unionByName(forecast)


def clean_forecast(raw: DataFrame, frequence: str = "mensuelle") -> DataFrame:
    """The forecast report's base table, monthly or quarterly."""
    df = harmonise(typed_forecast(raw))
    df = latest_realised(df)
    df = df.where(~F.col("mois_nom").isin(TOTAL_MONTH_NAMES) | F.col("mois_nom").isNull())
    df = df.withColumns({
        "annee_mois": forecast_year_month("annee", "mois"),
        "trimestre": forecast_quarter("annee", "mois"),
        "annee": F.col("annee").try_cast("int"),
    })
    if frequence == "mensuelle":
        return df
    return quarterly(df)


def quarterly(df: DataFrame) -> DataFrame:
    keys = ["trimestre", "nature_montant", "type_montant", "annee", "version_prev"]
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond).groupBy(*keys).agg(money_sum("montant_millions").alias("montant_millions"))


def _period(freq: str) -> str:
    return "annee_mois" if freq.upper().startswith("M") else "trimestre"


def versions(clean: DataFrame, annee: int | None = None, label: str | None = None) -> DataFrame:
    """Forecast versions available (for a year, optionally one label)."""
    df = clean.where(F.col("type_montant") == FORECAST_TYPE)
    if annee is not None:
        df = df.where(F.col("annee") == annee)
    if label is not None:
        df = df.where(F.col("nature_montant") == label)
    return df.select("annee", "version_prev").distinct()


def _side_sums(clean: DataFrame, label_to_cat: DataFrame | None, annee: int, version: str,
               period: str, labels=None) -> DataFrame:
    """Per (categorie, period): realised and forecast sums and their presence."""
    is_real = F.col("type_montant").isin(REALISED_TYPES)
    is_prev = (F.col("type_montant") == FORECAST_TYPE) & (F.col("version_prev") == version)
    df = clean.where((F.col("annee") == annee) & (is_real | is_prev) & F.col(period).isNotNull())
    if label_to_cat is not None:
        df = df.join(F.broadcast(label_to_cat), on="nature_montant", how="inner")
    elif labels is None:  # every label is its own group
        df = df.where(F.col("nature_montant").isNotNull()).withColumn("categorie", F.col("nature_montant"))
    else:
        df = df.where(F.col("nature_montant").isin(labels)).withColumn("categorie", F.lit("nature"))
    amt = money("montant_millions")
    return df.groupBy("categorie", period).agg(
        F.count_if(is_real).alias("n_real"),
        F.count_if(is_prev).alias("n_prev"),
        F.coalesce(F.sum(F.when(is_real, amt)), F.lit(0).cast(MONEY_TYPE)).alias("s_real"),
        F.coalesce(F.sum(F.when(is_prev, amt)), F.lit(0).cast(MONEY_TYPE)).alias("s_prev"))


def _realised_vs_forecast(sums: DataFrame, period: str, signs: DataFrame | None) -> DataFrame:
    """Outer-join semantics without a join: a side absent in a period is NULL
    there, and each side's running total runs over its own periods only."""
    w = Window.partitionBy("categorie").orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    real = F.when(F.col("n_real") > 0, F.col("s_real"))
    prev = F.when(F.col("n_prev") > 0, F.col("s_prev"))
    df = sums.withColumns({
        "_r": real, "_p": prev,
        "_cr": F.when(real.isNotNull(), F.sum(real).over(w)),
        "_cp": F.when(prev.isNotNull(), F.sum(prev).over(w)),
    })
    sign = F.col("signe") if signs is not None else F.lit(1)
    if signs is not None:
        df = df.join(F.broadcast(signs), on="categorie", how="inner")
    return df.select(
        period,
        F.col("categorie").alias("type"),
        (sign * F.col("_r")).cast("double").alias("montant_realise"),
        (sign * F.col("_p")).cast("double").alias("montant_prevu"),
        (sign * F.col("_cr")).cast("double").alias("cumul_realise"),
        (sign * F.col("_cp")).cast("double").alias("cumul_prevu"))


def flux_report(clean: DataFrame, annee: int, version: str, freq: str = "M") -> DataFrame:
    """Receipts / spending / other flows, realised against one forecast version,
    with running totals over the year; spending and other flows sign-flipped."""
    spark = clean.sparkSession
    period = _period(freq)
    l2c = spark.createDataFrame(
        [(lab, cat) for cat, labels, _ in FLOW_CATEGORIES for lab in labels],
        "nature_montant string, categorie string")
    signs = spark.createDataFrame([(cat, s) for cat, _, s in FLOW_CATEGORIES],
                                  "categorie string, signe int")
    sums = _side_sums(clean, l2c, annee, version, period)
    return _realised_vs_forecast(sums, period, signs)


def nature_report(clean: DataFrame, label: str, annee: int, version: str, freq: str = "M") -> DataFrame:
    """One label, realised against one forecast version, no sign flip."""
    period = _period(freq)
    sums = _side_sums(clean, None, annee, version, period, labels=[label])
    return _realised_vs_forecast(sums, period, None).drop("type")


def label_reports(clean: DataFrame, annee: int, version: str, freq: str = "M") -> DataFrame:
    """``nature_report`` for every label at once (one group per label)."""
    period = _period(freq)
    sums = _side_sums(clean, None, annee, version, period, labels=None)
    return _realised_vs_forecast(sums, period, None).withColumnRenamed("type", "nature_montant")


def running_totals(clean: DataFrame) -> DataFrame:
    """Monthly sums and running totals within the year for every label:
    realised per (label, year), forecasts per (label, year, version).

    All years and versions run at once; the window is partitioned by
    (side, label, year, version) and only sees aggregated months."""
    is_real = F.col("type_montant").isin(REALISED_TYPES)
    is_prev = F.col("type_montant") == FORECAST_TYPE
    df = (clean.where((is_real | is_prev) & F.col("annee_mois").isNotNull()
                      & F.col("nature_montant").isNotNull() & F.col("annee").isNotNull())
          .withColumns({
              "cote": F.when(is_real, F.lit("realise")).otherwise(F.lit("prevu")),
              "version": F.when(is_real, F.lit(None).cast("string")).otherwise(F.col("version_prev")),
          }))
    keys = ["cote", "nature_montant", "annee", "version"]
    g = df.groupBy(*keys, "annee_mois").agg(
        F.coalesce(F.sum(money("montant_millions")), F.lit(0).cast(MONEY_TYPE)).alias("m"))
    w = Window.partitionBy(*keys).orderBy("annee_mois").rowsBetween(Window.unboundedPreceding, 0)
    return g.select(*keys, "annee_mois",
                    F.col("m").cast("double").alias("montant"),
                    F.sum("m").over(w).cast("double").alias("cumul"))
