"""Bank ledger: typed view, latest file per day and account, calendar keys."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tresoria.constants import LEDGER_DATE_FORMATS, LEDGER_TIMESTAMP_FORMATS
from tresoria.functions.calendar import (parse_date, parse_timestamp, year_month,
                                         year_quarter, year_week_sunday)
from tresoria.functions.numeric import to_number
from tresoria.functions.text import lower_columns
from tresoria.operators.latest import keep_latest, keep_latest_colocated
from tresoria.session import materialize, stages_released

GRAIN_LABEL = {"flux": "code_flux_libelle", "budget": "code_budgetaire"}
PERIOD_COLUMN = {"S": "annee_semaine", "M": "annee_mois", "T": "trimestre", "A": "annee"}


def label_column(grain: str) -> str:
    return GRAIN_LABEL[grain]


def typed_ledger(raw: DataFrame) -> DataFrame:
    """Lower-case names; dates, timestamps and amounts typed (NULL if unparsable).

    Text columns are parsed with the export formats; columns that are already
    typed (a stored typed copy) are kept, so the view is idempotent."""
    df = lower_columns(raw)
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def typed(c, parse, target):
        return parse(c) if kinds.get(c) == "string" else F.col(c).cast(target)
    return df.withColumns({
        "date_montant": typed("date_montant", lambda c: parse_date(c, LEDGER_DATE_FORMATS), "date"),
        "date_production_fichier": typed(
            "date_production_fichier", lambda c: parse_timestamp(c, LEDGER_TIMESTAMP_FORMATS), "timestamp_ntz"),
        "montant": typed("montant", to_number, "double"),
    })


def store_typed_ledger(raw: DataFrame, path: str) -> None:
    """Write the typed ledger partitioned by ``annee_mois``.

    Filters on the typed columns then reach the Parquet scan (a cast on a
    text column blocks pushdown) and month filters prune whole folders."""
    (typed_ledger(raw).withColumn("annee_mois", year_month("date_montant"))
     .write.mode("overwrite").partitionBy("annee_mois").parquet(path))


def latest_file(typed: DataFrame) -> DataFrame:
    """Keep, per (day, account), the rows of the most recent export file."""
    return keep_latest(typed, ["date_montant", "banque_compte"], "date_production_fichier")


def with_calendar(df: DataFrame, date_col: str = "date_montant") -> DataFrame:
    return df.withColumns({
        "annee": F.year(date_col),
        "annee_mois": year_month(date_col),
        "annee_semaine": year_week_sunday(date_col),
        "trimestre": year_quarter(date_col),
    })


def clean_ledger(raw: DataFrame, start=None, end=None, accounts=None) -> DataFrame:
    """Typed, latest-file ledger with calendar keys (the bank report's base).

    Day and account are the keys of the latest-file rule, so a range of days or a
    set of accounts may be cut out before it: both scans then read only that."""
    return with_calendar(latest_file(filter_range_accounts(typed_ledger(raw), start, end, accounts)))


def filter_range_accounts(df: DataFrame, start=None, end=None, accounts=None) -> DataFrame:
    """Inclusive date range and account set (names keep their leading blank).

    A stored typed copy has its month as the partition column ``annee_mois``: the
    range of months that the days imply is added, which skips the other folders."""
    cond = F.lit(True)
    by_month = "annee_mois" in df.columns
    for bound, below in ((start, False), (end, True)):
        if bound is None:
            continue
        day = F.lit(bound).cast("date")
        cond = cond & ((F.col("date_montant") <= day) if below else (F.col("date_montant") >= day))
        if by_month:
            month, edge = F.col("annee_mois").cast("string"), str(bound)[:7]
            cond = cond & ((month <= edge) if below else (month >= edge))
    if accounts is not None:
        cond = cond & F.col("banque_compte").isin(list(accounts))
    return df.where(cond)


LATEST_KEYS = ["date_montant", "banque_compte"]


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The maintained latest-version table (:func:`merge_export`), with calendar keys.  A range of ``annee_mois``
    prunes its folders."""
    return with_calendar(spark.read.parquet(path))


def merge_export(raw: DataFrame, path: str) -> list[str]:
    """Bring one export into the maintained latest-version table; returns the months it touched.

    Only the months of the export's days are read and written again (dynamic partition overwrite), whatever
    the length of the history: the latest version of old and new rows is the latest of the two latest.  An export
    file that comes again replaces its own rows, so a merge that stopped is simply run again."""
    spark = raw.sparkSession
    with stages_released(spark):
        new = materialize(typed_ledger(raw).where("date_montant is not null and banque_compte is not null")
                          .withColumn("annee_mois", year_month("date_montant")), "export")
        months = sorted(r["annee_mois"] for r in new.select("annee_mois").distinct().collect())
        try:
            stored = spark.read.parquet(path).withColumn("annee_mois", F.col("annee_mois").cast("string"))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            merged = new
        else:
            own = new.select("fichier").distinct()
            others = stored.where(F.col("annee_mois").isin(months)).join(own, "fichier", "left_anti")
            merged = others.unionByName(new)
        # written before the overwrite, which deletes the folders that it is read from
        out = materialize(latest_file(merged), "latest")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("annee_mois").parquet(path)
    return months


def store_bucketed_ledger(raw: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """The typed ledger as a catalog table bucketed by day and account, one file a bucket: the latest-file rule
    (:func:`clean_bucketed_ledger`) then reads it without a shuffle.  ``buckets`` should follow the table's size
    (about 256 MB each)."""
    w = (typed_ledger(raw).repartition(buckets, *LATEST_KEYS).write.mode("overwrite").format("parquet")
         .bucketBy(buckets, *LATEST_KEYS).sortBy(*LATEST_KEYS))
    (w.option("path", path) if path else w).saveAsTable(table)


def clean_bucketed_ledger(spark: SparkSession, table: str, start=None, end=None, accounts=None) -> DataFrame:
    """:func:`clean_ledger` of a table written by :func:`store_bucketed_ledger`."""
    typed = filter_range_accounts(typed_ledger(spark.table(table)), start, end, accounts)
    return with_calendar(keep_latest_colocated(typed, LATEST_KEYS, "date_production_fichier"))
