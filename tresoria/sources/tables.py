"""Table scans, CSV exports and file discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; columns and filters applied later reach the scan."""
    return spark.table(name)


def ledger_table(spark: SparkSession, database: str, grain: str = "flux") -> DataFrame:
    """The bank ledger export of one grain (flow code or budget code) in ``database``."""
    name = "export_sage_code_flux_historique" if grain == "flux" else "export_sage_code_budgetaire_v2"
    return spark.table(f"{database}.{name}")


def label_table(spark: SparkSession, database: str) -> DataFrame:
    """The dimension of flow and budget codes with their labels in ``database``."""
    return spark.table(f"{database}.codeflux_codebudget_libelles")


def read_csv_table(spark: SparkSession, path: str, sep: str = ";", header: bool = True) -> DataFrame:
    """Semicolon-separated export, every column as text (no schema inference:
    types are applied by the typed views)."""
    return (spark.read.option("sep", sep).option("header", str(header).lower())
            .option("inferSchema", "false").csv(path))


def discover_files(spark: SparkSession, root: str, glob: str = "*.xlsx", name_contains: str | None = None,
                   exclude: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Recursive file listing ``(path, name, modification_time, length)``.

    Only file metadata is read (the binary source skips the content when it
    is not selected).  ``exclude`` (names) is applied as a left-anti join."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root)
             .select("path", F.element_at(F.split("path", "/"), -1).alias("name"),
                     F.col("modificationTime").alias("modification_time"), "length"))
    if name_contains is not None:
        files = files.where(F.col("name").contains(name_contains))
    if exclude is not None:
        ex = exclude if isinstance(exclude, DataFrame) else spark.createDataFrame([(n,) for n in exclude], "name string")
        files = files.join(ex.select("name"), on="name", how="left_anti")
    return files


def new_files(files: DataFrame, manifest: DataFrame, key: str = "name") -> DataFrame:
    """Files not yet loaded: ``files LEFT ANTI JOIN manifest``."""
    return files.join(manifest.select(key), on=key, how="left_anti")
