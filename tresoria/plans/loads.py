"""Batch loads: workbooks into a table, each file once.

A load takes the files that the table's log does not list, runs the operators on their cells, writes the
rows into a folder of its own and commits (``sources/commits.py``): the rows and the list of files become
visible together, so a load that stops anywhere is simply run again.  Files that cannot be read, or
whose name gives no version, are listed in the same commit as rejected with the reason; the other files of the load go
in, and a rejected file is tried again once its time or size differs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tresoria.functions.version import version_from_filename
from tresoria.operators import cells as C
from tresoria.session import materialize, stages_released
from tresoria.sources import commits, sinks
from tresoria.sources.tables import discover_files
from tresoria.sources.workbook import decode_checked

NO_VERSION = "no date in the file name"


@dataclass(frozen=True)
class Staged:
    """A load that is written but not committed: no reader sees it."""

    load: str
    loaded: int
    rows: DataFrame
    path: str
    manifest_path: str
    table: str | None

    def commit(self) -> int:
        """Publish the load; the number of files that it holds."""
        spark = self.rows.sparkSession
        commits.commit(self.rows, self.manifest_path)
        if self.table:
            commits.sync_catalog(spark, self.table, self.path, self.manifest_path)
        return self.loaded


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Names of the files loaded so far; none before the first load."""
    return commits.read_log(spark, path).where("kind = 'loaded'").select("name")


def rejected_files(spark: SparkSession, manifest_path: str) -> DataFrame:
    """(name, reason, modification_time, length) of files turned away and not loaded since."""
    log = commits.read_log(spark, manifest_path)
    return log.where("kind = 'rejected'").select("name", "reason", "modification_time", "length").join(
        read_manifest(spark, manifest_path), "name", "left_anti")


def _todo(files: DataFrame, spark: SparkSession, manifest_path: str) -> DataFrame:
    """Files (name, modification_time, length) that are neither loaded nor rejected as they are now."""
    bad = rejected_files(spark, manifest_path).drop("reason")
    same = (files["name"] == bad["name"]) & files["modification_time"].eqNullSafe(bad["modification_time"]) & files["length"].eqNullSafe(bad["length"])
    return files.join(read_manifest(spark, manifest_path), "name", "left_anti").join(bad, same, "left_anti")


def _stage(todo: DataFrame, cells: DataFrame, prepared: bool, kind: str, path: str, manifest_path: str, table: str | None,
           load_date: str | None, errors: DataFrame | None = None) -> Staged | None:
    """Write the load of the files ``todo`` from their ``cells``; ``errors`` (name, reason) are unreadable files."""
    spark = todo.sparkSession
    marked = todo.join(errors, "name", "left") if errors is not None else todo.withColumn("reason", F.lit(None).cast("string"))
    if kind != "adjustments":
        marked = marked.withColumn("reason", F.coalesce("reason", F.when(version_from_filename("name").isNull(), F.lit(NO_VERSION))))
    load = commits.new_load_id()
    rows = materialize(marked.select(F.lit(load).alias("load"), F.when(F.col("reason").isNull(), "loaded").otherwise("rejected").alias("kind"),
                                     "name", "reason", "modification_time", "length"), "load-files")
    kinds = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}
    if not kinds:
        return None
    loaded = kinds.get("loaded", 0)
    if loaded:
        good = rows.where("kind = 'loaded'").select("name")
        fresh = cells.join(good, cells["file"] == good["name"], "left_semi")
        out = (C.adjustments(fresh, prepared=prepared) if kind == "adjustments" else C.ingest_forecast(fresh, kind, prepared=prepared))
        sinks.write_overwrite(out, commits.load_path(path, load), load_date=load_date)
        rows = rows.unionByName(commits.action(spark, "add", [load]))
    return Staged(load, loaded, rows, path, manifest_path, table)


def stage_cells(cells: DataFrame, kind: str, path: str, manifest_path: str, table: str | None = None,
                load_date: str | None = None) -> Staged | None:
    """Write the load of the files of ``cells`` that the manifest does not list, without publishing it; None where
    there is nothing to load."""
    spark = cells.sparkSession
    cells = C.normalise_cells(cells)
    files = cells.select(F.col("file").alias("name")).distinct().select(
        "name", F.lit(None).cast("timestamp").alias("modification_time"), F.lit(None).cast("long").alias("length"))
    todo = materialize(_todo(files, spark, manifest_path), "load-todo")
    fresh = cells.join(todo.select("name"), cells["file"] == F.col("name"), "left_semi")
    return _stage(todo, fresh, False, kind, path, manifest_path, table, load_date)


def load_cells(cells: DataFrame, kind: str, path: str, manifest_path: str, table: str | None = None,
               load_date: str | None = None) -> int:
    """Add what the cells of unlisted files give; returns how many files were loaded.

    ``kind``: ``multi`` or ``single`` (forecast workbooks, through the quality
    gate) or ``adjustments``.  The rows are read with :func:`commits.read_committed`."""
    with stages_released(cells.sparkSession):
        staged = stage_cells(cells, kind, path, manifest_path, table, load_date)
        return staged.commit() if staged else 0


def load_workbooks(spark: SparkSession, root: str, kind: str, path: str, manifest_path: str, table: str | None = None,
                   glob: str = "*.xlsx", load_date: str | None = None) -> int:
    """:func:`load_cells` for the workbooks under ``root``.  Listed files are not decoded; a workbook without a cell is
    listed too; one that cannot be decoded is rejected.  (Spark's file sources pass over files of no bytes: such a
    file is loaded once it has some.)"""
    with stages_released(spark):
        listed = discover_files(spark, root, glob).select(F.col("path").alias("name"), "modification_time", "length")
        todo = materialize(_todo(listed, spark, manifest_path), "load-todo")
        files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", "true").load(root))
        return load_files(files.join(todo.select(F.col("name").alias("path")), "path", "left_semi"), todo, kind, path,
                          manifest_path, table, load_date)


def load_files(files: DataFrame, todo: DataFrame, kind: str, path: str, manifest_path: str, table: str | None = None,
               load_date: str | None = None) -> int:
    """Load the workbooks ``files`` (path, content), whose names, times and sizes are ``todo``."""
    # decoded once, into a stage that the load's steps read
    decoded = materialize(decode_checked(files), "cells")
    errors = decoded.where("error is not null").select(F.col("file").alias("name"), F.col("error").alias("reason"))
    staged = _stage(todo, decoded.where("error is null").drop("error"), True, kind, path, manifest_path, table, load_date, errors)
    return staged.commit() if staged else 0


def compact_loads(spark: SparkSession, path: str, manifest_path: str, table: str | None = None,
                  target_file_bytes: int = sinks.TARGET_FILE_BYTES, small_file_bytes: int | None = None) -> list[str]:
    """Merge small loads: the loads whose files are below ``small_file_bytes`` (half the target) on average, and that together make
    fewer files, become one new load by one commit.  Other loads keep their files, so the work follows the small ones and not
    the table.  Returns the loads replaced; their folders stay for readers at work (``commits.delete_hidden``)."""
    loads = commits.visible_loads(spark, manifest_path)
    sizes = discover_files(spark, path, "*.parquet").select(
        F.regexp_extract("path", "/load=([^/]+)/", 1).alias("load"), "length").where(F.col("load").isin(loads)).groupBy("load").agg(
            F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")).collect()  # one row for each load
    small = [r for r in sizes if r["bytes"] < r["files"] * (small_file_bytes or target_file_bytes // 2)]
    wanted = max(1, -(-sum(r["bytes"] for r in small) // target_file_bytes))
    if wanted >= sum(r["files"] for r in small):
        return []
    old = sorted(r["load"] for r in small)
    new = commits.new_load_id()
    rows = spark.read.option("basePath", path).parquet(*[commits.load_path(path, x) for x in old]).drop("load")
    # fewer, larger files without a shuffle; a scan of fewer partitions than files is spread out
    out = rows.coalesce(wanted) if wanted <= rows.rdd.getNumPartitions() else rows.repartition(wanted)
    out.write.mode("errorifexists").parquet(commits.load_path(path, new))
    commits.commit(commits.action(spark, "add", [new]).unionByName(commits.action(spark, "drop", old)), manifest_path)
    if table:
        commits.sync_catalog(spark, table, path, manifest_path)
    return old
