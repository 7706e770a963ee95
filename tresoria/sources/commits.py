"""Committed loads: a table whose loads become visible, or are replaced, by one commit each.

A load writes its rows into a folder of its own, ``<table>/load=<id>``, where nobody looks yet.  Its
commit is one Parquet file in the table's log, which holds the load's id, the source files it
stands for, those that could not be read and why, and the loads that it replaces.  A job writes one
file by one rename (one put on an object store), so a reader sees the whole commit or none of it.
A load that stops before its commit leaves a folder that no reader opens; the next run
loads the same files again, under another id.

One loader a table at a time: the log has no lock.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``kind``: ``add`` and ``drop`` name a load that is visible from now on, or no longer; ``loaded`` and
#: ``rejected`` name a source file (with the reason why it was rejected).
LOG_SCHEMA = "load string, kind string, name string, reason string, modification_time timestamp, length long"


def new_load_id() -> str:
    return "l" + uuid.uuid4().hex  # a letter first: never read as a number


def load_path(path: str, load: str) -> str:
    return f"{path.rstrip('/')}/load={load}"


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """All rows of the log; none before the first commit."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(log_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def commit(rows: DataFrame, log_path: str) -> None:
    """Publish: all rows in one file.  They are names of one load's files, never its data."""
    rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in LOG_SCHEMA.split(", ")]).coalesce(1).write.mode(
        "append").parquet(log_path)


def action(spark: SparkSession, kind: str, loads: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(x, kind, None, None, None, None) for x in loads], LOG_SCHEMA)


def visible_loads(spark: SparkSession, log_path: str) -> list[str]:
    """Ids of the committed loads that no later commit replaced: one short name for each load."""
    log = read_log(spark, log_path)
    gone = log.where("kind = 'drop'").select("load")
    return sorted(r["load"] for r in log.where("kind = 'add'").select("load").distinct().join(gone, "load", "left_anti").collect())


def read_committed(spark: SparkSession, path: str, log_path: str) -> DataFrame:
    """The rows of the visible loads; folders of other loads are not read."""
    loads = visible_loads(spark, log_path)
    if not loads:
        raise ValueError(f"{log_path} holds no commit")
    # the listed folders only: an unfinished load is neither scanned nor asked for its schema
    return spark.read.option("basePath", path).parquet(*[load_path(path, x) for x in loads]).drop("load")


def sync_catalog(spark: SparkSession, table: str, path: str, log_path: str) -> None:
    """Make the catalog's partitions those of the visible loads, creating the table when absent.  Run again after a stop,
    it ends the same: the log decides."""
    loads = visible_loads(spark, log_path)
    if not loads:
        return
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read_committed(spark, path, log_path).schema)
        spark.sql(f"CREATE TABLE {table} ({columns}, load string) USING parquet PARTITIONED BY (load) LOCATION '{path}'")
    known = {r["partition"].removeprefix("load=") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [f"PARTITION (load = '{x}') LOCATION '{load_path(path, x)}'" for x in loads if x not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    old = [f"PARTITION (load = '{x}')" for x in sorted(known - set(loads))]
    if old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(old)}")
    spark.catalog.refreshTable(table)


def delete_hidden(spark: SparkSession, path: str, log_path: str) -> list[str]:
    """Delete the folders of loads that are not visible: those that stopped and those replaced.  To be run when no load
    and no reader of an earlier commit is at work."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    keep = {f"load={x}" for x in visible_loads(spark, log_path)}
    gone = [st.getPath() for st in fs.listStatus(root) if st.isDirectory() and st.getPath().getName().startswith("load=")
            and st.getPath().getName() not in keep]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.getName().removeprefix("load=") for p in gone)
