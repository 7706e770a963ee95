"""Table sinks: overwrite, append, consolidation and small-file compaction."""

from __future__ import annotations

import math
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tresoria.functions.text import normalise_columns, stringify

LOAD_DATE_COLUMN = "DATE_EXTRACTION"
TARGET_FILE_BYTES = 128 * 1024 * 1024


def prepare_for_load(df: DataFrame, load_date: str | None = None) -> DataFrame:
    """Normalised upper-case names, every column as text (newlines -> blanks,
    ``nan`` -> NULL) and the load date (ISO ``yyyy-MM-dd``; today if absent)."""
    out = stringify(normalise_columns(df))
    d = F.lit(load_date) if load_date is not None else F.date_format(F.current_date(), "yyyy-MM-dd")
    return out.withColumn(LOAD_DATE_COLUMN, d)


def _writer(df: DataFrame, mode: str, partition_by=None):
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def write_overwrite(df: DataFrame, path: str, table: str | None = None, load_date: str | None = None,
                    partition_by=None) -> None:
    """Replace the table's content (files and definition) with ``df``."""
    out = prepare_for_load(df, load_date)
    if table:
        _writer(out, "overwrite", partition_by).option("path", path).saveAsTable(table)
    else:
        _writer(out, "overwrite", partition_by).save(path)


def write_append(df: DataFrame, path: str, table: str | None = None, load_date: str | None = None,
                 partition_by=None) -> None:
    """Add ``df`` to the table, creating it when absent."""
    out = prepare_for_load(df, load_date)
    if table:
        _writer(out, "append", partition_by).option("path", path).saveAsTable(table)
    else:
        _writer(out, "append", partition_by).save(path)


def consolidate(current: DataFrame, history: DataFrame) -> DataFrame:
    """Current export followed by the history: a bag union by column name
    (no deduplication; columns missing on one side are NULL)."""
    return current.unionByName(history, allowMissingColumns=True)


def consolidate_table(current: DataFrame, history: DataFrame, path: str, table: str | None = None,
                      load_date: str | None = None) -> None:
    """Create the table from the current export, then add the history to it."""
    write_overwrite(current, path, table, load_date)
    write_append(history, path, table, load_date)


def _path_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``column=value`` folder levels under ``path``, outermost first."""
    jvm = spark.sparkContext._jvm
    at, out = jvm.org.apache.hadoop.fs.Path(path), []
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    while True:
        below = [st.getPath() for st in fs.listStatus(at) if st.isDirectory() and "=" in st.getPath().getName()]
        if not below:
            return out
        at = below[0]
        out.append(at.getName().split("=", 1)[0])


def _read_as_stored(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path`` with partition values as the text of their folders."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(key, before)


def compact(spark: SparkSession, path: str, out_path: str, target_file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rewrite the Parquet files under ``path`` into ``out_path`` as files of
    about ``target_file_bytes``; the content is unchanged (same multiset of
    rows, same columns and partition folders).  The number of files follows the
    stored size, not a row count; a partition folder that holds a large share of
    the table is split over several tasks."""
    df, by = _read_as_stored(spark, path), _partition_columns(spark, path)
    if by:
        df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(out_path)
        return _read_as_stored(spark, out_path)
    n = max(1, math.ceil(_path_bytes(spark, path) / target_file_bytes))
    # fewer, larger files: merge scan partitions without a shuffle; only a
    # table whose scan gives fewer partitions than wanted files is re-spread
    out = df.coalesce(n) if n <= df.rdd.getNumPartitions() else df.repartition(n)
    out.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    for r in rows:
        if r["col_name"] == "Location":
            return r["data_type"]
    raise ValueError(f"{table} has no location")


def _stored_files(spark: SparkSession, table: str) -> DataFrame:
    """(folder, length) of the files that the catalog table reads now, wherever its partitions lie.  Metadata only: the
    list of files, which the planner holds for any scan, and their sizes."""
    paths = [unquote(p) for p in spark.table(table).inputFiles()]  # URIs: the names on disk are escaped once less
    files = spark.read.format("binaryFile").load(paths) if paths else spark.createDataFrame([], "path string, length long")
    return files.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "length")


def _partition_of(folder: str, by: list[str]) -> tuple:
    """The partition values that a folder's last levels name, NULL for Hive's default name."""
    levels = [unquote(x.split("=", 1)[1]) for x in folder.split("/")[-len(by):]]
    return tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in levels)


def _spec(values: tuple, by: list[str]) -> str:
    quoted = ["'__HIVE_DEFAULT_PARTITION__'" if v is None else "'{}'".format(v.replace("'", "\\'")) for v in values]
    return ", ".join(f"`{k}` = {v}" for k, v in zip(by, quoted))


def compact_partitions(spark: SparkSession, table: str, target_file_bytes: int = TARGET_FILE_BYTES,
                       small_file_bytes: int | None = None) -> list[str]:
    """Compact those partitions of a catalog table that hold several files below ``small_file_bytes`` (half the target)
    and could be fewer; all others keep their files.  Only the chosen partitions are read and written, next to the
    table, and each is then pointed at its copy (a metadata change).  Returns their folders' names; the old files stay
    for the retention policy."""
    import uuid
    by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not by:
        raise ValueError(f"{table} has no partitions: use compact_table")
    small = small_file_bytes or target_file_bytes // 2
    groups = _stored_files(spark, table).groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.count_if(F.col("length") < small).alias("small"))
    chosen = [r["folder"] for r in groups.where(
        (F.col("small") > 1) & (F.ceil(F.col("bytes") / target_file_bytes) < F.col("files"))).collect()]  # one row a partition
    if not chosen:
        return []
    values = {_partition_of(f, by): "/".join(f.split("/")[-len(by):]) for f in chosen}
    picked = spark.createDataFrame(list(values), ", ".join(f"`{k}` string" for k in by)).alias("p")
    rows, on = spark.table(table).alias("t"), F.lit(True)
    for k in by:
        on = on & F.col(f"t.{k}").cast("string").eqNullSafe(F.col(f"p.{k}"))
    new = f"{table_location(spark, table).rstrip('/')}_compact_{uuid.uuid4().hex[:12]}"
    (rows.join(F.broadcast(picked), on, "left_semi").hint("rebalance", *by).write.mode("errorifexists")
     .partitionBy(*by).parquet(new))
    for v, folder in values.items():
        spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(v, by)}) SET LOCATION '{new}/{folder}'")
    spark.catalog.refreshTable(table)
    return sorted(values.values())


def compact_table(spark: SparkSession, table: str, target_file_bytes: int = TARGET_FILE_BYTES) -> str:
    """Compact a catalog table: write the compacted copy next to the current
    files, then point the table, and each partition that the catalog knows, at it
    (a metadata change; no file is moved).  The copy is whole before the first
    change.  Returns the new location; the old files stay for the retention
    policy."""
    import uuid
    old = table_location(spark, table)
    new = f"{old.rstrip('/')}_compact_{uuid.uuid4().hex[:12]}"
    compact(spark, old, new, target_file_bytes)
    by = _partition_columns(spark, old)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    if by:  # one row for each partition of the catalog
        for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
            spec = ", ".join("{} = '{}'".format(k, unquote(v).replace("'", "\\'"))
                             for k, v in (x.split("=", 1) for x in r["partition"].split("/")))
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{new}/{r['partition']}'")
    spark.catalog.refreshTable(table)
    return new
