"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from measured shuffle
# sizes: an aggregated side is broadcast only when its *measured* size is
# below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the join
# stays a sort-merge join and AQE splits skewed partitions.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "24MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tresoria", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, pass the cluster's own settings
    through ``extra``; ``shuffle_partitions`` should then follow the data
    (about 128-256 MB of shuffle per partition; AQE coalesces the rest)."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on an existing session (e.g. the driver's)."""
    for k, v in CORE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a running session
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder (HDFS/S3/...); we only read it.  Without the
    setting a local session gets a folder of its own; a cluster session raises,
    since executors would write to disks that the others do not see.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master or ""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="tresoria-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_OPEN_STAGES: ContextVar[list | None] = ContextVar("open_stages", default=None)


@contextmanager
def stages_released(spark: SparkSession):
    """Delete the stage tables that :func:`materialize` writes inside the block when
    it ends.  For jobs that write their result inside, such as a load or a
    micro-batch: nothing read from those stages may be used afterwards."""
    token = _OPEN_STAGES.set([])
    try:
        yield
    finally:
        paths = _OPEN_STAGES.get()
        _OPEN_STAGES.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            at = jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(conf).delete(at, True)


def materialize(df, name: str = "stage"):
    """Cut the lineage of ``df``: write it as a Parquet table under the shared
    checkpoint folder (``spark.checkpoint.dir``) and continue from it.

    Used where a pipeline reads the same intermediate result several times
    (workbook cells, per-sheet bounds): the plan stays small, a lost executor
    re-reads the written files instead of recomputing the inputs, and later
    reads get column pruning and filter pushdown.  (``Dataset.checkpoint``
    would compute ``df`` twice: once to count, once to write.)  The folder is
    scratch space: its retention is the cluster's policy."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"stages/{name}-{uuid.uuid4().hex}")
    if (open_stages := _OPEN_STAGES.get()) is not None:
        open_stages.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
