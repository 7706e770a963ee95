"""Continuous ingestion of workbooks and CSV exports with Structured Streaming.

The file source's checkpoint *is* the processed-file manifest: a file is
read once, in the first micro-batch after it appears.  Each micro-batch of
workbooks decodes them, runs the batch pipeline (bounds, unpivot, gate) and
writes its result under ``lot=<batch id>`` with overwrite, so a batch that
is retried after a failure replaces its own output instead of duplicating
it.  Workbooks that cannot be read are listed beside the result
(:func:`read_rejected`) and don't stop the query.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tresoria.operators.cells import adjustments, ingest_forecast
from tresoria.session import materialize, stages_released
from tresoria.sources.sinks import prepare_for_load
from tresoria.sources.workbook import decode_checked

LAYOUTS = ("multi", "single", "adjustments")
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _pipeline(cells: DataFrame, layout: str) -> DataFrame:
    if layout == "adjustments":
        return adjustments(cells, prepared=True)
    return ingest_forecast(cells, layout, prepared=True)


def _lot(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/lot={batch_id}"


def _rejected(sink_path: str) -> str:
    return f"{sink_path.rstrip('/')}_rejected"


def workbook_stream(spark: SparkSession, source_dir: str, glob: str = "*.xlsx",
                    max_files_per_batch: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true"))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    return reader.load(source_dir)


def start_ingest(spark: SparkSession, source_dir: str, sink_path: str, checkpoint_path: str,
                 layout: str = "multi", glob: str = "*.xlsx", available_now: bool = True,
                 max_files_per_batch: int | None = None, load_date: str | None = None):
    """Start the ingestion query; returns the ``StreamingQuery``.

    ``available_now`` processes what is there and stops (scheduled runs);
    otherwise the query keeps watching the folder."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        with stages_released(batch.sparkSession):
            decoded = materialize(decode_checked(batch), "cells")
            out = prepare_for_load(_pipeline(decoded.where("error is null").drop("error"), layout), load_date)
            out.write.mode("overwrite").parquet(_lot(sink_path, batch_id))
            decoded.where("error is not null").select(F.col("file").alias("name"), F.col("error").alias("reason")).write.mode(
                "overwrite").parquet(_lot(_rejected(sink_path), batch_id))

    files = workbook_stream(spark, source_dir, glob, max_files_per_batch)
    return _start(files, run_batch, checkpoint_path, available_now)


def _start(rows: DataFrame, run_batch, checkpoint_path: str, available_now: bool):
    w = rows.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_export_ingest(spark: SparkSession, source_dir: str, columns: Sequence[str], sink_path: str, checkpoint_path: str,
                        sep: str = ";", glob: str = "*.csv", available_now: bool = True,
                        max_files_per_batch: int | None = None, load_date: str | None = None,
                        on_written: Callable[[int], None] | None = None):
    """Start the ingestion of separated exports (header line, every column as text) under ``source_dir``; returns the
    ``StreamingQuery``.

    A micro-batch replaces its own lot, so one that is written and then stops before its commit (``on_written`` may
    raise there) is written again by the next start, once.  Rows are read with :func:`read_ingested`."""
    reader = (spark.readStream.schema(", ".join(f"`{c}` string" for c in columns)).option("sep", sep).option("header", "true")
              .option("pathGlobFilter", glob).option("recursiveFileLookup", "true"))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        prepare_for_load(batch, load_date).write.mode("overwrite").parquet(_lot(sink_path, batch_id))
        if on_written:
            on_written(batch_id)

    return _start(reader.csv(source_dir), run_batch, checkpoint_path, available_now)


def read_ingested(spark: SparkSession, sink_path: str) -> DataFrame:
    """All batches written so far (the ``lot`` column tells the batch)."""
    return spark.read.parquet(sink_path).withColumn("lot", F.col("lot").cast("long"))


def read_rejected(spark: SparkSession, sink_path: str) -> DataFrame:
    """(name, reason, lot) of the workbooks that could not be read."""
    return spark.read.parquet(_rejected(sink_path)).withColumn("lot", F.col("lot").cast("long"))
