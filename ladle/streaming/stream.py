"""Structured Streaming loads: restart without loss, schema evolution, backlog.

A stream is loaded micro-batch by micro-batch with ``foreachBatch``. Each is
written to its own folder ``_stream=<stream>/_batch_id=<id>`` with overwrite, so a
micro-batch replayed after a failure replaces its earlier partial output instead
of duplicating it: exactly-once on top of Spark's replayable sources and
checkpointed offsets (stronger than the sink's at-least-once). The stream's name is
drawn once and kept with its checkpoint: another stream, whose batch numbers start
at 0 again, or a batch load into the same table adds rows and replaces none.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators.bindings import Binding, TableSpec
from ladle.sinks.table import LoadOptions, check_before_load, load, note_schema, read_table

BATCH_COL = "_batch_id"
STREAM_COL = "_stream"
STREAM_FILE = "ladle-stream"
#: Micro-batches whose metrics a report keeps.
REPORTED = 1000


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream with this checkpoint, drawn when it is first asked for."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(checkpoint, STREAM_FILE))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        with_name = fs.open(path)
        try:
            return with_name.readLine()
        finally:
            with_name.close()
    name = uuid.uuid4().hex[:16]
    out = fs.create(path, False)
    out.writeBytes(name + "\n")
    out.close()
    return name


def batch_folder(path: str, stream: str, batch_id: int) -> str:
    return os.path.join(path, f"{STREAM_COL}={stream}", f"{BATCH_COL}={batch_id}")


class StreamLoadReport:
    """Metrics of the last ``REPORTED`` committed micro-batches, and counts over all of them."""

    def __init__(self):
        self.batches: dict[int, dict] = {}
        self._counts: dict = {}

    def add(self, batch_id: int, metrics: dict) -> None:
        self.batches[batch_id] = metrics
        if len(self.batches) > REPORTED:
            del self.batches[min(self.batches)]
        for name, value in metrics.items():
            # Averages, extremes and percentiles of micro-batches don't add up.
            if not name.startswith(("rows_per_batch", "bytes_per_batch")):
                self._counts[name] = self._counts.get(name, 0) + (value or 0)

    def totals(self) -> dict:
        """Sums of the counters (rows, bytes, requests, drops, retries, seconds)."""
        return dict(self._counts)


def batch_writer(bindings: Sequence[Binding], path: str, stream: str, table: TableSpec | None = None,
                 options: LoadOptions | None = None, order: Sequence[str] | None = None,
                 event_time: str | None = None, report: StreamLoadReport | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a stream load: the same :func:`load`
    (checked casts, batching, failure policy, observed metrics) per micro-batch,
    written to the micro-batch's folder with overwrite so a replay is idempotent.
    """
    options = options or LoadOptions()

    def write(batch_df: DataFrame, batch_id: int) -> None:
        res = load(batch_df, bindings, batch_folder(path, stream, batch_id), options, order=order, table=table,
                   event_time=event_time, write_mode="overwrite", check_target=False)
        if report is not None:
            report.add(batch_id, res.metrics)

    return write


def stream_load(stream: DataFrame, bindings: Sequence[Binding], path: str, checkpoint: str,
                table: TableSpec | None = None, options: LoadOptions | None = None,
                order: Sequence[str] | None = None, event_time: str | None = None,
                available_now: bool = True, processing_time: str | None = None,
                query_name: str | None = None,
                report: StreamLoadReport | None = None):
    """Start (and, with ``available_now``, finish) a stream load.

    Restarting on the same ``checkpoint`` resumes from the committed offsets;
    the micro-batch in flight at a crash is replayed and overwrites its folder.
    """
    spark, options = stream.sparkSession, (options or LoadOptions()).validate()
    declared = T.StructType([T.StructField(b.name, b.type.spark_type(), True) for b in bindings])
    check_before_load(spark, path, declared, options)  # once, not per micro-batch
    if options.target_format in ("parquet", "orc"):
        note_schema(spark, path, table.schema() if table is not None else declared)
    w = stream.writeStream.foreachBatch(batch_writer(bindings, path, stream_id(spark, checkpoint), table, options, order, event_time, report))
    w = w.option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    """The loaded table, schemas merged, with the micro-batch of each row (null for batch loads)."""
    place = F.regexp_extract(F.col("_metadata.file_path"), f"/{BATCH_COL}=([0-9]+)/", 1)
    return read_table(spark, path).withColumn(BATCH_COL, F.when(place != "", place.cast("bigint")))


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1,
                fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).format(fmt).load(path)


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows written before a column was added read it as NULL."""
    return old.unionByName(new, allowMissingColumns=True)
