"""Loads that write batch by batch.

``load`` writes whole tasks; here every writer task forms batches by rows, bytes and time as its
rows arrive, and each batch is written, retried or turned away by itself:

* A batch is a Parquet file of its own below the task's attempt folder, written under another
  name and moved when whole. A transient failure is tried again as the retry policy allows;
  the other batches aren't written twice.
* A batch with a corrupt row stops the load, or (``failure="drop_batch"``) goes with its
  reasons and the corrupt rows' source records to a second output, in the same pass.
* A task's commit message names its attempt and holds its counters and histograms (rows,
  bytes and microseconds per batch). Attempts that no message names are deleted.
* Everything is staged below ``_staging`` and becomes visible by one rename to the folder of the
  *load id*. A load whose folder is there has been done: running it again, after any failure,
  writes nothing and returns what the first run reported. So a retried or repeated load can't
  double rows.

Layout of a table: ``<path>/<load id>/part-*/batch-*.parquet``, and in hidden folders beside the parts
``_rejected`` (rows of rejected batches) and ``_load`` (one JSON line). Plain Parquet readers
see the accepted rows only. The folder must be one that all workers reach, by a mounted path or any
URI that pyarrow knows.

Tasks hold one open batch. The driver holds a message per task, of bounded size: a
histogram has at most 57 * 128 buckets.

Edge cases: an empty load leaves a folder without batches; a record above the byte limit is a batch of its own
(above the record limit it fails the load); a time limit is looked at when rows arrive.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ladle.functions.sizes import header_bytes, row_payload_bytes
from ladle.operators.batching import reject_oversized
from ladle.operators.bindings import ERRORS_COL, Binding, TableSpec, bind_columns, check_bindings, default_for_omitted
from ladle.operators.failures import RetryPolicy, retry_batch
from ladle.sinks.table import LoadOptions, LoadResult, check_before_load, check_declared, known_schema, note_schema

RECORD_COL = "_record"
SUB_BITS = 7
LOG = ("load_id string, rows long, bytes long, batches long, dropped_batches long, dropped_rows long, retries long, seconds double, "
       "histograms map<string, map<string, long>>")


class CorruptBatchError(ValueError):
    """A batch holds a row that can't be written, and the policy is to stop."""


# -- histograms ------------------------------------------------------------------

def bucket_of(value: int) -> int:
    """The bucket of a whole number: exact below 256, then 128 buckets to each power of two."""
    shift = max(0, int(value).bit_length() - SUB_BITS - 1)
    return (shift << SUB_BITS) + (int(value) >> shift)


def bucket_floor(bucket: int) -> int:
    """The least number in a bucket; no other in it is larger by more than 1 / 128."""
    if bucket < 2 << SUB_BITS:
        return bucket
    shift = (bucket >> SUB_BITS) - 1
    return (bucket - (shift << SUB_BITS)) << shift


def add_buckets(into: dict[str, dict[str, int]], more: dict[str, dict[str, int]]) -> None:
    for name, counts in more.items():
        own = into.setdefault(name, {})
        for bucket, n in counts.items():
            own[bucket] = own.get(bucket, 0) + n


# -- the writer ------------------------------------------------------------------

def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def _kind(files: pafs.FileSystem, path: str) -> pafs.FileType:
    return files.get_file_info(path).type


@dataclass
class BatchCommit(WriterCommitMessage):
    """What a task attempt wrote: the name of its folders, its counters and its histograms."""

    attempt: str = ""
    rows: int = 0
    bytes: int = 0
    batches: int = 0
    dropped_batches: int = 0
    dropped_rows: int = 0
    retries: int = 0
    histograms: dict = field(default_factory=dict)

    def count(self, name: str, value: int, n: int = 1) -> None:
        add_buckets(self.histograms, {name: {str(bucket_of(value)): n}})

    def add(self, other: "BatchCommit") -> None:
        for name in ("rows", "bytes", "batches", "dropped_batches", "dropped_rows", "retries"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        add_buckets(self.histograms, other.histograms)


class BatchWriter(DataSourceArrowWriter):
    """Writes each task's rows batch by batch below ``staging``; ``commit`` makes them the load's folder."""

    def __init__(self, options: dict) -> None:
        self.options = options
        self.path, self.load_id, self.staging = options["path"], options["load_id"], options["staging"]

    def send(self, rows: pa.RecordBatch, name: str) -> None:
        """Writes one batch as the file ``name``; what a target of another kind would override."""
        files, path = file_system(name)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        partial = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
        with files.open_output_stream(partial) as out:
            pq.write_table(pa.Table.from_batches([rows]), out)
        files.move(partial, path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> BatchCommit:
        o, done = self.options, BatchCommit(f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}")
        most_rows, most_bytes, most_s = o["max_batch_size"], o["max_batch_bytes"], o["max_time_in_buffer_ms"] / 1000
        held: list[pa.RecordBatch] = []
        rows = size = 0
        since = 0.0

        def flush() -> None:
            nonlocal rows, size
            if rows:
                self._batch(pa.Table.from_batches(held).combine_chunks().to_batches()[0], rows, size, done)
                held.clear()
                rows = size = 0

        for some in iterator:
            upto = np.concatenate(([0], np.cumsum(some.column("_size").to_numpy(zero_copy_only=False))))
            at = 0
            while at < some.num_rows:
                if rows and time.monotonic() - since >= most_s:
                    flush()
                reached = int(np.searchsorted(upto, upto[at] + most_bytes - size, side="left"))
                end = reached if reached <= some.num_rows and upto[reached] == upto[at] + most_bytes - size else reached - 1
                end = min(end, at + most_rows - rows, some.num_rows)
                if end <= at and not rows:
                    end = at + 1  # above the limit by itself
                if end > at:
                    since = since if rows else time.monotonic()
                    held.append(some.slice(at, end - at))
                    rows, size, at = rows + end - at, size + int(upto[end] - upto[at]), end
                if rows >= most_rows or size >= most_bytes or at < some.num_rows:
                    flush()
        flush()
        return done

    def _batch(self, batch: pa.RecordBatch, rows: int, size: int, done: BatchCommit) -> None:
        number = done.batches + done.dropped_batches
        errors = batch.column(ERRORS_COL)
        bad = np.flatnonzero(np.diff(errors.offsets.to_numpy()) > 0)
        if len(bad) and self.options["failure"] == "stop":
            raise CorruptBatchError(f"Corrupt row in batch {number} of {done.attempt}: {errors[int(bad[0])].as_py()[0]}")
        if len(bad):
            kept = [n for n in batch.schema.names if n != "_size"]
            turned = batch.select(kept).append_column("_batch", pa.array([f"{done.attempt}/{number}"] * rows))
            self._send(turned, f"{self.staging}/_rejected/{done.attempt}/batch-{number:06d}.parquet", done)
            done.dropped_batches, done.dropped_rows = done.dropped_batches + 1, done.dropped_rows + rows
            return
        names = [n for n in batch.schema.names if n not in ("_size", ERRORS_COL, RECORD_COL)]
        self._send(batch.select(names), f"{self.staging}/{done.attempt}/batch-{number:06d}.parquet", done)
        done.rows, done.bytes, done.batches = done.rows + rows, done.bytes + size, done.batches + 1
        done.count("rows_per_batch", rows)
        done.count("bytes_per_batch", size)
        for value, n in zip(*np.unique(batch.column("_size").to_numpy(zero_copy_only=False), return_counts=True)):
            done.count("bytes_per_record", int(value), int(n))

    def _send(self, rows: pa.RecordBatch, name: str, done: BatchCommit) -> None:
        began = time.monotonic()

        def again(attempt: int, error: BaseException) -> None:
            nonlocal began
            done.count("failure_us", int((time.monotonic() - began) * 1e6))
            began = time.monotonic()

        most = self.options["max_retries"]
        attempts = retry_batch(lambda: self.send(rows, name), RetryPolicy(most), on_retry=again, sleep_s=self.options["retry_pause_s"])
        done.retries += attempts - 1
        done.count("write_us", int((time.monotonic() - began) * 1e6))

    def commit(self, messages: list[BatchCommit | None]) -> None:
        files, base = file_system(self.path)
        staged = file_system(self.staging)[1]
        whole, attempts = BatchCommit(), set()
        for message in messages:
            if message is not None:
                whole.add(message)
                attempts.add(message.attempt)
        files.create_dir(f"{staged}/_load", recursive=True)
        for folder in (staged, f"{staged}/_rejected"):
            if _kind(files, folder) == pafs.FileType.Directory:
                for info in files.get_file_info(pafs.FileSelector(folder)):
                    if info.base_name.startswith("part-") and info.base_name not in attempts:
                        files.delete_dir(info.path)
        log = {k: v for k, v in asdict(whole).items() if k != "attempt"} | {"load_id": self.load_id, "seconds": round(time.time() - self.options["began"], 3)}
        with files.open_output_stream(f"{staged}/_load/load.json") as out:
            out.write((json.dumps(log) + "\n").encode())
        if _kind(files, f"{base}/{self.load_id}") != pafs.FileType.NotFound:
            files.delete_dir(staged)  # done by another run meanwhile
            return
        files.move(staged, f"{base}/{self.load_id}")

    def abort(self, messages: list[BatchCommit | None]) -> None:
        files, staged = file_system(self.staging)
        if _kind(files, staged) != pafs.FileType.NotFound:
            files.delete_dir(staged)


class BatchTable(DataSource):
    """``df.write.format("ladle_batches")``; see :func:`load_batches`."""

    @classmethod
    def name(cls) -> str:
        return "ladle_batches"

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(json.loads(self.options["load"]))


# -- loads -----------------------------------------------------------------------

def load_batches(df: DataFrame, bindings: Sequence[Binding], path: str, load_id: str, options: LoadOptions | None = None,
                 table: TableSpec | None = None, target: type[DataSource] = BatchTable, retry_pause_s: float = 1.0) -> LoadResult:
    """Appends ``df`` through ``bindings`` as the load ``load_id`` of the table at ``path``, batch by batch; once only.

    Every input partition is a writer that batches its rows as they arrive: there is no
    shuffle, and as many writers as Spark has tasks. The result's ``metrics`` are the
    load's counters, and ``already_loaded``.
    """
    options, spark = (options or LoadOptions()).validate(), df.sparkSession
    if not load_id or load_id.startswith(("_", ".")) or "/" in load_id:
        raise ValueError("A load id names a folder; it can't begin with _ or . and has no /")
    check_bindings(bindings)
    check_declared(bindings, table)
    done = load_of(path, load_id)
    if done is not None:
        return LoadResult(path, done | {"already_loaded": True})
    declared = T.StructType([T.StructField(b.name, b.type.spark_type(), True) for b in bindings]) if table is None else table.schema()
    check_before_load(spark, path, declared, options)
    source = df.withColumn(RECORD_COL, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    typed = bind_columns(source, bindings, mode="report", null_unsigned=options.null_unsigned, json_as=options.json_as, keep=[RECORD_COL])
    sized = typed.withColumn("_size", row_payload_bytes([(b.name, b.type) for b in bindings]))
    sized, _ = reject_oversized(sized, F.col("_size"), options.max_record_bytes, mode="strict")
    # Only a corrupt row's source record is written out.
    sized = sized.withColumn(RECORD_COL, F.when(F.size(ERRORS_COL) > 0, F.col(RECORD_COL)))
    helpers = [RECORD_COL, ERRORS_COL, "_size"]
    rows = default_for_omitted(sized, table, keep=helpers) if table is not None else sized.select(*[b.name for b in bindings], *helpers)
    if table is not None and table.sort_key:
        rows = rows.sortWithinPartitions(*table.sort_key)
    said = {"path": path, "load_id": load_id, "staging": f"{path}/_staging/{load_id}-{uuid.uuid4().hex[:12]}", "failure": options.failure,
            "max_batch_size": options.max_batch_size, "max_batch_bytes": options.max_batch_bytes, "max_time_in_buffer_ms": options.max_time_in_buffer_ms,
            "max_retries": options.retry.max_retries, "retry_pause_s": retry_pause_s, "began": time.time()}
    spark.dataSource.register(target)
    rows.write.format(target.name()).mode("append").option("load", json.dumps(said)).save()
    metrics = load_of(path, load_id) or {}
    note_schema(spark, path, declared)
    header = header_bytes([(b.name, b.type) for b in bindings])
    return LoadResult(path, metrics | {"bytes_sent": metrics.get("bytes", 0) + header * metrics.get("batches", 0), "already_loaded": False})


def load_of(path: str, load_id: str) -> dict | None:
    """What a load that was done reported; None if it wasn't."""
    files, base = file_system(path)
    name = f"{base}/{load_id}/_load/load.json"
    if _kind(files, name) != pafs.FileType.File:
        return None
    with files.open_input_stream(name) as source:
        return json.loads(source.read())


def clear_staging(path: str) -> None:
    """Deletes what loads left behind whose driver was lost. No load may be running."""
    files, base = file_system(path)
    if _kind(files, f"{base}/_staging") != pafs.FileType.NotFound:
        files.delete_dir(f"{base}/_staging")


def _folders(path: str, name: str, load_id: str | None = None) -> list[str]:
    """The folders ``name`` of the loads that were done (or of one)."""
    files, base = file_system(path)
    if _kind(files, base) != pafs.FileType.Directory:
        return []
    loads = [x.base_name for x in files.get_file_info(pafs.FileSelector(base)) if x.type == pafs.FileType.Directory and not x.base_name.startswith("_")]
    return [f"{path}/{x}/{name}" for x in sorted(loads) if load_id in (None, x) and _kind(files, f"{base}/{x}/{name}") == pafs.FileType.Directory]


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows under its noted columns, also where every batch was rejected."""
    return spark.read.schema(known_schema(spark, path)).option("recursiveFileLookup", "true").parquet(path)


def read_rejected(spark: SparkSession, path: str, load_id: str | None = None) -> DataFrame:
    """Rows of rejected batches (of one load): the typed values, ``_errors`` and ``_record`` of corrupt ones, and ``_batch``."""
    schema = T.StructType(known_schema(spark, path).fields).add(RECORD_COL, "string").add(ERRORS_COL, T.ArrayType(T.StringType())).add("_batch", "string")
    folders = _folders(path, "_rejected", load_id)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*folders) if folders else spark.createDataFrame([], schema)


def load_log(spark: SparkSession, path: str) -> DataFrame:
    """A row per load of the table: its counters and histograms."""
    folders = _folders(path, "_load")
    return spark.read.schema(LOG).json(folders) if folders else spark.createDataFrame([], LOG)


def quantiles(log: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., metric, n, p<share in percent>...) of the merged histograms of a load log: of each metric's values the
    least at or above each share's rank, given as the floor of its bucket (short by 1 / 128 at most)."""
    rows = log.select(*by, F.explode("histograms").alias("metric", "buckets")).select(*by, "metric", F.explode("buckets").alias("bucket", "n"))
    merged = rows.groupBy(*by, "metric", F.col("bucket").cast("long").alias("bucket")).agg(F.sum("n").alias("n"))
    # At most 57 * 128 buckets a metric.
    found = merged.groupBy(*by, "metric").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("bucket", F.col("n").alias("n")))).alias("buckets"))

    def at(share: float):
        rank = F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(float(share))))
        walked = F.aggregate("buckets", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(-1).cast("long").alias("bucket")), lambda s, x: F.struct(
            (s["upto"] + x["n"]).alias("upto"), F.when((s["bucket"] < 0) & (s["upto"] + x["n"] >= rank), x["bucket"]).otherwise(s["bucket"]).alias("bucket")))
        bucket = walked["bucket"]
        shift = F.greatest(F.lit(0).cast("long"), F.floor(bucket / (1 << SUB_BITS)) - 1).cast("int")
        low = F.call_function("shiftleft", bucket - F.call_function("shiftleft", shift.cast("long"), F.lit(SUB_BITS)), shift)
        name = f"{share * 100:g}".replace(".", "_")
        return F.when(bucket < (2 << SUB_BITS), bucket).otherwise(low).alias(f"p{name}")

    return found.select(*by, "metric", "n", *[at(s) for s in shares])

