"""The table loader: typed or raw rows -> checked, batched, policed, appended.

``load()`` runs the whole write path as one Spark plan:

    driver checks (bindings, options, drift, target)  ->  one select of checked
    casts  ->  payload sizes  ->  batch annotation (one shuffle by writer shard)
    ->  failure policy  ->  defaults + column order  ->  append  ->  metrics

Rows never come to the driver. Metrics are gathered with ``observe`` during
the write itself, so the whole load is one job; a lost executor only
recomputes its partitions from lineage (the fold is deterministic given the
total order).
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass, field, replace
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.conform import json_valid
from ladle.functions.sizes import header_bytes, normalize_raw_line, raw_payload_bytes, row_payload_bytes
from ladle.operators.batching import annotate_batches, hash_shard, reject_oversized
from ladle.operators.bindings import (
    ERRORS_COL,
    Binding,
    TableSpec,
    bind_columns,
    check_bindings,
    default_for_omitted,
)
from ladle.operators.failures import RetryPolicy, mark_bad, retry_batch
from ladle.operators.metrics import observed_load_metrics, sent_metrics
from ladle.sinks.connection import Connection


class SchemaDriftError(ValueError):
    """Declared column types differ from the target table's."""


class UnknownColumnError(ValueError):
    """A bound column that the declared table does not have."""


class BacklogModeError(ValueError):
    """Typed and raw loads cannot be mixed on one backlog."""


@dataclass
class LoadOptions:
    """Batch limits and policies.

    Fixed values: the defaults are the sink's own (500 rows, 50 in flight,
    10 000 buffered, 5 MiB, 5 000 ms, 1 MiB per record).

    ``max_in_flight`` and ``max_buffered`` are accepted for compatibility; Spark
    has no in-flight request window (parallelism comes from tasks).
    """

    max_batch_size: int = 500
    max_in_flight: int = 50
    max_buffered: int = 10_000
    max_batch_bytes: int = 5 * 1024 * 1024
    max_time_in_buffer_ms: int = 5_000
    max_record_bytes: int = 1024 * 1024
    # None: each input partition is one writer batching in arrival order (no
    # shuffle). A number: rows are hash-sharded to that many writers by the
    # ``order`` key and sorted, so batches do not depend on the input layout.
    # The number never follows the data's size: a row's writer, and with it the
    # rows that ``drop_batch`` drops, stay the same as a table grows. ``order``
    # must be unique, else equal rows pile up in one writer.
    shards: int | None = None
    failure: str = "stop"  # "stop" | "drop_batch"
    # Under "stop" batches change nothing that is written, so rows go from the
    # casts to the writer. Ask for the batch metrics to have them formed anyway.
    batch_metrics: bool = False
    # Rows go to writers by ranges of the declared table's sort key, so that a file holds one
    # span of it and readers' filters leave files out by their least and greatest values.
    cluster: bool = False
    json_as: str = "string"  # JSON columns stored as validated text, or "variant"
    # Ten more tries, with growing pauses; ``RetryPolicy.forever()`` if asked for.
    retry: RetryPolicy = field(default_factory=lambda: RetryPolicy.limited(10))
    null_unsigned: str = "zero"
    # Target: any Spark writer ("parquet" by default; e.g. "jdbc" with url/dbtable
    # options, which gets ``max_batch_size`` as its batch size), or "table": a table
    # of the catalog, by name. Free-form writer options are passed through unchanged.
    target_format: str = "parquet"
    writer_options: dict = field(default_factory=dict)
    # A database target with typed options: stands for target_format "jdbc" and its writer
    # options; ``writer_options`` are then settings that go over the connection's.
    connection: Connection | None = None
    require_table: bool = False  # preflight: the target must already exist
    # Request timeout per batch write: past it the write's Spark jobs are
    # cancelled and the load fails ("fail") or the write is retried ("retry").
    timeout_s: float | None = None
    on_timeout: str = "fail"

    def validate(self) -> "LoadOptions":
        for name in ("max_batch_size", "max_in_flight", "max_buffered", "max_batch_bytes",
                     "max_time_in_buffer_ms", "max_record_bytes"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        if self.max_buffered <= self.max_batch_size:
            raise ValueError("max_buffered must be greater than max_batch_size")
        if self.max_batch_bytes < self.max_record_bytes:
            raise ValueError("max_batch_bytes must be at least max_record_bytes")
        if self.failure not in ("stop", "drop_batch"):
            raise ValueError("failure must be 'stop' or 'drop_batch'")
        if self.connection is not None and self.target_format not in ("parquet", "jdbc"):
            raise ValueError("a connection is a jdbc target")
        if self.connection is not None and self.target_format == "parquet":
            settings = {"batchsize": self.max_batch_size} if "batchsize" not in self.connection.settings else {}
            return replace(self, target_format="jdbc", writer_options=self.connection.writer_options(settings | self.writer_options)).validate()
        if self.shards is not None and (not isinstance(self.shards, int) or self.shards <= 0):
            raise ValueError("shards must be a positive number or None")
        return self

    @property
    def forms_batches(self) -> bool:
        return self.failure == "drop_batch" or self.batch_metrics


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


#: Where a table of files keeps its columns, so that a load needn't read every file's footer.
SCHEMA_FILE = os.path.join("_ladle", "schema.json")


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def known_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns that loads have noted for the table at ``path``."""
    fs, p = _file(spark, os.path.join(path, SCHEMA_FILE))
    if not fs.exists(p):
        return None
    size, source = int(fs.getFileStatus(p).getLen()), fs.open(p)
    try:
        raw = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source, size)
    finally:
        source.close()
    return T.StructType.fromJson(json.loads(bytes(raw).decode()))


def note_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Notes columns that the table at ``path`` has from now on, beside those it had."""
    had = known_schema(spark, path)
    names = {f.name for f in had.fields} if had else set()
    whole = T.StructType([*(had.fields if had else []), *(f for f in schema.fields if f.name not in names)])
    if had is None or len(whole) != len(had):
        write_schema(spark, path, whole)


def write_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    fs, p = _file(spark, os.path.join(path, SCHEMA_FILE))
    out = fs.create(p, True)
    try:
        out.write(json.dumps(schema.jsonValue()).encode())
    finally:
        out.close()


def target_schema(spark: SparkSession, path: str, options: "LoadOptions | None" = None) -> T.StructType | None:
    """The target's columns, or None if it does not exist yet (or its reader cannot tell).

    A table of files is asked for the columns that loads have noted. Where none are, its files
    are found below ``path`` at any depth, so a table that streams and batch loads have
    written in turn is seen whole.
    """
    fmt = options.target_format if options else "parquet"
    if fmt == "table":
        return spark.table(path).schema if spark.catalog.tableExists(path) else None
    if fmt == "jdbc":
        try:
            return spark.read.format("jdbc").options(**options.writer_options).load().schema
        except Exception as e:  # noqa: BLE001 - a table that is not there; anything else is the writer's to report
            if options.require_table:
                raise FileNotFoundError(f"Target table {options.writer_options.get('dbtable')} cannot be read: {e}") from e
            return None
    if not table_exists(spark, path):
        return None
    if fmt not in ("parquet", "orc"):
        return T.StructType([])
    noted = known_schema(spark, path)
    if noted is not None:
        return noted
    try:
        return read_table(spark, path, fmt=fmt).schema
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):  # a folder without files yet
            return T.StructType([])
        raise


def preflight(spark: SparkSession, path: str, must_exist: bool = False, attempts: int = 3,
              wait_s: float = 1.0, options: "LoadOptions | None" = None) -> None:
    """Check the target before writing: up to ``attempts`` checks, ``wait_s``
    apart (the sink pings its server 3 times, 1 s apart), then fail."""
    if not must_exist:
        return
    for i in range(attempts):
        try:
            if target_schema(spark, path, options) is not None:
                return
        except FileNotFoundError:
            if i + 1 == attempts:
                raise
        if i + 1 < attempts:
            time.sleep(wait_s)
    raise FileNotFoundError(f"Target table {path} does not exist")


def _family(kind: T.DataType) -> str:
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return "number"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    return kind.simpleString()


def check_drift(spark: SparkSession, path: str, declared: T.StructType, options: "LoadOptions | None" = None) -> None:
    """Reject a load whose declared types differ from the existing table's."""
    existing = target_schema(spark, path, options)
    if existing is None:
        return
    have = {f.name: f.dataType for f in existing.fields}
    jdbc = options is not None and options.target_format == "jdbc"
    for f in declared.fields:
        # A database may name another width; whether it holds numbers, texts or times is no matter of width.
        if f.name in have and (_family(have[f.name]) != _family(f.dataType) if jdbc else have[f.name] != f.dataType):
            raise SchemaDriftError(f"Column {f.name}: declared {f.dataType.simpleString()}, "
                                   f"table has {have[f.name].simpleString()}")
        if have and f.name not in have and options is not None and options.target_format in ("jdbc", "table"):
            raise UnknownColumnError(f"Column {f.name} is not in the target table {path}")


def check_declared(bindings: Sequence[Binding], table: TableSpec | None) -> None:
    """Reject bound columns that the declared table lacks or has with another type."""
    if table is None:
        return
    have = {c.name: c.type for c in table.columns}
    for b in bindings:
        if b.name not in have:
            raise UnknownColumnError(f"Column {b.name} is not declared in table {table.name}")
        if have[b.name].spark_type() != b.type.spark_type():
            raise SchemaDriftError(f"Column {b.name}: bound as {b.type.spark_type().simpleString()}, "
                                   f"declared {have[b.name].spark_type().simpleString()}")


def _write(df: DataFrame, path: str, table: TableSpec | None, mode: str = "append",
           options: LoadOptions | None = None) -> None:
    if table is not None and table.sort_key:
        if options is not None and options.cluster:
            df = df.repartitionByRange(*table.sort_key)
        df = df.sortWithinPartitions(*table.sort_key)
    fmt = options.target_format if options else "parquet"
    extra = dict(options.writer_options) if options else {}
    if fmt == "table":
        df.write.format(extra.pop("provider", "parquet")).mode(mode).options(**extra).saveAsTable(path)
        return
    if fmt == "jdbc":
        extra.setdefault("batchsize", str(options.max_batch_size))
    w = df.write.format(fmt).mode(mode).options(**extra)
    if fmt == "jdbc":
        w.save()
    else:
        w.save(path)


def check_backlog_mode(spark: SparkSession, path: str, raw: bool, df: DataFrame | None = None,
                       line_col: str = "value") -> None:
    """A typed load refuses a target that holds an undrained raw backlog (a
    table of text lines); a raw load needs a text line column as input."""
    if raw:
        if df is not None and (line_col not in df.columns
                               or not isinstance(df.schema[line_col].dataType, (T.StringType, T.BinaryType))):
            raise BacklogModeError(f"A raw load needs a text column {line_col!r}; got typed rows")
        return
    cols = target_schema(spark, path)
    if cols is not None:
        if len(cols) == 1 and cols[0].name == line_col and isinstance(cols[0].dataType, T.StringType):
            raise BacklogModeError("Target holds a raw backlog; drain it with a raw load before a typed load")


@dataclass
class LoadResult:
    path: str
    metrics: dict


def prepare(df: DataFrame, bindings: Sequence[Binding], options: LoadOptions, order: Sequence[str],
            event_time: str | None = None) -> DataFrame:
    """Checked, sized and batch-annotated rows (lazy; nothing runs yet)."""
    options.validate()
    check_bindings(bindings)
    mode = "strict" if options.failure == "stop" else "report"
    typed = bind_columns(df, bindings, mode=mode, null_unsigned=options.null_unsigned, json_as=options.json_as)
    if mode == "strict":
        typed = typed.withColumn(ERRORS_COL, F.array().cast("array<string>"))
    typed = typed.withColumn("_size", row_payload_bytes([(b.name, b.type) for b in bindings]))
    typed, _ = reject_oversized(typed, F.col("_size"), options.max_record_bytes, mode="strict")
    if not options.forms_batches:
        if options.shards:
            typed = typed.repartition(options.shards, *order).sortWithinPartitions(*([event_time] if event_time else []), *order)
        return typed
    if options.shards:
        shard = hash_shard(order, options.shards)
        ordering = ([event_time] if event_time else []) + [o for o in order if o != event_time]
    else:
        shard, ordering = None, ([event_time] if event_time else [])
    return annotate_batches(mark_bad(typed), shard, ordering, size=F.col("_size"),
                            max_rows=options.max_batch_size, max_bytes=options.max_batch_bytes,
                            ts=F.col(event_time) if event_time else None,
                            max_time_ms=options.max_time_in_buffer_ms if event_time else None,
                            complete=True, bad="_bad")


def check_before_load(spark: SparkSession, path: str, declared: T.StructType, options: LoadOptions) -> None:
    """What a typed load asks of its target: that it is there if it must be, holds no raw backlog, and has the same types."""
    preflight(spark, path, must_exist=options.require_table, options=options)
    if options.target_format == "parquet":
        check_backlog_mode(spark, path, raw=False)
    check_drift(spark, path, declared, options)


def load(df: DataFrame, bindings: Sequence[Binding], path: str, options: LoadOptions | None = None,
         order: Sequence[str] | None = None, table: TableSpec | None = None,
         event_time: str | None = None, write_mode: str = "append", check_target: bool = True) -> LoadResult:
    """Append ``df`` to the Parquet table at ``path`` through ``bindings``.

    ``order`` names target columns giving the total order rows are sent in
    (and the shard hash); ``event_time`` enables the time limit on event time.
    ``check_target=False`` leaves out the target's checks (a stream makes them
    once, when it starts).
    """
    options = (options or LoadOptions()).validate()
    spark = df.sparkSession
    order = list(order or [b.name for b in bindings])
    declared = T.StructType([T.StructField(b.name, b.type.spark_type(), True) for b in bindings])
    check_declared(bindings, table)
    if check_target:
        check_before_load(spark, path, declared, options)
    ann = prepare(df, bindings, options, order, event_time)
    names = [b.name for b in bindings]
    hdr = header_bytes([(b.name, b.type) for b in bindings])
    metrics = _write_observed(ann, names, path, table, options, hdr, write_mode)
    if check_target and options.target_format in ("parquet", "orc"):
        note_schema(spark, path, table.schema() if table is not None else declared)
    return LoadResult(path, metrics)


def _write_observed(ann: DataFrame, names: Sequence[str], path: str, table: TableSpec | None,
                    options: LoadOptions, hdr: int, write_mode: str = "append") -> dict:
    """Apply the failure policy and append, gathering the metrics in the same
    job with ``observe`` (one pass; a retried write observes again)."""
    # Batches come whole from the fold with ``_batch_bad`` set, so the drop
    # policy is a filter (no window, no extra exchange). Under "stop" a bad
    # value has already raised.
    flagged = ann
    result = {}

    def write():
        obs = Observation(f"ladle_load_{uuid.uuid4().hex[:12]}")
        if "_batch_bad" in flagged.columns:
            out = flagged.observe(obs, *observed_load_metrics(hdr)).where(F.col("_batch_bad") == 0).select(*names)
        else:
            out = flagged.observe(obs, *sent_metrics()).select(*names)
        if table is not None:
            out = default_for_omitted(out, table)
        _write(out, path, table, write_mode, options)
        result.clear()
        result.update(obs.get)

    t0 = time.time()
    attempts = retry_batch(write, options.retry, timeout_s=options.timeout_s, on_timeout=options.on_timeout,
                           spark=ann.sparkSession)
    result["retries"] = attempts - 1
    # A retried write re-submits every batch: retries count as requests again.
    result["requests_submitted"] = (result.get("requests") or 0) * attempts
    result["write_seconds"] = round(time.time() - t0, 3)
    return result


# -- raw text lines ------------------------------------------------------------

#: The text formats of raw loads.
RAW_FORMATS = ("csv", "json", "tsv", "json_rows")
#: The field that means NULL, and what may follow a backslash (another character stands for itself).
NULL_FIELD = "\\N"
ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "0": "\0", "a": "\a", "v": "\v"}


def unescaped(field: Column) -> Column:
    """A field of escaped text with its escapes resolved, in column expressions.

    What lies between doubled backslashes is resolved by itself, so none of its backslashes is an escaped one.
    """

    def resolved(part: Column) -> Column:
        for letter, character in ESCAPES.items():
            part = F.replace(part, F.lit("\\" + letter), F.lit(character))
        return F.replace(part, F.lit("\\"), F.lit(""))

    parts = F.split(field, r"\\\\", -1)
    return F.when(field.contains("\\"), F.array_join(F.transform(parts, resolved), "\\")).otherwise(field)


CSV_QUOTED_RE = r'"(?:[^"]|"")*"'


def _csv_field_count(body):
    """Fields of a CSV line: commas outside quoted segments, plus one (the
    quoted-segment regex only runs on lines that contain a quote)."""
    def commas(x):
        return F.length(x) - F.length(F.replace(x, F.lit(","), F.lit(""))) + 1
    return F.when(body.contains('"'), commas(F.regexp_replace(body, CSV_QUOTED_RE, ""))).otherwise(commas(body))


def parse_raw(lines: DataFrame, table: TableSpec, raw_format: str = "csv", line_col: str = "value",
              mode: str = "report", keep: Sequence[str] = ()) -> DataFrame:
    """Parse raw lines of a text format against the *table* schema (the server-side
    parse of a raw load), with the table's null and default rules.

    ``csv``: an empty field takes the column DEFAULT, else '' for strings and NULL
    otherwise (an error for a non-nullable column); ``\\N`` is NULL; a line with the wrong
    number of fields (quotes respected) is corrupt. ``json``: an absent key takes
    the DEFAULT, else NULL; an explicit ``null`` stays NULL; a line that is not
    a JSON object is corrupt. ``tsv``: fields between tabs, with backslash escapes; ``\\N`` is
    NULL, an empty field is as in CSV. ``json_rows``: a JSON array of the columns' values
    in order; ``null`` is NULL.

    Staged projections: each line is parsed once (one struct column), then the
    typed values come from :func:`bind_columns` over plain field references.
    """
    keep = list(keep)
    n = len(table.columns)
    body = F.regexp_replace(normalize_raw_line(F.col(line_col)), "\n$", "")
    s1 = lines.select(*keep, F.col(line_col).alias("__line"), body.alias("__body"))
    if raw_format == "csv":
        schema = ", ".join(f"`_f{i}` STRING" for i in range(n))
        # No text equals the null marker, so a NULL field can only be an empty one.
        # Quotes inside quoted fields are doubled (RFC 4180), hence escape='"'.
        s2 = s1.select(*keep, "__line", F.from_csv("__body", schema, {"nullValue": "\u0001", "emptyValue": "", "escape": '"'})
                       .alias("__rec"), _csv_field_count(F.col("__body")).alias("__nf"))
        shape_err = (F.when(F.col("__line").isNull(), F.lit("Null record"))
                     .when(F.col("__nf") != F.lit(n), F.lit(f"Expected {n} fields")))
        held = [F.col("__rec")[f"_f{i}"] for i in range(n)]
        fields, absent = [F.when(f != NULL_FIELD, f) for f in held], [f.isNull() for f in held]
    elif raw_format == "json":
        schema = ", ".join(f"`{c.name}` STRING" for c in table.columns)
        s2 = s1.select(*keep, "__line", F.from_json("__body", schema, {"mode": "PERMISSIVE"}).alias("__rec"),
                       F.json_object_keys("__body").alias("__keys"))
        shape_err = (F.when(F.col("__line").isNull(), F.lit("Null record"))
                     .when(F.col("__keys").isNull() | F.col("__rec").isNull(), F.lit("Cannot parse JSON object")))
        fields = [F.col("__rec")[c.name] for c in table.columns]
        absent = [~F.coalesce(F.array_contains("__keys", c.name), F.lit(False)) for c in table.columns]
    elif raw_format == "tsv":
        s2 = s1.select(*keep, "__line", F.split("__body", "\t", -1).alias("__rec"))
        shape_err = (F.when(F.col("__line").isNull(), F.lit("Null record"))
                     .when(F.size("__rec") != F.lit(n), F.lit(f"Expected {n} fields")))
        held = [F.get("__rec", F.lit(i)) for i in range(n)]
        fields = [F.when((f != "") & (f != NULL_FIELD), unescaped(f)) for f in held]
        absent = [F.coalesce(f == "", F.lit(False)) for f in held]
    elif raw_format == "json_rows":
        s2 = s1.select(*keep, "__line", F.from_json("__body", "array<string>", {"mode": "PERMISSIVE"}).alias("__rec"), (json_valid(F.col("__body")) & F.ltrim("__body").startswith("[")).alias("__ok"))
        shape_err = (F.when(F.col("__line").isNull(), F.lit("Null record"))
                     .when(~F.col("__ok") | F.col("__rec").isNull(), F.lit("Cannot parse JSON array"))
                     .when(F.size("__rec") != F.lit(n), F.lit(f"Expected {n} fields")))
        fields = [F.get("__rec", F.lit(i)) for i in range(n)]
        absent = [F.lit(False)] * n
    else:
        raise ValueError(f"raw_format must be one of {', '.join(RAW_FORMATS)}")
    srcs = []
    for i, (c, f, miss) in enumerate(zip(table.columns, fields, absent)):
        if c.default is not None:
            src = F.when(miss, F.expr(c.default).cast("string")).otherwise(f)
        elif raw_format in ("csv", "tsv") and c.type.name in ("String", "FixedString"):
            src = F.when(miss, F.lit("")).otherwise(f)
        else:
            src = F.when(~miss, f)
        srcs.append(src.alias(f"__s{i}"))
    s3 = s2.select(*keep, "__line", shape_err.alias("__shape"), *srcs)
    typed = bind_columns(s3, [Binding(f"__s{i}", c.name, c.type) for i, c in enumerate(table.columns)],
                         mode="report", keep=[*keep, "__line", "__shape"])
    ok = F.col("__shape").isNull()
    out = typed.select(*keep, *[F.when(ok, F.col(c.name)).alias(c.name) for c in table.columns],
                       F.when(ok, F.col(ERRORS_COL)).otherwise(F.array(F.col("__shape"))).alias(ERRORS_COL),
                       F.coalesce(raw_payload_bytes(F.col("__line")), F.lit(0)).alias("_size"))
    if mode == "strict":
        # Raise in a projection on every output column (a filter would be
        # pushed below, and re-run, the parse; a single check column could be
        # pruned away by a caller that does not read it).
        bad = F.size(ERRORS_COL) > 0
        raise_first = F.raise_error(F.element_at(ERRORS_COL, 1))
        out = out.select(*keep, *[F.when(bad, raise_first).otherwise(F.col(c.name)).alias(c.name)
                                  for c in table.columns], ERRORS_COL, "_size")
    return out


def load_raw(lines: DataFrame, table: TableSpec, path: str, raw_format: str = "csv",
             options: LoadOptions | None = None, line_col: str = "value") -> LoadResult:
    """Append raw text lines; rows are parsed against the table, batched by the
    raw line size, and policed like a typed load."""
    options = (options or LoadOptions()).validate()
    spark = lines.sparkSession
    check_backlog_mode(spark, path, raw=True, df=lines, line_col=line_col)
    preflight(spark, path, must_exist=options.require_table, options=options)
    mode = "strict" if options.failure == "stop" else "report"
    # Lines are batched in arrival order: per input partition by default, or
    # hash-sharded by an id that follows input partition and row order
    # (deterministic for file sources, so a recomputed partition gets the same
    # ids).
    parsed = parse_raw(lines.withColumn("_line_id", F.monotonically_increasing_id()), table, raw_format,
                       line_col, mode, keep=["_line_id"])
    parsed, _ = reject_oversized(parsed, F.col("_size"), options.max_record_bytes, mode="strict")
    key = ["_line_id"]
    if not options.forms_batches:
        rows = parsed.repartition(options.shards, *key) if options.shards else parsed
        return LoadResult(path, _write_observed(rows, table.names, path, table, options, 0))
    shard = hash_shard(key, options.shards) if options.shards else None
    ann = annotate_batches(mark_bad(parsed), shard, key if options.shards else [], size=F.col("_size"),
                           max_rows=options.max_batch_size, max_bytes=options.max_batch_bytes,
                           complete=True, bad="_bad")
    metrics = _write_observed(ann, table.names, path, table, options, 0)
    return LoadResult(path, metrics)


def read_table(spark: SparkSession, path: str, merge_schema: bool = True, fmt: str = "parquet") -> DataFrame:
    """All rows below ``path``, whether batch loads or streams wrote them."""
    return spark.read.format(fmt).option("mergeSchema", str(merge_schema).lower()).option("recursiveFileLookup", "true").load(path)


def table_path(base: str, name: str) -> str:
    return os.path.join(base, name)
