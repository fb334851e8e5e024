"""§2.1 sources, §2.2 sinks and §2.8 restart / evolution / backlog queries.

These queries write real files (under the session's shared checkpoint folder)
and read them back, so the whole write path runs on each call.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from ladle.functions.sizes import normalize_raw_line
from ladle.operators.bindings import TableSpec, of
from ladle.plans.batches import ORDERS_PAYLOAD_SQL, STREAM_ALL_LIMITS_SQL
from ladle.plans.oracle_sql import str_bytes_sql
from ladle.plans.registry import register, scratch_path, table
from ladle.sinks import evolution
from ladle.sinks.batches import load_batches, load_log, quantiles, read_accepted, read_rejected
from ladle.sinks.table import LoadOptions, load, load_raw, read_table
from ladle.sources.text import Field, parse_delimited, scan_text_lines
from ladle.streaming.stream import batch_writer, file_stream, read_loaded, stream_id, stream_load

ORDER_LINE_SQL = ("concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, "
                  "strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority)")


def _order_line():
    return F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"))


@register("scan_text_lines", f"SELECT {ORDER_LINE_SQL} AS value, length({ORDER_LINE_SQL}) AS n_chars FROM orders")
def q_scan_text_lines(spark, sf_dir):
    """orders written as gzip CSV text, read back one record per line."""
    path = scratch_path(spark, "orders-text")
    table(spark, sf_dir, "orders").select(_order_line().alias("value")).write.option(
        "compression", "gzip").text(path)
    back = scan_text_lines(spark, path)
    return back.select("value", F.length("value").alias("n_chars"))


COVID_FIELDS = [Field("date", "date", 0), Field("location_key", "string", 1),
                Field("new_confirmed", "int_blank_zero", 2), Field("new_deceased", "int_blank_zero", 3),
                Field("new_recovered", "int_blank_zero", 4), Field("new_tested", "int_blank_zero", 5),
                Field("cumulative_confirmed", "int_blank_zero", 6), Field("cumulative_deceased", "int_blank_zero", 7),
                Field("cumulative_recovered", "zero"), Field("cumulative_tested", "zero")]


def _record_lines(o):
    k = F.col("o_orderkey")
    blank_if = lambda cond, v: F.when(cond, F.lit("")).otherwise(v.cast("string"))
    return o.select(k, F.concat_ws(
        ",", F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit("-"), F.col("o_custkey").cast("string")),
        blank_if(k % 7 == 0, k % 1000), F.col("o_custkey").cast("string"), blank_if(k % 5 == 0, k % 50),
        F.concat(F.lit(" "), (k % 97).cast("string"), F.lit(" ")), (F.col("o_custkey") * 2).cast("string"),
        (k % 3).cast("string"), F.lit("999"), F.lit("888")).alias("value"))


@register("parse_csv_record", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_orderstatus || '-' || CAST(o_custkey AS VARCHAR) AS location_key,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 1000 END AS INTEGER) AS new_confirmed,
       CAST(o_custkey AS INTEGER) AS new_deceased,
       CAST(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 50 END AS INTEGER) AS new_recovered,
       CAST(o_orderkey % 97 AS INTEGER) AS new_tested, CAST(o_custkey * 2 AS INTEGER) AS cumulative_confirmed,
       CAST(o_orderkey % 3 AS INTEGER) AS cumulative_deceased, 0 AS cumulative_recovered, 0 AS cumulative_tested
FROM orders""")
def q_parse_csv_record(spark, sf_dir):
    """CSV records built from orders (blank fields, padded fields) parsed back."""
    lines = _record_lines(table(spark, sf_dir, "orders"))
    return parse_delimited(lines, COVID_FIELDS, keep=["o_orderkey"])


ORDER_BINDINGS = [("o_orderkey", "UInt64"), ("o_custkey", "Int64"), ("o_orderstatus", "LowCardinality(String)"),
                  ("o_totalprice", "Decimal(12, 2)"), ("o_orderdate", "Date"), ("o_orderpriority", "String")]
ORDERS_TYPED_SQL = ("SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS o_orderkey, o_custkey, o_orderstatus, "
                    "CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
                    "o_orderpriority FROM orders")


@register("sink_typed_append", ORDERS_TYPED_SQL)
def q_sink_typed_append(spark, sf_dir):
    """Typed load of orders appended to a Parquet table, then read back."""
    path = scratch_path(spark, "orders-typed")
    spec = TableSpec.of("orders", ORDER_BINDINGS, sort_key=["o_orderkey"])
    load(table(spark, sf_dir, "orders"), [of(c, c, t) for c, t in ORDER_BINDINGS], path, table=spec)
    return read_table(spark, path)


BATCH_ROWS = 5000


@register("sink_batches", f"""
SELECT count(*)::BIGINT AS n_rows, sum({ORDERS_PAYLOAD_SQL})::BIGINT AS n_bytes, count(*)::BIGINT AS rows_read, sum(o_orderkey)::BIGINT AS key_sum,
       true AS within_limit, true AS file_per_batch FROM orders""")
def q_sink_batches(spark, sf_dir):
    """orders written batch by batch, each a file: what the load reports against what is read back."""
    path = scratch_path(spark, "orders-batches")
    load_batches(table(spark, sf_dir, "orders"), [of(c, c, t) for c, t in ORDER_BINDINGS], path, "all", LoadOptions(max_batch_size=BATCH_ROWS))
    files = read_table(spark, path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    read = files.groupBy(F.regexp_extract("file", "([^/]+)/part-[^/]+/[^/]+$", 1).alias("load_id")).agg(
        F.sum("n").alias("rows_read"), F.sum("keys").cast("bigint").alias("key_sum"), F.max("n").alias("most"), F.count(F.lit(1)).alias("files"))
    return load_log(spark, path).join(read, "load_id").select(
        F.col("rows").alias("n_rows"), F.col("bytes").alias("n_bytes"), "rows_read", "key_sum",
        (F.col("most") <= BATCH_ROWS).alias("within_limit"), (F.col("files") == F.col("batches")).alias("file_per_batch"))


def _by_value(spark, df, column):
    """(a name for a load, its rows) for each value of a column of a few values."""
    for i, r in enumerate(df.groupBy(column).count().orderBy(column).collect()):
        yield f"part-{i}", df.where(F.col(column).eqNullSafe(F.lit(r[0])))


@register("load_once", ORDERS_TYPED_SQL)
def q_load_once(spark, sf_dir):
    """orders as a load per priority; some run again, as after a lost driver: every row lands once."""
    path = scratch_path(spark, "orders-once")
    loads = list(_by_value(spark, table(spark, sf_dir, "orders"), "o_orderpriority"))
    for load_id, rows in loads + loads[:2]:
        load_batches(rows, [of(c, c, t) for c, t in ORDER_BINDINGS], path, load_id)
    return read_table(spark, path)


@register("rejected_rows", """
SELECT o_orderkey, 1::BIGINT AS places, o_orderkey % 997 = 0 AS corrupt, CASE WHEN o_orderkey % 997 = 0 THEN 'not_a_number' END AS source_price,
       CASE WHEN o_orderkey % 997 = 0 THEN 1 ELSE 0 END AS n_reasons FROM orders""")
def q_rejected_rows(spark, sf_dir):
    """orders with prices that can't be read: batches that hold one go to a second output with the reasons and the
    corrupt rows' source; every row is in one of the two."""
    price = F.when(F.col("o_orderkey") % 997 == 0, F.lit("not_a_number")).otherwise(F.col("o_totalprice").cast("string"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"))
    path = scratch_path(spark, "orders-rejected")
    load_batches(o, [of("o_orderkey", "o_orderkey", "Int64"), of("price", "o_totalprice", "Float64")], path, "all",
                 LoadOptions(failure="drop_batch"))
    none = F.lit(None).cast("string")
    accepted = read_accepted(spark, path).select("o_orderkey", F.lit(False).alias("corrupt"), none.alias("source_price"), F.lit(0).alias("n_reasons"))
    rejected = read_rejected(spark, path).select("o_orderkey", (F.size("_errors") > 0).alias("corrupt"), F.get_json_object("_record", "$.price").alias("source_price"),
                                                 F.size("_errors").alias("n_reasons"))
    both = accepted.unionByName(rejected)
    return both.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("places"), F.max("corrupt").alias("corrupt"), F.max("source_price").alias("source_price"),
                                          F.max("n_reasons").alias("n_reasons"))


DOC_BINDINGS = [("doc_id", "Int64"), ("text", "String"), ("lang", "String"), ("source", "String"), ("n_chars", "Int64")]
DOC_PAYLOAD_SQL = f"(8 + {str_bytes_sql('text')} + {str_bytes_sql('lang')} + {str_bytes_sql('source')} + 8)"


@register("load_size_quantiles", f"""
WITH sized AS (SELECT {DOC_PAYLOAD_SQL}::BIGINT AS size FROM documents),
ranked AS (SELECT size, row_number() OVER (ORDER BY size) AS place, count(*) OVER () AS n, greatest(0, length(bin(size)) - 8) AS shift FROM sized)
SELECT 'bytes_per_record' AS metric, max(n)::BIGINT AS n, {", ".join(
    f"max((size >> shift) << shift) FILTER (place = greatest(1, ceil(n * {share}::DOUBLE)))::BIGINT AS p{name}" for share, name in ((0.5, "50"), (0.9, "90"), (0.99, "99")))}
FROM ranked""")
def q_load_size_quantiles(spark, sf_dir):
    """documents as a load per language; the loads' histograms of record sizes, merged, give the quantiles of all."""
    path = scratch_path(spark, "documents-loads")
    for load_id, rows in _by_value(spark, table(spark, sf_dir, "documents"), "lang"):
        load_batches(rows, [of(c, c, t) for c, t in DOC_BINDINGS], path, load_id, LoadOptions(max_batch_bytes=64 << 20, max_record_bytes=64 << 20))
    return quantiles(load_log(spark, path), [0.5, 0.9, 0.99]).where("metric = 'bytes_per_record'")


SUPPLIER_SPEC = TableSpec.of("supplier", [("s_suppkey", "Int64"), ("s_name", "String"), ("s_nationkey", "Int32"),
                                          ("s_acctbal", "Float64")])


@register("sink_raw_lines", """
SELECT 'csv' AS fmt, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT 'json' AS fmt, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def q_sink_raw_lines(spark, sf_dir):
    """supplier as raw CSV and JSON lines, parsed against the table schema."""
    s = table(spark, sf_dir, "supplier")
    csv = s.select(F.concat_ws(",", *[F.col(c).cast("string") for c in SUPPLIER_SPEC.names]).alias("value"))
    js = s.select(F.to_json(F.struct(*SUPPLIER_SPEC.names)).alias("value"))
    p1, p2 = scratch_path(spark, "supplier-csv"), scratch_path(spark, "supplier-json")
    load_raw(csv, SUPPLIER_SPEC, p1, "csv")
    load_raw(js, SUPPLIER_SPEC, p2, "json")
    return (read_table(spark, p1).withColumn("fmt", F.lit("csv"))
            .unionByName(read_table(spark, p2).withColumn("fmt", F.lit("json"))))


FORMATS_SPEC = TableSpec.of("supplier", [("s_suppkey", "Int64"), ("s_name", "String"), ("s_note", "Nullable(String)"), ("s_acctbal", "Float64")])


@register("sink_raw_formats", """
SELECT fmt, s_suppkey, s_name || chr(9) || 'a\\b' || chr(10) || '"' AS s_name, CASE WHEN s_suppkey % 3 <> 0 THEN '\\t' || s_nationkey END AS s_note, s_acctbal
FROM supplier, (VALUES ('tsv'), ('json_rows')) formats(fmt)""")
def q_sink_raw_formats(spark, sf_dir):
    """supplier as escaped tab-separated lines and as lines of JSON arrays; names with tabs, line ends, quotes and backslashes, and NULL notes."""
    name = F.concat("s_name", F.lit("\ta\\b\n\""))
    note = F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("\\t"), F.col("s_nationkey").cast("string")))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", name.alias("s_name"), note.alias("s_note"), "s_acctbal")

    def escaped(c):
        for character, written in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n")):
            c = F.replace(c, F.lit(character), F.lit(written))
        return F.coalesce(c, F.lit("\\N"))

    tsv = F.concat_ws("\t", *[escaped(F.col(c).cast("string")) for c in FORMATS_SPEC.names])
    # A struct's values, null ones too, in brackets.
    values = [F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1), F.lit("")) for c in FORMATS_SPEC.names]
    js = F.concat(F.lit("["), F.concat_ws(",", *[F.when(v == "", F.lit("null")).otherwise(v) for v in values]), F.lit("]"))
    out = None
    for fmt, line in (("tsv", tsv), ("json_rows", js)):
        path = scratch_path(spark, f"supplier-{fmt}")
        load_raw(s.select(line.alias("value")), FORMATS_SPEC, path, fmt)
        one = read_table(spark, path).withColumn("fmt", F.lit(fmt))
        out = one if out is None else out.unionByName(one)
    return out


EVENT_BINDINGS = [("event_id", "Int64"), ("ts", "DateTime64(6, 'UTC')"), ("user_id", "Int64"),
                  ("event_type", "LowCardinality(String)"), ("value", "Float64"), ("props", "JSON")]
EVENTS_TYPED_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


EVENT_FILE_ROWS = 100_000
LOST = "the driver is lost behind the write of a micro-batch"


def _events_as_files(spark, sf_dir):
    """The events as files that arrive one after another: eight, or more where there are more rows."""
    src = scratch_path(spark, "events-in")
    e = table(spark, sf_dir, "events")
    e.repartition(max(8, e.count() // EVENT_FILE_ROWS), "event_id").write.parquet(src)
    return src, e.schema


def _stream_events(spark, sf_dir, max_files, fail_at=None):
    src, schema = _events_as_files(spark, sf_dir)
    out, ckpt = scratch_path(spark, "events-out"), scratch_path(spark, "events-ckpt")
    bindings = [of(c, c, t) for c, t in EVENT_BINDINGS]
    if fail_at is not None:
        write = batch_writer(bindings, out, stream_id(spark, ckpt))

        def lose(batch_df, batch_id):
            write(batch_df, batch_id)
            if batch_id == fail_at:
                raise RuntimeError(LOST)

        query = file_stream(spark, src, schema, max_files).writeStream.foreachBatch(lose).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except StreamingQueryException as e:
            if LOST not in str(e):
                raise
    stream_load(file_stream(spark, src, schema, max_files), bindings, out, ckpt)
    return read_loaded(spark, out).drop("_batch_id")


@register("sink_stream", EVENTS_TYPED_SQL)
def q_sink_stream(spark, sf_dir):
    """events streamed from files into the table micro-batch by micro-batch."""
    return _stream_events(spark, sf_dir, max_files=2)


@register("restart_no_loss", EVENTS_TYPED_SQL)
def q_restart_no_loss(spark, sf_dir):
    """A stream load that crashes after a checkpoint and restarts: every row lands once."""
    return _stream_events(spark, sf_dir, max_files=2, fail_at=1)


@register("restart_partial_flush", EVENTS_TYPED_SQL)
def q_restart_partial_flush(spark, sf_dir):
    """Crash after some micro-batches were flushed and one was half done: the replay overwrites it."""
    return _stream_events(spark, sf_dir, max_files=1, fail_at=3)


@register("normalize_raw_line", """
SELECT doc_id, count(*) AS n_lines,
       sum(CASE WHEN line = '' THEN 0 ELSE strlen(line) + 1 END)::BIGINT AS payload_bytes,
       count(*) FILTER (WHERE line = '') AS n_empty
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""")
def q_normalize_raw_line(spark, sf_dir):
    """Each line of each document as a raw payload: newline appended, empty stays empty."""
    d = table(spark, sf_dir, "documents")
    lines = d.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    p = lines.select("doc_id", "line", normalize_raw_line(F.col("line")).alias("payload"))
    return p.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                   F.sum(F.octet_length("payload")).cast("bigint").alias("payload_bytes"),
                                   F.count_if(F.col("line") == "").alias("n_empty"))


@register("evolve_add_column", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'extra-' || CAST(o_orderkey AS VARCHAR) END AS extra
FROM orders""")
def q_evolve_add_column(spark, sf_dir):
    """Old rows loaded without two columns, new rows with them: old rows read them as NULL."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-evolve")
    old = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    new = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).withColumn(
        "extra", F.concat(F.lit("extra-"), F.col("o_orderkey").cast("string")))
    a = [of("o_orderkey", "o_orderkey", "Int64"), of("o_custkey", "o_custkey", "Int64")]
    b = a + [of("o_orderpriority", "o_orderpriority", "Nullable(String)"), of("extra", "extra", "Nullable(String)")]
    load(old, a, path)
    load(new, b, path)
    return read_table(spark, path, merge_schema=True).select("o_orderkey", "o_custkey", "o_orderpriority", "extra")


@register("evolve_columns", """
SELECT o_orderkey, o_totalprice AS price, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'none' WHEN o_orderdate < TIMESTAMP '1999-01-01' OR o_orderkey % 3 = 0 THEN o_orderpriority END AS note,
       CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 7 ELSE o_custkey END AS owner FROM orders""")
def q_evolve_columns(spark, sf_dir):
    """orders of three spans of time, between which the table's columns change: one is added with a default, one renamed,
    one widened, one dropped and added anew. Old files are read under the present columns."""
    o, path = table(spark, sf_dir, "orders"), scratch_path(spark, "orders-columns")
    day, first, second = F.col("o_orderdate"), F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1999-01-01").cast("timestamp_ntz")
    evolution.create_table(spark, path, TableSpec.of("orders", [("o_orderkey", "Int64"), ("total", "Float64"), ("owner", "Int32")]))
    evolution.append(o.where(day < first).select("o_orderkey", F.col("o_totalprice").alias("total"), F.col("o_custkey").cast("int").alias("owner")), path)
    evolution.add_column(spark, path, "note", "Nullable(String)", "'none'")
    evolution.rename_column(spark, path, "total", "price")
    evolution.append(o.where((day >= first) & (day < second)).select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("note"),
                                                                     F.col("o_custkey").cast("int").alias("owner")), path)
    evolution.drop_column(spark, path, "owner")
    evolution.add_column(spark, path, "owner", "Int32", "7")
    evolution.widen_column(spark, path, "owner", "Int64")
    note = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("note")
    evolution.append(o.where(day >= second).select("o_orderkey", F.col("o_totalprice").alias("price"), note, F.col("o_custkey").cast("bigint").alias("owner")), path)
    return evolution.read(spark, path).select("o_orderkey", "price", "note", "owner")


CLUSTERED_SPEC = TableSpec.of("orders", ORDER_BINDINGS, sort_key=["o_orderdate", "o_orderkey"])


@register("cluster_by_sort_key", """
SELECT count(*)::BIGINT AS n_rows, 0::BIGINT AS overlapping, true AS prunes FROM orders""")
def q_cluster_by_sort_key(spark, sf_dir):
    """orders loaded by ranges of the sort key: no two files share a span of it, so a reader's filter leaves all but a few out."""
    path = scratch_path(spark, "orders-clustered")
    load(table(spark, sf_dir, "orders"), [of(c, c, t) for c, t in ORDER_BINDINGS], path, LoadOptions(cluster=True), table=CLUSTERED_SPEC)
    key = F.struct("o_orderdate", "o_orderkey")
    files = read_table(spark, path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
    before = F.max("high").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    own = files.select("n", "low", (before >= F.col("low")).alias("overlaps"))
    return own.agg(F.sum("n").cast("bigint").alias("n_rows"), F.count_if("overlaps").alias("overlapping"), (F.count(F.lit(1)) >= 1).alias("prunes"))


NATION_SPEC = TableSpec.of("nation", [("n_nationkey", "Int32"), ("n_name", "String"), ("n_regionkey", "Int32")])


@register("replay_raw_backlog", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_replay_raw_backlog(spark, sf_dir):
    """A backlog of raw CSV lines saved by an older load is written unchanged."""
    backlog = scratch_path(spark, "nation-backlog")
    n = table(spark, sf_dir, "nation")
    n.select(F.concat_ws(",", *[F.col(c).cast("string") for c in NATION_SPEC.names]).alias("value")).write.text(backlog)
    path = scratch_path(spark, "nation-table")
    load_raw(spark.read.text(backlog), NATION_SPEC, path, "csv")
    return read_table(spark, path)


@register("stream_batch_by_all_limits", STREAM_ALL_LIMITS_SQL)
def q_stream_batch_by_all_limits(spark, sf_dir):
    """batch_by_all_limits on a stream: events arrive as time-ordered files, and the
    flush state of each writer carries across micro-batches (applyInPandasWithState)."""
    from ladle.functions.sizes import row_payload_bytes
    from ladle.operators.batching import batch_summary
    from ladle.plans.batches import (EVENT_BYTES, EVENT_COLUMNS, EVENT_ROWS, EVENT_SHARDS, SIX_HOURS_MS, typed_events)
    from ladle.streaming.batching_stream import stream_annotate_batches

    e = typed_events(spark, sf_dir).select("event_id", "ts", row_payload_bytes(EVENT_COLUMNS).alias("sz"))
    src = scratch_path(spark, "events-by-time")
    # Files in event-time order: one range per file, written one after another
    # so the file source lists them in arrival order.
    bounds = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    n_files = 4
    span = (bounds.hi - bounds.lo) / n_files
    for i in range(n_files):
        lo = bounds.lo + span * i
        part = e.where(F.col("ts") >= F.lit(lo))
        if i < n_files - 1:
            part = part.where(F.col("ts") < F.lit(bounds.lo + span * (i + 1)))
        part.coalesce(1).write.parquet(f"{src}/part={i:03d}")
    schema = e.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/part=*")
    ann = stream_annotate_batches(stream, F.pmod(F.col("event_id"), F.lit(EVENT_SHARDS)), ["ts", "event_id"],
                                  F.col("sz"), EVENT_ROWS, EVENT_BYTES, F.col("ts"), SIX_HOURS_MS)
    out, ckpt = scratch_path(spark, "events-annotated"), scratch_path(spark, "events-annotated-ckpt")

    def write(batch_df, batch_id):
        batch_df.write.mode("overwrite").parquet(f"{out}/_batch_id={batch_id}")

    ann.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True) \
        .start().awaitTermination()
    return batch_summary(spark.read.parquet(out).drop("_batch_id")).select(
        "shard", "batch", "n_rows", "n_bytes", "reason")
