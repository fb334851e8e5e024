"""§2.5 batching and flush queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions.sizes import header_bytes, raw_payload_bytes, row_payload_bytes
from ladle.operators.batching import annotate_batches, batch_by_count, batch_summary
from ladle.operators.bindings import bind_columns, of
from ladle.operators.packing import pack_batches, packed_summary
from ladle.plans.oracle_sql import fold_sql, str_bytes_sql
from ladle.plans.registry import register, table

LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# Virtual writers: a fixed number per query (an argument of each), whatever the
# table's size, so that a row's shard never changes as the table grows. A writer's
# stream is packed by as many tasks as the session has shuffle partitions; only
# batches with a time limit (events) take a writer's stream in one task.
LINEITEM_SHARDS = 64
ORDER_SHARDS = 16
DOC_SHARDS = 16
EVENT_SHARDS = 16
DOC_BATCH_BYTES = 65536
DOC_BATCH_ROWS = 20
SIX_HOURS_MS = 6 * 3600 * 1000
EVENT_ROWS, EVENT_BYTES = 8, 400

ORDER_COLUMNS = [("o_orderkey", "UInt64"), ("o_custkey", "Int64"), ("o_orderstatus", "LowCardinality(String)"),
                 ("o_totalprice", "Decimal(12, 2)"), ("o_orderdate", "Date"), ("o_orderpriority", "String")]
EVENT_COLUMNS = [("event_id", "Int64"), ("ts", "DateTime64(6, 'UTC')"), ("user_id", "Int64"),
                 ("event_type", "LowCardinality(String)"), ("value", "Float64"), ("props", "JSON")]

ORDERS_PAYLOAD_SQL = f"(8 + 8 + {str_bytes_sql('o_orderstatus')} + 8 + 2 + {str_bytes_sql('o_orderpriority')})"
EVENTS_PAYLOAD_SQL = f"(8 + 8 + 8 + {str_bytes_sql('event_type')} + 8 + {str_bytes_sql('props')})"


def typed_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return bind_columns(o, [of(c, c, t) for c, t in ORDER_COLUMNS])


def typed_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return bind_columns(e, [of(c, c, t) for c, t in EVENT_COLUMNS])


def pmod_sql(col: str, n: int) -> str:
    return f"((({col}) % {n}) + {n}) % {n}"


# -- count -------------------------------------------------------------------

# lineitem's order key is not unique, so writers are chosen from a mix of the
# whole unique key: a hot order spreads over all writers. (Same formula in SQL.)
LINEITEM_SHARD_KEY_SQL = "(l_orderkey * 7 + l_linenumber * 13 + l_partkey * 31 + l_suppkey * 37)"


def lineitem_shard_key():
    return (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey") * 31
            + F.col("l_suppkey") * 37)


def lineitem_count_batches(spark, sf_dir, max_rows=500, shards=LINEITEM_SHARDS):
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER)
    packed = pack_batches(li, F.pmod(lineitem_shard_key(), F.lit(shards)), LINEITEM_ORDER, max_rows=max_rows)
    found = packed_summary(packed, max_rows, extra_aggs=[F.min("l_orderkey").alias("min_orderkey"), F.max("l_orderkey").alias("max_orderkey")])
    return found.drop("n_bytes")


@register("batch_by_count", f"""
WITH b AS (
  SELECT l_orderkey, {pmod_sql(LINEITEM_SHARD_KEY_SQL, LINEITEM_SHARDS)} AS shard,
         (row_number() OVER (PARTITION BY {pmod_sql(LINEITEM_SHARD_KEY_SQL, LINEITEM_SHARDS)}
                             ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 500 AS batch
  FROM lineitem)
SELECT shard, batch, count(*) AS n_rows, min(l_orderkey) AS min_orderkey, max(l_orderkey) AS max_orderkey,
       CASE WHEN count(*) >= 500 THEN 'rows' ELSE 'end' END AS reason
FROM b GROUP BY shard, batch""")
def q_batch_by_count(spark, sf_dir):
    """Consecutive 500-row batches of lineitem per writer shard (writers from a hash of the unique key)."""
    return lineitem_count_batches(spark, sf_dir)


# -- bytes / rows / time fold --------------------------------------------------

def doc_batches(spark, sf_dir, max_rows=None, max_bytes=DOC_BATCH_BYTES, shards=DOC_SHARDS):
    # A document above the byte limit is a batch of its own: none is left out.
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(raw_payload_bytes(F.col("text")), F.lit(0)).alias("sz"))
    packed = pack_batches(d, F.pmod(F.col("doc_id"), F.lit(shards)), ["doc_id"], F.col("sz"), max_rows, max_bytes)
    return packed_summary(packed, max_rows, max_bytes)


DOC_BASE = (f"SELECT doc_id, {pmod_sql('doc_id', DOC_SHARDS)} AS shard, 0::BIGINT AS t, "
            f"(CASE WHEN text IS NULL THEN 0 WHEN text = '' THEN 0 WHEN suffix(text, chr(10)) THEN strlen(text) "
            f"ELSE strlen(text) + 1 END)::BIGINT AS sz FROM documents")

SUMMARY_COLS = "shard, batch, n_rows, n_bytes, reason"


@register("batch_by_bytes", "WITH RECURSIVE " + fold_sql(DOC_BASE, "doc_id", max_bytes=DOC_BATCH_BYTES)
          + f" SELECT {SUMMARY_COLS} FROM batch_summary")
def q_batch_by_bytes(spark, sf_dir):
    """Greedy 64 KiB packing of documents per shard (close before the row that overflows)."""
    return doc_batches(spark, sf_dir)


@register("batch_by_count_and_bytes",
          "WITH RECURSIVE " + fold_sql(DOC_BASE, "doc_id", max_rows=DOC_BATCH_ROWS, max_bytes=DOC_BATCH_BYTES)
          + f" SELECT {SUMMARY_COLS} FROM batch_summary")
def q_batch_by_count_and_bytes(spark, sf_dir):
    """Documents with both a 20-row and a 64 KiB limit."""
    return doc_batches(spark, sf_dir, max_rows=DOC_BATCH_ROWS)


def event_batches(spark, sf_dir, max_rows=None, max_bytes=None, max_time_ms=SIX_HOURS_MS, annotated=False, shards=EVENT_SHARDS):
    e = typed_events(spark, sf_dir).select("event_id", "ts", row_payload_bytes(EVENT_COLUMNS).alias("sz"))
    # With a row or byte limit the fold emits whole batches (bounded memory);
    # time-only batching streams rows out with close stamps instead.
    a = annotate_batches(e, F.pmod(F.col("event_id"), F.lit(shards)), ["ts", "event_id"], size=F.col("sz"),
                         max_rows=max_rows, max_bytes=max_bytes, ts=F.col("ts"), max_time_ms=max_time_ms,
                         complete=max_rows is not None or max_bytes is not None)
    return a if annotated else batch_summary(a)


EVENT_BASE = (f"SELECT event_id, ts, {pmod_sql('event_id', EVENT_SHARDS)} AS shard, epoch_us(ts)::BIGINT AS t, "
              f"{EVENTS_PAYLOAD_SQL}::BIGINT AS sz FROM events")


@register("batch_by_time", "WITH RECURSIVE " + fold_sql(EVENT_BASE, "ts, event_id", max_time_us=SIX_HOURS_MS * 1000)
          + f" SELECT {SUMMARY_COLS} FROM batch_summary")
def q_batch_by_time(spark, sf_dir):
    """Events per shard in 6 h windows anchored at the first row after the previous firing."""
    return event_batches(spark, sf_dir)


ALL_LIMITS_SQL = "WITH RECURSIVE " + fold_sql(EVENT_BASE, "ts, event_id", max_rows=EVENT_ROWS, max_bytes=EVENT_BYTES,
                                              max_time_us=SIX_HOURS_MS * 1000)


@register("batch_by_all_limits", ALL_LIMITS_SQL + f" SELECT {SUMMARY_COLS} FROM batch_summary")
def q_batch_by_all_limits(spark, sf_dir):
    """Events with rows + bytes + time limits together (pending-timer rule)."""
    return event_batches(spark, sf_dir, max_rows=EVENT_ROWS, max_bytes=EVENT_BYTES)


STREAM_ALL_LIMITS_SQL = ALL_LIMITS_SQL + f" SELECT {SUMMARY_COLS} FROM batch_summary"


@register("flush_reason", ALL_LIMITS_SQL + " SELECT shard, batch, reason FROM batch_summary")
def q_flush_reason(spark, sf_dir):
    """Why each events batch closed: rows / bytes / time / end."""
    return event_batches(spark, sf_dir, max_rows=EVENT_ROWS, max_bytes=EVENT_BYTES).select("shard", "batch", "reason")


@register("flush_final", "WITH RECURSIVE " + fold_sql(DOC_BASE, "doc_id", max_rows=DOC_BATCH_ROWS,
                                                      max_bytes=DOC_BATCH_BYTES)
          + """ SELECT shard, arg_max(batch, batch) AS last_batch, arg_max(n_rows, batch) AS last_rows,
                       arg_max(n_bytes, batch) AS last_bytes, arg_max(reason, batch) AS last_reason
                FROM batch_summary GROUP BY shard""")
def q_flush_final(spark, sf_dir):
    """The last (end-of-input) batch per shard of the documents load."""
    s = doc_batches(spark, sf_dir, max_rows=DOC_BATCH_ROWS)
    return s.groupBy("shard").agg(
        F.max("batch").alias("last_batch"),
        F.max_by("n_rows", "batch").alias("last_rows"),
        F.max_by("n_bytes", "batch").alias("last_bytes"),
        F.max_by("reason", "batch").alias("last_reason"),
    )


# -- sizes ---------------------------------------------------------------------

@register("reject_oversized_record", """
SELECT doc_id, (CASE WHEN text = '' THEN 0 WHEN suffix(text, chr(10)) THEN strlen(text) ELSE strlen(text) + 1 END)::BIGINT AS n_bytes,
       CASE WHEN (CASE WHEN text = '' THEN 0 WHEN suffix(text, chr(10)) THEN strlen(text) ELSE strlen(text) + 1 END) > 1000
            THEN 'rejected' ELSE 'ok' END AS status
FROM documents""")
def q_reject_oversized_record(spark, sf_dir):
    """Report mode of the 1000-byte record limit over documents (equal is allowed)."""
    d = table(spark, sf_dir, "documents").select("doc_id", raw_payload_bytes(F.col("text")).alias("n_bytes"))
    return d.withColumn("status", F.when(F.col("n_bytes") > 1000, "rejected").otherwise("ok"))


@register("row_payload_bytes", f"SELECT o_orderkey, {ORDERS_PAYLOAD_SQL}::BIGINT AS payload_bytes FROM orders")
def q_row_payload_bytes(spark, sf_dir):
    """Encoded size of each typed orders row."""
    return typed_orders(spark, sf_dir).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                                              row_payload_bytes(ORDER_COLUMNS).alias("payload_bytes"))


@register("raw_payload_bytes", """
SELECT doc_id, (CASE WHEN text IS NULL THEN NULL WHEN text = '' THEN 0 WHEN suffix(text, chr(10)) THEN strlen(text)
                ELSE strlen(text) + 1 END)::BIGINT AS payload_bytes FROM documents""")
def q_raw_payload_bytes(spark, sf_dir):
    """Size of each document as a raw newline-terminated text row."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", raw_payload_bytes(F.col("text")).cast("bigint").alias("payload_bytes"))


ORDERS_HEADER = header_bytes(ORDER_COLUMNS)


@register("batch_header_bytes", f"""
WITH b AS (
  SELECT {pmod_sql('o_orderkey', ORDER_SHARDS)} AS shard,
         (row_number() OVER (PARTITION BY {pmod_sql('o_orderkey', ORDER_SHARDS)} ORDER BY o_orderkey) - 1) // 500 AS batch,
         {ORDERS_PAYLOAD_SQL} AS sz
  FROM orders)
SELECT shard, count(DISTINCT batch)::BIGINT AS n_batches, sum(sz)::BIGINT AS payload_bytes,
       (count(DISTINCT batch) * {ORDERS_HEADER})::BIGINT AS header_bytes
FROM b GROUP BY shard""")
def q_batch_header_bytes(spark, sf_dir):
    """Names-and-types header bytes: one header per 500-row orders batch."""
    o = typed_orders(spark, sf_dir).withColumn("sz", row_payload_bytes(ORDER_COLUMNS))
    b = batch_by_count(o, 500, F.pmod(F.col("o_orderkey"), F.lit(ORDER_SHARDS)).cast("int"), ["o_orderkey"])
    per = b.groupBy("shard", "batch").agg(F.sum("sz").alias("sz"))
    return per.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("sz").cast("bigint").alias("payload_bytes"),
        (F.count(F.lit(1)) * F.lit(ORDERS_HEADER)).cast("bigint").alias("header_bytes"),
    )
