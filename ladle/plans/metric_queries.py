"""§2.7 load metrics as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions.sizes import row_payload_bytes
from ladle.operators.batching import batch_by_count
from ladle.operators.metrics import flush_reason_counts, latency_window, send_time
from ladle.operators.packing import pack_batches, packed_summary
from ladle.plans.batches import (
    DOC_BASE,
    DOC_BATCH_BYTES,
    DOC_BATCH_ROWS,
    LINEITEM_ORDER,
    LINEITEM_SHARD_KEY_SQL,
    LINEITEM_SHARDS,
    ORDER_COLUMNS,
    ORDER_SHARDS,
    ORDERS_HEADER,
    ORDERS_PAYLOAD_SQL,
    doc_batches,
    lineitem_shard_key,
    pmod_sql,
    typed_orders,
)
from ladle.plans.failure_queries import CORRUPT_BATCHES_SQL, corrupt_batches
from ladle.plans.oracle_sql import fold_sql
from ladle.plans.registry import register, table


@register("metric_bytes_sent", f"""
WITH b AS (
  SELECT {pmod_sql('o_orderkey', ORDER_SHARDS)} AS shard,
         (row_number() OVER (PARTITION BY {pmod_sql('o_orderkey', ORDER_SHARDS)} ORDER BY o_orderkey) - 1) // 500 AS batch,
         {ORDERS_PAYLOAD_SQL} AS sz FROM orders)
SELECT shard, (sum(sz) + count(DISTINCT batch) * {ORDERS_HEADER})::BIGINT AS bytes_sent FROM b GROUP BY shard""")
def q_metric_bytes_sent(spark, sf_dir):
    """Payload bytes plus one header per batch, per shard (typed orders, 500-row batches)."""
    o = typed_orders(spark, sf_dir).withColumn("sz", row_payload_bytes(ORDER_COLUMNS))
    b = batch_by_count(o, 500, F.pmod(F.col("o_orderkey"), F.lit(ORDER_SHARDS)).cast("int"), ["o_orderkey"])
    per = b.groupBy("shard", "batch").agg(F.sum("sz").alias("sz"))
    return per.groupBy("shard").agg(
        (F.sum("sz") + F.count(F.lit(1)) * F.lit(ORDERS_HEADER)).cast("bigint").alias("bytes_sent"))


def lineitem_batches(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER)
    return packed_summary(pack_batches(li, F.pmod(lineitem_shard_key(), F.lit(LINEITEM_SHARDS)), LINEITEM_ORDER, max_rows=500), 500)


LI_BATCH_SQL = f"""
WITH b AS (
  SELECT {pmod_sql(LINEITEM_SHARD_KEY_SQL, LINEITEM_SHARDS)} AS shard,
         (row_number() OVER (PARTITION BY {pmod_sql(LINEITEM_SHARD_KEY_SQL, LINEITEM_SHARDS)}
                             ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 500 AS batch
  FROM lineitem),
pb AS (SELECT shard, batch, count(*) AS n_rows FROM b GROUP BY shard, batch)"""


@register("metric_records_sent", LI_BATCH_SQL + " SELECT shard, sum(n_rows)::BIGINT AS records_sent FROM pb GROUP BY shard")
def q_metric_records_sent(spark, sf_dir):
    """Rows sent per shard (lineitem)."""
    return lineitem_batches(spark, sf_dir).groupBy("shard").agg(F.sum("n_rows").cast("bigint").alias("records_sent"))


@register("metric_requests", LI_BATCH_SQL + " SELECT shard, count(*)::BIGINT AS requests FROM pb GROUP BY shard")
def q_metric_requests(spark, sf_dir):
    """Flush requests (batches) per shard (lineitem, 500-row batches)."""
    return lineitem_batches(spark, sf_dir).groupBy("shard").agg(F.count(F.lit(1)).cast("bigint").alias("requests"))


@register("metric_rows_per_batch", LI_BATCH_SQL + """
SELECT shard, count(*)::BIGINT AS batches, min(n_rows)::BIGINT AS min_rows, max(n_rows)::BIGINT AS max_rows,
       round(avg(n_rows), 6) AS avg_rows, median(n_rows)::DOUBLE AS median_rows FROM pb GROUP BY shard""")
def q_metric_rows_per_batch(spark, sf_dir):
    """Distribution of rows per batch, per shard (lineitem)."""
    d = lineitem_batches(spark, sf_dir)
    return d.groupBy("shard").agg(F.count(F.lit(1)).cast("bigint").alias("batches"),
                                  F.min("n_rows").cast("bigint").alias("min_rows"),
                                  F.max("n_rows").cast("bigint").alias("max_rows"),
                                  F.round(F.avg("n_rows"), 6).alias("avg_rows"),
                                  F.median("n_rows").cast("double").alias("median_rows"))


DOC_FOLD_SQL = "WITH RECURSIVE " + fold_sql(DOC_BASE, "doc_id", max_rows=DOC_BATCH_ROWS, max_bytes=DOC_BATCH_BYTES)


@register("metric_bytes_per_batch", DOC_FOLD_SQL + """
SELECT shard, count(*)::BIGINT AS batches, min(n_bytes)::BIGINT AS min_bytes, max(n_bytes)::BIGINT AS max_bytes,
       round(avg(n_bytes), 6) AS avg_bytes, median(n_bytes)::DOUBLE AS median_bytes FROM batch_summary GROUP BY shard""")
def q_metric_bytes_per_batch(spark, sf_dir):
    """Distribution of bytes per batch, per shard (documents, 20 rows / 64 KiB)."""
    d = doc_batches(spark, sf_dir, max_rows=DOC_BATCH_ROWS)
    return d.groupBy("shard").agg(F.count(F.lit(1)).cast("bigint").alias("batches"),
                                  F.min("n_bytes").cast("bigint").alias("min_bytes"),
                                  F.max("n_bytes").cast("bigint").alias("max_bytes"),
                                  F.round(F.avg("n_bytes"), 6).alias("avg_bytes"),
                                  F.median("n_bytes").cast("double").alias("median_bytes"))


@register("metric_flush_reasons", DOC_FOLD_SQL + " SELECT reason, count(*)::BIGINT AS flushes FROM batch_summary GROUP BY reason")
def q_metric_flush_reasons(spark, sf_dir):
    """Flushes by reason for the documents load (each flush counted once)."""
    return flush_reason_counts(doc_batches(spark, sf_dir, max_rows=DOC_BATCH_ROWS))


@register("metric_dropped_batches", CORRUPT_BATCHES_SQL + """
SELECT shard, count(*) FILTER (WHERE bad = 1)::BIGINT AS dropped_batches FROM pb GROUP BY shard""")
def q_metric_dropped_batches(spark, sf_dir):
    """Batches dropped as corrupt, per shard."""
    per = corrupt_batches(spark, sf_dir).groupBy("shard", "batch").agg(F.max("_bad").alias("bad"))
    return per.groupBy("shard").agg(F.count_if(F.col("bad") == 1).cast("bigint").alias("dropped_batches"))


@register("metric_dropped_records", CORRUPT_BATCHES_SQL + """
SELECT shard, coalesce(sum(n) FILTER (WHERE bad = 1), 0)::BIGINT AS dropped_records FROM pb GROUP BY shard""")
def q_metric_dropped_records(spark, sf_dir):
    """Rows dropped with their corrupt batches, per shard."""
    per = corrupt_batches(spark, sf_dir).groupBy("shard", "batch").agg(F.max("_bad").alias("bad"),
                                                                       F.count(F.lit(1)).alias("n"))
    return per.groupBy("shard").agg(
        F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).cast("bigint").alias("dropped_records"))


@register("metric_retries", """
SELECT user_id, count(*) FILTER (WHERE event_type = 'error')::BIGINT AS retries FROM events GROUP BY user_id""")
def q_metric_retries(spark, sf_dir):
    """Batch retries per writer from a request log (events: 'error' = failed attempt, retried)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").cast("bigint").alias("retries"))


def _latency_sql(cond: str) -> str:
    return f"""
SELECT count(*)::BIGINT AS samples, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
       round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99
FROM (SELECT value FROM events WHERE {cond} ORDER BY ts DESC, event_id DESC LIMIT 1000)"""


def _latency(spark, sf_dir, cond):
    e = table(spark, sf_dir, "events").where(cond)
    s = latency_window(e, "value", ["ts", "event_id"], 1000)
    return (s.withColumn("mean", F.round("mean", 6)).withColumn("p50", F.round("p50", 6))
            .withColumn("p99", F.round("p99", 6)))


@register("metric_write_latency", _latency_sql("event_type <> 'error'"))
def q_metric_write_latency(spark, sf_dir):
    """Write latency over the last 1000 successful requests."""
    return _latency(spark, sf_dir, F.col("event_type") != "error")


@register("metric_failure_latency", _latency_sql("event_type = 'error'"))
def q_metric_failure_latency(spark, sf_dir):
    """Latency over the last 1000 failed requests."""
    return _latency(spark, sf_dir, F.col("event_type") == "error")


@register("metric_send_time", """
SELECT user_id, arg_max(CAST(trunc(value * 1000) AS BIGINT), epoch_us(ts) + CAST(trunc(value * 1000) AS BIGINT)) AS send_time
FROM events GROUP BY user_id""")
def q_metric_send_time(spark, sf_dir):
    """Last acknowledgement minus its send time, per writer (microseconds)."""
    e = table(spark, sf_dir, "events")
    lat = (F.col("value") * 1000).cast("bigint")
    log = e.select("user_id", F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                              F.col("ts")).alias("send"), lat.alias("lat"))
    log = log.withColumn("ack", F.col("send") + F.col("lat"))
    return send_time(log, "send", "ack", by=["user_id"])
