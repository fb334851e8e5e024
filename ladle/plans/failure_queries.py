"""§2.6 failure handling queries.

Whole tables are processed; ``key % 997`` only injects the corrupt values the
failure policies act on (the fixture of the reference tests), it is not a
filter.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators.bindings import TableSpec, bind_columns, of
from ladle.operators.failures import (
    CORRUPTION_CODES,
    RetryPolicy,
    classify,
    error_rows,
    mark_bad,
    retry_batch,
    stop_on_corrupt,
)
from ladle.operators.packing import pack_batches
from ladle.plans.batches import ORDER_SHARDS, pmod_sql
from ladle.plans.registry import register, scratch_path, table
from ladle.sinks.table import parse_raw, read_table

# Messages of the error-classification fixture.
MESSAGES = {
    0: ("io", "Read timed out after 30000 ms"),
    1: ("io", "Write timed out after 30000 ms"),
    3: ("io", "Connection reset by peer"),
    4: ("io", "java.io.IOException: Broken pipe"),
    5: ("io", "connect: Connection timed out"),
    6: ("io", "Unexpected end of file"),
    11: ("io", "Timeout: Read timed out after 5 s"),
}


def _cause(kind, code=None, retryable=False, message=None):
    return F.struct(F.lit(kind).alias("kind"), (code if code is not None else F.lit(None)).cast("int").alias("code"),
                    F.lit(retryable).alias("retryable"), F.lit(message).cast("string").alias("message"))


def error_log(spark, sf_dir):
    """A load error log derived from events: one cause chain per event."""
    e = table(spark, sf_dir, "events")
    s = F.col("event_id") % 14
    codes = F.array(*[F.lit(c) for c in CORRUPTION_CODES])
    chain = F.when(s == 2, F.array(_cause("other", message="Flush failed"),
                                   _cause("io", message="Insert failed: unexpected end of stream")))
    for k, (kind, msg) in MESSAGES.items():
        chain = chain.when(s == k, F.array(_cause(kind, message=msg)))
    chain = (chain.when(s == 7, F.array(_cause("other", message="wrapper"),
                                         _cause("server", F.element_at(codes, (F.col("event_id") % 7 + 1).cast("int")),
                                                False, "Cannot parse input"),
                                         _cause("io", message="Broken pipe")))
             .when(s == 8, F.array(_cause("server", F.lit(252), True, "Too many parts"), _cause("io", message="x")))
             .when(s == 9, F.array(_cause("server", F.lit(60), False, "Table does not exist")))
             .when(s == 10, F.array(_cause("other", message="a"), _cause("connect", message="refused")))
             .when(s == 12, F.array(_cause("other", message="a"), _cause("other", message="b"),
                                    _cause("socket_timeout", message="timeout")))
             .otherwise(F.array(_cause("io"))))
    return e.select("event_id", chain.alias("causes"))


def _c(kind, code="NULL", retryable="false", message="NULL"):
    msg = "NULL" if message == "NULL" else "'" + message.replace("'", "''") + "'"
    return f"{{'kind': '{kind}', 'code': CAST({code} AS INTEGER), 'retryable': {retryable}, 'message': CAST({msg} AS VARCHAR)}}"


_CASES = "\n".join(f"    WHEN event_id % 14 = {k} THEN [{_c(kind, message=m)}]" for k, (kind, m) in MESSAGES.items())
_CODES_SQL = "[" + ", ".join(str(c) for c in CORRUPTION_CODES) + "]"
ERROR_LOG_SQL = f"""
  SELECT event_id, CASE
    WHEN event_id % 14 = 2 THEN [{_c('other', message='Flush failed')}, {_c('io', message='Insert failed: unexpected end of stream')}]
{_CASES}
    WHEN event_id % 14 = 7 THEN [{_c('other', message='wrapper')}, {_c('server', code=f'{_CODES_SQL}[event_id % 7 + 1]', message='Cannot parse input')}, {_c('io', message='Broken pipe')}]
    WHEN event_id % 14 = 8 THEN [{_c('server', code='252', retryable='true', message='Too many parts')}, {_c('io', message='x')}]
    WHEN event_id % 14 = 9 THEN [{_c('server', code='60', message='Table does not exist')}]
    WHEN event_id % 14 = 10 THEN [{_c('other', message='a')}, {_c('connect', message='refused')}]
    WHEN event_id % 14 = 12 THEN [{_c('other', message='a')}, {_c('other', message='b')}, {_c('socket_timeout', message='timeout')}]
    ELSE [{_c('io')}] END AS causes
  FROM events"""


@register("classify_errors", f"""
WITH log AS ({ERROR_LOG_SQL}),
r AS (SELECT event_id, CASE WHEN len(list_filter(causes, lambda c: c.kind = 'server')) > 0
                            THEN list_filter(causes, lambda c: c.kind = 'server')[1]
                            ELSE causes[len(causes)] END AS rc FROM log)
SELECT event_id, CASE
  WHEN rc.kind = 'server' THEN CASE WHEN rc.retryable THEN 'retriable'
                                    WHEN rc.code IN {tuple(CORRUPTION_CODES)} THEN 'corruption' ELSE 'fatal' END
  WHEN rc.kind IN ('connect', 'socket_timeout') THEN 'retriable'
  WHEN rc.kind = 'io' AND rc.message IS NOT NULL AND (starts_with(rc.message, 'Read timed out after')
       OR starts_with(rc.message, 'Write timed out after') OR contains(rc.message, 'Insert failed')
       OR contains(rc.message, 'Connection reset by peer') OR contains(rc.message, 'Broken pipe')
       OR contains(rc.message, 'Connection timed out')) THEN 'retriable'
  ELSE 'fatal' END AS category
FROM r""")
def q_classify_errors(spark, sf_dir):
    """Each error's cause chain classified as retriable / corruption / fatal."""
    return error_log(spark, sf_dir).select("event_id", classify(F.col("causes")).alias("category"))


ORDERS_RAW_SPEC = TableSpec.of("orders_raw", [("o_orderkey", "Int64"), ("o_custkey", "Int64"),
                                              ("o_orderstatus", "String"), ("o_totalprice", "Float64")])


def corrupted_order_lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 997 == 0, F.lit("not_a_number")).otherwise(F.col("o_totalprice").cast("string"))
    return o.select(F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                                F.col("o_orderstatus"), price).alias("value"))


@register("find_corrupt_rows", "SELECT o_orderkey, 1 AS n_errors FROM orders WHERE o_orderkey % 997 = 0")
def q_find_corrupt_rows(spark, sf_dir):
    """CSV lines of orders whose price field cannot be parsed into the target type."""
    p = parse_raw(corrupted_order_lines(spark, sf_dir), ORDERS_RAW_SPEC, "csv", mode="report")
    return error_rows(p).select("o_orderkey", F.size("_errors").alias("n_errors"))


def corrupt_batches(spark, sf_dir):
    """Typed orders (price as text, 1 bad per 997) in 500-row batches per shard."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 997 == 0, F.lit("not_a_number"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("price"))
    typed = bind_columns(o, [of("o_orderkey", "o_orderkey", "Int64"), of("price", "o_totalprice", "Float64")],
                         mode="report")
    return pack_batches(mark_bad(typed).drop("_errors"), F.pmod(F.col("o_orderkey"), F.lit(ORDER_SHARDS)), ["o_orderkey"], max_rows=500)


CORRUPT_BATCHES_SQL = f"""
WITH b AS (
  SELECT o_orderkey, {pmod_sql('o_orderkey', ORDER_SHARDS)} AS shard,
         (row_number() OVER (PARTITION BY {pmod_sql('o_orderkey', ORDER_SHARDS)} ORDER BY o_orderkey) - 1) // 500 AS batch,
         CASE WHEN o_orderkey % 997 = 0 THEN 1 ELSE 0 END AS bad
  FROM orders),
pb AS (SELECT shard, batch, count(*) AS n, max(bad) AS bad FROM b GROUP BY shard, batch)"""


@register("drop_corrupt_batch", CORRUPT_BATCHES_SQL + """
SELECT shard, sum(n)::BIGINT AS kept_rows, count(*)::BIGINT AS kept_batches FROM pb WHERE bad = 0 GROUP BY shard""")
def q_drop_corrupt_batch(spark, sf_dir):
    """One bad row drops its whole batch; the other batches are kept."""
    per = corrupt_batches(spark, sf_dir).groupBy("shard", "batch").agg(F.count(F.lit(1)).alias("n"), F.max("_bad").alias("bad")).where("bad = 0")
    return per.groupBy("shard").agg(F.sum("n").cast("bigint").alias("kept_rows"),
                                    F.count(F.lit(1)).cast("bigint").alias("kept_batches"))


@register("stop_on_corrupt", """
SELECT o_orderpriority, count(*)::BIGINT AS n_rows, CASE WHEN max(o_orderkey % 997 = 0) THEN 'Corrupt row in batch' END AS stopped_by,
       CASE WHEN NOT max(o_orderkey % 997 = 0) THEN sum(o_orderkey) END::BIGINT AS key_sum
FROM orders GROUP BY o_orderpriority""")
def q_stop_on_corrupt(spark, sf_dir):
    """The default policy at work: each priority's orders are loaded by themselves, and the first corrupt row stops the load."""
    o = table(spark, sf_dir, "orders").withColumn("_bad", (F.col("o_orderkey") % 997 == 0).cast("int"))
    out = []
    for r in o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy("o_orderpriority").collect():  # five of them
        own = stop_on_corrupt(o.where(F.col("o_orderpriority").eqNullSafe(F.lit(r.o_orderpriority))))
        try:
            stopped, total = None, own.agg(F.sum("o_orderkey")).first()[0]
        except Exception as e:  # noqa: BLE001 - only the policy's own error is an answer
            if "Corrupt row in batch" not in str(e):
                raise
            stopped, total = "Corrupt row in batch", None
        out.append((r.o_orderpriority, r.n, stopped, total))
    return spark.createDataFrame(out, "o_orderpriority string, n_rows long, stopped_by string, key_sum long")


@register("retry_batch", "SELECT count(*) AS n_rows, 3 AS attempts FROM orders")
def q_retry_batch(spark, sf_dir):
    """A batch write that fails twice with a transient error is retried and lands once."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-retry")
    failures = {"left": 2}

    def write():
        o.write.mode("overwrite").parquet(path)
        if failures["left"] > 0:
            failures["left"] -= 1
            raise IOError("Connection reset by peer")

    attempts = retry_batch(write, RetryPolicy.limited(3), sleep_s=0.0)
    return read_table(spark, path).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("attempts", F.lit(attempts))
