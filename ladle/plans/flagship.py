"""Flagship: the per-shard plan of a typed load (batches, rows, bytes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions.sizes import row_payload_bytes
from ladle.operators.batching import batch_by_count
from ladle.plans.batches import ORDER_COLUMNS, ORDER_SHARDS, ORDERS_HEADER, ORDERS_PAYLOAD_SQL, pmod_sql, typed_orders
from ladle.plans.registry import register

MAX_ROWS = 500


@register("typed_load_plan", f"""
WITH b AS (
  SELECT {pmod_sql('o_orderkey', ORDER_SHARDS)} AS shard,
         (row_number() OVER (PARTITION BY {pmod_sql('o_orderkey', ORDER_SHARDS)} ORDER BY o_orderkey) - 1) // {MAX_ROWS} AS batch,
         {ORDERS_PAYLOAD_SQL} AS sz
  FROM orders),
per AS (SELECT shard, batch, count(*) AS n, sum(sz) AS sz FROM b GROUP BY shard, batch)
SELECT shard, count(*)::BIGINT AS n_batches, sum(n)::BIGINT AS n_rows,
       (sum(sz) + count(*) * {ORDERS_HEADER})::BIGINT AS bytes_sent,
       max(n)::BIGINT AS max_rows_per_batch, min(n)::BIGINT AS min_rows_per_batch
FROM per GROUP BY shard""")
def q_typed_load_plan(spark, sf_dir):
    """How many batches, rows and bytes would a typed load of orders send per shard?"""
    o = typed_orders(spark, sf_dir).withColumn("sz", row_payload_bytes(ORDER_COLUMNS))
    b = batch_by_count(o, MAX_ROWS, F.pmod(F.col("o_orderkey"), F.lit(ORDER_SHARDS)).cast("int"), ["o_orderkey"])
    per = b.groupBy("shard", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("sz").alias("sz"))
    return per.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("n").cast("bigint").alias("n_rows"),
        (F.sum("sz") + F.count(F.lit(1)) * F.lit(ORDERS_HEADER)).cast("bigint").alias("bytes_sent"),
        F.max("n").cast("bigint").alias("max_rows_per_batch"),
        F.min("n").cast("bigint").alias("min_rows_per_batch"),
    )
