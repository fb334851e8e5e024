"""§2.9 rollup tables (simple-aggregate columns merged per sort key)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators.rollup import as_array, concat_arrays, remerge, rollup, sum_map
from ladle.plans.registry import register, scratch_path, table
from ladle.streaming.rollup_stream import compact_in_place, expire_snapshots, read_rollup, stream_rollup
from ladle.streaming.stream import file_stream


@register("rollup_max", "SELECT o_custkey, max(o_totalprice) AS max_price FROM orders GROUP BY o_custkey")
def q_rollup_max(spark, sf_dir):
    """max(o_totalprice) per customer."""
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_totalprice", "max_price")
    return rollup(o, ["o_custkey"], [("max_price", "max", None)])


@register("rollup_any_last", """
SELECT o_custkey, arg_max(o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) AS last_status
FROM orders GROUP BY o_custkey""")
def q_rollup_any_last(spark, sf_dir):
    """Latest order status per customer by (order date, order key)."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderstatus").alias("last_status"), F.struct("o_orderdate", "o_orderkey").alias("ord"))
    return rollup(o, ["o_custkey"], [("last_status", "anyLast", "ord")]).select("o_custkey", "last_status")


@register("rollup_sum_decimal", """
SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS total FROM lineitem GROUP BY l_suppkey""")
def q_rollup_sum_decimal(spark, sf_dir):
    """Revenue per supplier summed as Decimal(38, 4)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_extendedprice").cast("decimal(38,4)").alias("total"))
    return rollup(li, ["l_suppkey"], [("total", "sum", None)])


@register("rollup_concat_arrays", """
SELECT o_custkey, to_json(list_sort(list(l_partkey))) AS parts, count(*)::BIGINT AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def q_rollup_concat_arrays(spark, sf_dir):
    """groupArrayArray of each order's part keys per customer: arrays go in, are kept and merged as a multiset, and come out sorted."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("arr"))  # an order's lines
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = concat_arrays(li.join(o, li.l_orderkey == o.o_orderkey), ["o_custkey"], "arr")
    return as_array(parts, ["o_custkey"]).select("o_custkey", F.to_json("array").alias("parts"), F.size("array").cast("bigint").alias("n"))


@register("rollup_sum_map", """
SELECT l_suppkey, l_returnflag AS map_key, sum(CAST(l_quantity AS BIGINT))::BIGINT AS value
FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def q_rollup_sum_map(spark, sf_dir):
    """sumMap of {return flag: quantity} per supplier, as (supplier, key, value) rows."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.create_map(F.col("l_returnflag"), F.col("l_quantity").cast("bigint")).alias("kv"))
    return sum_map(li, ["l_suppkey"], "kv")


REMERGE_SPECS = [("max_price", "max", None), ("last_status", "anyLast", "ord"), ("total", "sum", None)]


@register("rollup_compact", """
SELECT o_custkey, max(o_totalprice) AS max_price, arg_max(o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) AS last_status,
       sum(CAST(o_totalprice AS DECIMAL(38,4))) AS total, max(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice END) AS max_before
FROM orders GROUP BY o_custkey""")
def q_rollup_compact(spark, sf_dir):
    """Two streams of orders roll up into one table that is compacted in place between and behind them; the first snapshot stays readable."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_totalprice").alias("max_price"), F.col("o_orderstatus").alias("last_status"),
        F.struct("o_orderdate", "o_orderkey").alias("ord"), F.col("o_totalprice").cast("decimal(38,4)").alias("total"))
    path, cut = scratch_path(spark, "rollup"), F.lit("1998-01-01").cast("timestamp_ntz")
    day = F.col("ord.o_orderdate")
    for rows in (o.where(day < cut), o.where(~(day < cut))):
        source, checkpoint = scratch_path(spark, "rollup-in"), scratch_path(spark, "rollup-checkpoint")
        rows.repartition(4, "o_custkey").write.parquet(source)
        stream_rollup(file_stream(spark, source, o.schema, 2), ["o_custkey"], REMERGE_SPECS, path, checkpoint)
        compact_in_place(spark, path)
    expire_snapshots(spark, path, keep=2)
    before = read_rollup(spark, path, snapshot=1).select(F.col("o_custkey").alias("of"), F.col("max_price").alias("max_before"))
    return read_rollup(spark, path).join(before, F.col("o_custkey") == F.col("of"), "left").select("o_custkey", "max_price", "last_status", "total", "max_before")


@register("rollup_remerge", """
SELECT o_custkey, max(o_totalprice) AS max_price,
       arg_max(o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) AS last_status,
       sum(CAST(o_totalprice AS DECIMAL(38,4))) AS total
FROM orders GROUP BY o_custkey""")
def q_rollup_remerge(spark, sf_dir):
    """Rollups of two halves of orders merged again equal the rollup of the whole."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_totalprice").alias("max_price"), F.col("o_orderstatus").alias("last_status"),
        F.struct("o_orderdate", "o_orderkey").alias("ord"), F.col("o_totalprice").cast("decimal(38,4)").alias("total"),
        "o_orderdate")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    a = rollup(o.where(F.col("o_orderdate") < cut), ["o_custkey"], REMERGE_SPECS)
    b = rollup(o.where(F.col("o_orderdate") >= cut), ["o_custkey"], REMERGE_SPECS)
    return remerge([a, b], ["o_custkey"], REMERGE_SPECS).select("o_custkey", "max_price", "last_status", "total")
