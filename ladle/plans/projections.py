"""§2.3 projections, defaults, null rules and row policies.

Whole tables are processed; key-modulo expressions only decide which values
are nulled to exercise the null rules, they never filter rows for cost.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators.bindings import (
    TableSpec,
    array,
    bind_columns,
    decimal,
    default_for_omitted,
    fixed_string,
    match_by_name,
    of,
)
from ladle.operators.selection import split_by_ordinal
from ladle.plans.registry import register, table


@register("map_to_record", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
       CAST(c_nationkey AS SMALLINT) AS nation FROM customer""")
def q_map_to_record(spark, sf_dir):
    """customer mapped to a typed record through a binding list."""
    c = table(spark, sf_dir, "customer")
    return bind_columns(c, [of("c_custkey", "id", "Int64"), of("c_name", "name", "String"),
                            of("c_acctbal", "balance", "Float64"),
                            of("c_mktsegment", "segment", "LowCardinality(String)"),
                            of("c_nationkey", "nation", "UInt8")])


@register("bind_columns", """
SELECT CAST(l_orderkey AS DECIMAL(20,0)) AS order_id, CAST(l_linenumber AS TINYINT) AS line,
       CAST(l_partkey AS INTEGER) AS part, CAST(l_quantity AS DECIMAL(12,2)) AS qty,
       CAST(l_extendedprice AS DECIMAL(15,2)) AS price, CAST(l_discount AS FLOAT) AS discount,
       l_returnflag AS flag, CAST(l_shipdate AS DATE) AS ship FROM lineitem""")
def q_bind_columns(spark, sf_dir):
    """lineitem renamed and cast to declared target types."""
    li = table(spark, sf_dir, "lineitem")
    return bind_columns(li, [of("l_orderkey", "order_id", "UInt64"), of("l_linenumber", "line", "Int8"),
                             of("l_partkey", "part", "Int32"),
                             decimal("l_quantity", "qty", 12, 2), decimal("l_extendedprice", "price", 15, 2),
                             of("l_discount", "discount", "Float32"), fixed_string("l_returnflag", "flag", 1),
                             of("l_shipdate", "ship", "Date")])


@register("match_by_name", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_match_by_name(spark, sf_dir):
    """nation bound in reverse order, written in the table's column order."""
    n = table(spark, sf_dir, "nation")
    bound = bind_columns(n, [of("n_regionkey", "n_regionkey", "Int32"), of("n_name", "n_name", "String"),
                             of("n_nationkey", "n_nationkey", "Int32")])
    return match_by_name(bound, ["n_nationkey", "n_name", "n_regionkey"])


REGION_TABLE = TableSpec.of("region_ext", [("r_regionkey", "Int32"), ("r_name", "String"),
                                           ("r_comment", "String", "'omg'"), ("r_code", "Int32", "7")])


@register("default_for_omitted", "SELECT r_regionkey, r_name, 'omg' AS r_comment, 7 AS r_code FROM region")
def q_default_for_omitted(spark, sf_dir):
    """region loaded with two unbound columns: each row gets the table DEFAULT."""
    r = table(spark, sf_dir, "region")
    bound = bind_columns(r, [of("r_regionkey", "r_regionkey", "Int32"), of("r_name", "r_name", "String")])
    return default_for_omitted(bound, REGION_TABLE)


@register("null_stays_null", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderdate END AS created_on FROM orders""")
def q_null_stays_null(spark, sf_dir):
    """An explicit NULL into a nullable column with a DEFAULT stays NULL."""
    t = TableSpec.of("defaults", [("id", "Int64"),
                                  ("created_on", "Nullable(DateTime64(6, 'UTC'))", "TIMESTAMP_NTZ'2023-09-11 13:14:15'")])
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(None)).otherwise(F.col("o_orderdate"))
        .alias("created"))
    bound = bind_columns(o, [of("o_orderkey", "id", "Int64"),
                             of("created", "created_on", "Nullable(DateTime64(6, 'UTC'))")])
    return default_for_omitted(bound, t)


@register("null_unsigned_to_zero", """
SELECT p_partkey, CAST(coalesce(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END, 0) AS INTEGER) AS size_u16,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END AS size_nullable_i32
FROM part""")
def q_null_unsigned_to_zero(spark, sf_dir):
    """UInt16 NULL becomes 0 (even Nullable); Int32 NULL stays NULL."""
    p = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.lit(None)).otherwise(F.col("p_size")).alias("s"))
    return bind_columns(p, [of("s", "size_u16", "Nullable(UInt16)"), of("s", "size_nullable_i32", "Nullable(Int32)")],
                        keep=["p_partkey"])


@register("require_not_null", """
SELECT col, count(*) AS violations FROM (
  SELECT 'customer_id' AS col FROM orders WHERE o_orderkey % 11 = 0
  UNION ALL SELECT 'priority' AS col FROM orders WHERE o_orderkey % 13 = 0) v
GROUP BY col""")
def q_require_not_null(spark, sf_dir):
    """Report mode: NULL violations of non-nullable columns, counted per column."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("cust"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("prio"))
    b = bind_columns(o, [of("o_orderkey", "id", "Int64"), of("cust", "customer_id", "Int64"),
                         of("prio", "priority", "String")], mode="report")
    # explode_outer + a filter on the generated column: the checks run once (see error_rows).
    v = b.select(F.explode_outer("_errors").alias("e")).where(F.col("e").startswith("Null value"))
    return v.select(F.regexp_extract("e", r": (\S+)$", 1).alias("col")).groupBy("col").agg(
        F.count(F.lit(1)).alias("violations"))


@register("filter_null_records", """
SELECT event_type, count(*) AS n FROM events WHERE event_id % 10 <> 0 GROUP BY event_type""")
def q_filter_null_records(spark, sf_dir):
    """Null records are dropped before the sink (a null record would fail it)."""
    e = table(spark, sf_dir, "events")
    rec = F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.struct("event_id", "event_type"))
    r = e.select(rec.alias("r")).where(F.col("r").isNotNull())
    return r.groupBy(F.col("r.event_type").alias("event_type")).agg(F.count(F.lit(1)).alias("n"))


SPLIT_N = 5000


@register("split_by_ordinal", f"""
WITH k AS (SELECT max(o_orderkey) AS kth FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT {SPLIT_N}))
SELECT CASE WHEN o_orderkey <= kth THEN 'first' ELSE 'rest' END AS part, count(*) AS n,
       min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
FROM orders, k GROUP BY 1""")
def q_split_by_ordinal(spark, sf_dir):
    """First 5000 orders by key, and the rest: the 5000th key is selected, nothing is sorted."""
    parts = split_by_ordinal(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", SPLIT_N)
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("min_key"), F.max("o_orderkey").alias("max_key"))


@register("project_composites", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       to_json(list_sort([l_partkey, l_suppkey])) AS parts, to_json(map([l_returnflag], [l_linestatus])) AS flags,
       l_linenumber AS t_line, l_returnflag AS t_flag
FROM lineitem""")
def q_project_composites(spark, sf_dir):
    """Per-row Array(Int64) (sorted keys), Map(String, String) and Tuple(Int32, String) columns."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.array_sort(F.array("l_partkey", "l_suppkey")).alias("parts_arr"),
        F.create_map("l_returnflag", "l_linestatus").alias("flags_map"),
        F.struct("l_linenumber", "l_returnflag").alias("tup"))
    b = bind_columns(li, [array("parts_arr", "parts", "Int64"), of("flags_map", "flags", "Map(String, String)"),
                          of("tup", "tup", "Tuple(Int32, String)")],
                     keep=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return b.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_json("parts").alias("parts"),
                    F.to_json("flags").alias("flags"), F.col("tup._1").alias("t_line"), F.col("tup._2").alias("t_flag"))
