"""§2.10 read-back queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ladle.operators.bindings import bind_columns, of
from ladle.operators.readback import (
    count_files,
    count_rows,
    error_log_count,
    filter_limit,
    first_containing,
    json_subcolumn,
    read_sorted,
    round_trip_diff,
)
from ladle.plans.io import ORDER_BINDINGS, q_evolve_add_column
from ladle.plans.registry import register, scratch_path, table
from ladle.sinks.table import read_table

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("read_sorted", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey ASC")
def q_read_sorted(spark, sf_dir):
    """select <cols> from t order by <c> asc."""
    return read_sorted(table(spark, sf_dir, "nation"), ["n_nationkey", "n_name"], "n_nationkey")


@register("count_rows", " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS n FROM {t}" for t in TABLES))
def q_count_rows(spark, sf_dir):
    """SELECT COUNT(*) of each supplied table."""
    parts = [count_rows(table(spark, sf_dir, t)).select(F.lit(t).alias("tbl"), "n") for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("count_rows_where", """
SELECT count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS n_null,
       count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS n_extra FROM orders""")
def q_count_rows_where(spark, sf_dir):
    """Evolved orders: rows where the added column IS NULL, and rows LIKE 'extra-%'."""
    t = q_evolve_add_column(spark, sf_dir)
    return t.agg(F.count_if(F.col("extra").isNull()).alias("n_null"),
                 F.count_if(F.col("extra").isNotNull() & F.col("extra").like("extra-%")).alias("n_extra"))


@register("filter_limit", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 100 ORDER BY c_custkey LIMIT 3""")
def q_filter_limit(spark, sf_dir):
    """WHERE a < 100 ... LIMIT 3 (a top-k read-back)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return filter_limit(c, F.col("c_acctbal") < 100, ["c_custkey"], 3)


@register("json_subcolumn", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def q_json_subcolumn(spark, sf_dir):
    """Sub-column $.k of the JSON props."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", json_subcolumn(e, "props", "$.k", "int").alias("k"))


def query_log(spark, sf_dir):
    """A server query log derived from events."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.when(F.col("event_type") == "error", F.lit("ExceptionWhileProcessing"))
        .when(F.col("event_type") == "click", F.lit("ExceptionBeforeStart")).otherwise(F.lit("QueryFinish")).alias("type"),
        (F.col("value").cast("int") % 5 + 250).alias("exception_code"),
        F.array(F.concat(F.lit("db.t"), (F.col("user_id") % 3).cast("string"))).alias("tables"))


@register("error_log_count", """
SELECT count(*) AS n FROM events
WHERE event_type IN ('error', 'click') AND CAST(trunc(value) AS INTEGER) % 5 + 250 = 252
  AND list_contains(['db.t' || CAST(user_id % 3 AS VARCHAR)], 'db.t1')""")
def q_error_log_count(spark, sf_dir):
    """type IN (...) AND exception_code = 252 AND has(tables, 'db.t1')."""
    return error_log_count(query_log(spark, sf_dir), "db.t1", 252)


@register("agent_contains", """
SELECT page_id, url FROM pages WHERE contains(url, 'example.org') ORDER BY page_id LIMIT 1""")
def q_agent_contains(spark, sf_dir):
    """First row whose text contains a given part."""
    return first_containing(table(spark, sf_dir, "pages").select("page_id", "url"), "url", "example.org", ["page_id"])


@register("round_trip_diff", """
SELECT count(*) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS n_missing, count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS n_extra,
       (count(*) FILTER (WHERE o_orderstatus <> 'P') + count(*) FILTER (WHERE o_orderstatus = 'F'))::BIGINT AS n_read FROM orders""")
def q_round_trip_diff(spark, sf_dir):
    """Typed orders against a table that lacks the pending ones and holds the finished ones twice."""
    typed = bind_columns(table(spark, sf_dir, "orders"), [of(c, c, t) for c, t in ORDER_BINDINGS])
    path = scratch_path(spark, "orders-roundtrip")
    typed.where("o_orderstatus <> 'P'").write.parquet(path)
    typed.where("o_orderstatus = 'F'").write.mode("append").parquet(path)
    return round_trip_diff(typed, read_table(spark, path))


@register("count_files", "SELECT count(DISTINCT date_trunc('month', o_orderdate))::BIGINT AS files FROM orders")
def q_count_files(spark, sf_dir):
    """Data files behind a table laid out by month: one each, whatever the number of writers."""
    path = scratch_path(spark, "orders-files")
    o = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    o.repartition("month").write.partitionBy("month").parquet(path)
    return count_files(read_table(spark, path))
