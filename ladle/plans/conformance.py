"""§2.4 type conformance: checked casts in report mode over the supplied tables.

Every row of the table is processed. Expressions on the key (e.g. ``key % 300``)
only *shape* input values so that some fall outside the target range; they
never filter rows.

Each query feeds a derived column (with values outside the target range or
format on purpose) through :func:`ladle.functions.conform.conform` and returns
``(id, value, bad)``: the typed value (NULL when rejected) and the reject flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.functions.conform import coerce_to_integer, conform
from ladle.plans.registry import register, table

# Bounds used by the oracles (2^127-1, 2^255-1, 2^256-1 and minima).
INT128_MAX = "170141183460469231731687303715884105727"
INT256_MAX = "57896044618658097711785492504343953926634992332820282019728792003956564819967"
INT256_MIN_ABS = "57896044618658097711785492504343953926634992332820282019728792003956564819968"
UINT256_MAX = "115792089237316195423570985008687907853269984665640564039457584007913129639935"


def report(df, id_cols, src: Column, decl: str, name: str = "value"):
    """(ids..., value, bad) of a checked cast in report mode."""
    d = df.select(*id_cols, src.alias("_src"))
    src_t = d.schema["_src"].dataType
    r = conform(F.col("_src"), src_t, decl, name)
    return d.select(*id_cols, F.when(r.error.isNull(), r.value).alias("value"), r.error.isNotNull().alias("bad"))


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _simple(key, decl, spark_src, sql_src, sql_value, sql_ok, tbl="orders", id_col="o_orderkey"):
    """Register a one-column conformance query and its oracle."""
    sql = (f"SELECT {id_col}, CASE WHEN ({sql_ok}) THEN {sql_value} END AS value, NOT ({sql_ok}) AS bad "
           f"FROM (SELECT {id_col}, {sql_src} AS v FROM {tbl}) s")

    @register(key, sql)
    def q(spark, sf_dir):
        return report(table(spark, sf_dir, tbl), [id_col], spark_src(), decl)

    q.__doc__ = f"Checked cast to {decl} in report mode."
    return q


def _rng(lo, hi):
    return f"v IS NOT NULL AND v BETWEEN {lo} AND {hi}"


_simple("conform_int8", "Int8", lambda: F.col("o_orderkey") % 300 - 150, "o_orderkey % 300 - 150",
        "v::TINYINT", _rng(-128, 127))
_simple("conform_int16", "Int16", lambda: F.col("o_orderkey") * 7 - 50000, "o_orderkey * 7 - 50000",
        "v::SMALLINT", _rng(-32768, 32767))
_simple("conform_int32", "Int32", lambda: F.col("o_orderkey") * 300000 - 2000000000,
        "o_orderkey * 300000 - 2000000000", "v::INTEGER", _rng(-2147483648, 2147483647))
_simple("conform_int64", "Int64",
        lambda: F.col("o_orderkey").cast("decimal(20,0)") * F.lit(10**15).cast("decimal(20,0)")
        - F.lit(10**17).cast("decimal(20,0)"),
        "CAST(o_orderkey AS DECIMAL(20,0)) * CAST(1000000000000000 AS DECIMAL(20,0)) - CAST(100000000000000000 AS DECIMAL(20,0))",
        "v::BIGINT", "TRY_CAST(v AS BIGINT) IS NOT NULL")
_simple("conform_uint8", "UInt8", lambda: F.when(F.col("p_partkey") % 17 != 0, F.col("p_size") * 6 - 30),
        "CASE WHEN p_partkey % 17 <> 0 THEN p_size * 6 - 30 END", "coalesce(v, 0)::SMALLINT",
        "v IS NULL OR v BETWEEN 0 AND 255", tbl="part", id_col="p_partkey")
_simple("conform_uint16", "UInt16", lambda: F.col("o_custkey") * 50 - 100, "o_custkey * 50 - 100",
        "v::INTEGER", _rng(0, 65535))
_simple("conform_uint32", "UInt32", lambda: F.col("o_orderkey") * 300000 - 1000, "o_orderkey * 300000 - 1000",
        "v::BIGINT", _rng(0, 4294967295))
_simple("conform_uint64", "UInt64",
        lambda: F.col("o_orderkey").cast("decimal(20,0)") * F.lit(1230000000000000).cast("decimal(20,0)")
        + F.lit(str(2**63)).cast("decimal(20,0)"),
        "CAST(o_orderkey AS DECIMAL(20,0)) * CAST(1230000000000000 AS DECIMAL(20,0)) + CAST('9223372036854775808' AS DECIMAL(20,0))",
        "CAST(v AS DECIMAL(20,0))", "v BETWEEN 0 AND CAST('18446744073709551615' AS DECIMAL(38,0))")


def _wide_src_spark(reps: int, digit: str):
    s = F.concat(F.col("o_orderkey").cast("string"), F.lit(digit * reps))
    return F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit("-"), s)).otherwise(s)


def _wide_src_sql(reps: int, digit: str):
    s = f"(CAST(o_orderkey AS VARCHAR) || '{digit * reps}')"
    return f"CASE WHEN o_orderkey % 2 = 1 THEN '-' || {s} ELSE {s} END"


def _digits_sql(v: str) -> str:
    d = f"ltrim(regexp_replace({v}, '^[+-]', ''), '0')"
    return f"(CASE WHEN {d} = '' THEN '0' ELSE {d} END)"


def _le_sql(d: str, bound: str) -> str:
    return f"(length({d}) < {len(bound)} OR (length({d}) = {len(bound)} AND {d} <= '{bound}'))"


def _wide_value_sql(v: str) -> str:
    d = _digits_sql(v)
    return f"(CASE WHEN starts_with({v}, '-') AND {d} <> '0' THEN '-' || {d} ELSE {d} END)"


_simple("conform_int128", "Int128", lambda: _wide_src_spark(35, "7"), _wide_src_sql(35, "7"),
        "CAST(TRY_CAST(v AS HUGEINT) AS VARCHAR)", "TRY_CAST(v AS HUGEINT) IS NOT NULL")
_simple("conform_uint128", "UInt128", lambda: _wide_src_spark(35, "4"), _wide_src_sql(35, "4"),
        "CAST(TRY_CAST(v AS UHUGEINT) AS VARCHAR)", "TRY_CAST(v AS UHUGEINT) IS NOT NULL")
_simple("conform_int256", "Int256", lambda: _wide_src_spark(73, "9"), _wide_src_sql(73, "9"),
        _wide_value_sql("v"),
        f"CASE WHEN starts_with(v, '-') THEN {_le_sql(_digits_sql('v'), INT256_MIN_ABS)} "
        f"ELSE {_le_sql(_digits_sql('v'), INT256_MAX)} END")
_simple("conform_uint256", "UInt256", lambda: _wide_src_spark(73, "9"), _wide_src_sql(73, "9"),
        _wide_value_sql("v"),
        f"(NOT starts_with(v, '-') OR {_digits_sql('v')} = '0') AND {_le_sql(_digits_sql('v'), UINT256_MAX)}")

_simple("conform_float32", "Float32", lambda: F.col("c_acctbal") * F.lit(1e35), "c_acctbal * 1e35",
        "CAST(v AS FLOAT)", "abs(v) <= 3.4028234663852886e38", tbl="customer", id_col="c_custkey")
_simple("conform_float64", "Float64", lambda: F.col("c_acctbal"), "c_acctbal", "CAST(v AS DOUBLE)", "v IS NOT NULL",
        tbl="customer", id_col="c_custkey")
_simple("conform_bool", "Bool", lambda: F.col("quality") + F.col("toxic"), "quality + toxic",
        "v = 1", "v IN (0, 1)", tbl="labels", id_col="doc_id")
_simple("conform_string", "String", lambda: F.col("c_name"), "c_name", "v", "TRUE", tbl="customer", id_col="c_custkey")
_simple("conform_fixed_string", "FixedString(10)",
        lambda: F.when(F.col("c_custkey") % 5 == 0, F.col("c_name")).otherwise(F.substring("c_name", 1, 10)),
        "CASE WHEN c_custkey % 5 = 0 THEN c_name ELSE substr(c_name, 1, 10) END", "v",
        "strlen(v) <= 10", tbl="customer", id_col="c_custkey")
_simple("conform_json", "JSON",
        lambda: F.when(F.col("event_id") % 50 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props")),
        "CASE WHEN event_id % 50 = 0 THEN props || '}' ELSE props END", "v", "json_valid(v)",
        tbl="events", id_col="event_id")


def _uuid_spark():
    h = F.md5(F.col("o_orderkey").cast("string"))
    u = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4),
                    F.substring(h, 21, 12))
    return (F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("g"), F.substring(u, 2, 35)))
            .when(F.col("o_orderkey") % 3 == 0, F.upper(u)).otherwise(u))


_UUID_SQL_U = ("(substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(o_orderkey AS VARCHAR)), 9, 4)"
               " || '-' || substr(md5(CAST(o_orderkey AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(o_orderkey AS VARCHAR)), 17, 4)"
               " || '-' || substr(md5(CAST(o_orderkey AS VARCHAR)), 21, 12))")
_simple("conform_uuid", "UUID", _uuid_spark,
        f"CASE WHEN o_orderkey % 13 = 0 THEN 'g' || substr({_UUID_SQL_U}, 2, 35) "
        f"WHEN o_orderkey % 3 = 0 THEN upper({_UUID_SQL_U}) ELSE {_UUID_SQL_U} END",
        "lower(v)", "regexp_full_match(v, '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}')")


def _shift_years_spark(col: str, key: str, mod: int, off: int):
    return F.timestamp_add("YEAR", (F.col(key) % mod - off).cast("int"), F.col(col))


_simple("conform_date", "Date", lambda: _shift_years_spark("o_orderdate", "o_orderkey", 300, 100),
        "o_orderdate + to_years(CAST(o_orderkey % 300 - 100 AS INTEGER))", "CAST(v AS DATE)",
        "CAST(v AS DATE) BETWEEN DATE '1970-01-01' AND DATE '2149-06-06'")
_simple("conform_date32", "Date32", lambda: _shift_years_spark("o_orderdate", "o_orderkey", 300, 100),
        "o_orderdate + to_years(CAST(o_orderkey % 300 - 100 AS INTEGER))", "CAST(v AS DATE)",
        "CAST(v AS DATE) BETWEEN DATE '1900-01-01' AND DATE '2299-12-31'")
_simple("conform_datetime", "DateTime", lambda: _shift_years_spark("ts", "event_id", 200, 80),
        "ts + to_years(CAST(event_id % 200 - 80 AS INTEGER))", "date_trunc('second', v)",
        "date_trunc('second', v) BETWEEN TIMESTAMP '1970-01-01 00:00:00' AND TIMESTAMP '2106-02-07 06:28:15'",
        tbl="events", id_col="event_id")
_simple("conform_simple_aggregate", "SimpleAggregateFunction(sum, Decimal(38, 4))", lambda: F.col("o_totalprice"),
        "o_totalprice", "CAST(v AS DECIMAL(38,4))", "v IS NOT NULL")
_simple("conform_zoned_to_utc", "DateTime64(6, 'UTC')",
        lambda: F.to_utc_timestamp(F.col("o_orderdate").cast("timestamp"), "Asia/Kolkata"),
        "CAST(timezone('UTC', timezone('Asia/Kolkata', o_orderdate)) AS TIMESTAMP)", "v", "v IS NOT NULL")


@register("conform_decimal", """
SELECT o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(10,2)) AS value_10_2, TRY_CAST(o_totalprice AS DECIMAL(10,5)) AS value_10_5,
       TRY_CAST(o_totalprice AS DECIMAL(10,5)) IS NULL AS bad_10_5
FROM orders""")
def q_conform_decimal(spark, sf_dir):
    """o_totalprice as Decimal(10, 2) and Decimal(10, 5) (the latter overflows)."""
    o = orders(spark, sf_dir)
    a = conform(F.col("o_totalprice"), o.schema["o_totalprice"].dataType, "Decimal(10, 2)", "value_10_2")
    b = conform(F.col("o_totalprice"), o.schema["o_totalprice"].dataType, "Decimal(10, 5)", "value_10_5")
    return o.select("o_orderkey", F.when(a.error.isNull(), a.value).alias("value_10_2"),
                    F.when(b.error.isNull(), b.value).alias("value_10_5"), b.error.isNotNull().alias("bad_10_5"))


_DEC_SRC_SQL = "(CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '' END) || repeat('9', CAST(70 + o_orderkey % 8 AS INTEGER)) || '.' || CAST(o_orderkey % 100 AS VARCHAR)"


def _dec_src_spark():
    return F.concat(F.when(F.col("o_orderkey") % 2 == 0, F.lit("-")).otherwise(F.lit("")),
                    F.repeat(F.lit("9"), (F.col("o_orderkey") % 8 + 70).cast("int")), F.lit("."),
                    (F.col("o_orderkey") % 100).cast("string"))


_DEC_INT = "ltrim(split_part(regexp_replace(v, '^[+-]', ''), '.', 1), '0')"
_DEC_FRAC = "rtrim(split_part(v, '.', 2), '0')"
_simple("conform_decimal256", "Decimal(76, 3)", _dec_src_spark, _DEC_SRC_SQL,
        f"(CASE WHEN starts_with(v, '-') AND NOT ({_DEC_INT} = '' AND {_DEC_FRAC} = '') THEN '-' ELSE '' END) || "
        f"(CASE WHEN {_DEC_INT} = '' THEN '0' ELSE {_DEC_INT} END) || '.' || rpad({_DEC_FRAC}, 3, '0')",
        f"length({_DEC_INT}) <= 73 AND length({_DEC_FRAC}) <= 3")


@register("conform_datetime64", """
SELECT event_id, date_trunc('second', ts) AS value_s0, date_trunc('millisecond', ts) AS value_s3, ts AS value_s6,
       (epoch_us(ts) * 1000)::BIGINT AS value_s9
FROM events""")
def q_conform_datetime64(spark, sf_dir):
    """events.ts as DateTime64 at scales 0, 3, 6 (timestamps) and 9 (ticks)."""
    e = table(spark, sf_dir, "events")
    st = e.schema["ts"].dataType
    cols = [F.col("event_id")]
    for s in (0, 3, 6, 9):
        r = conform(F.col("ts"), st, f"DateTime64({s}, 'UTC')", "ts")
        cols.append(F.when(r.error.isNull(), r.value).alias(f"value_s{s}"))
    return e.select(*cols)


@register("conform_array", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN greatest(l_partkey * 40, l_suppkey * 400, l_linenumber) > 65535 THEN NULL
            ELSE to_json([l_partkey * 40, l_suppkey * 400, l_linenumber]) END AS value,
       greatest(l_partkey * 40, l_suppkey * 400, l_linenumber) > 65535 AS bad
FROM lineitem""")
def q_conform_array(spark, sf_dir):
    """Per-row Array(UInt16) built from lineitem keys (large keys overflow UInt16)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.array(F.col("l_partkey") * 40, F.col("l_suppkey") * 400, F.col("l_linenumber").cast("bigint")).alias("arr"))
    r = conform(F.col("arr"), li.schema["arr"].dataType, "Array(UInt16)", "arr")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.when(r.error.isNull(), F.to_json(r.value)).alias("value"), r.error.isNotNull().alias("bad"))


@register("conform_map", """
WITH m AS (SELECT l_orderkey, l_returnflag, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_returnflag AS key, CAST(q AS DECIMAL(20,0)) AS value FROM m""")
def q_conform_map(spark, sf_dir):
    """Per-order Map(String, UInt64) of quantity by return flag, exploded to rows."""
    li = table(spark, sf_dir, "lineitem")
    per = li.groupBy("l_orderkey", "l_returnflag").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    m = per.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "q"))).alias("m"))
    r = conform(F.col("m"), m.schema["m"].dataType, "Map(String, UInt64)", "m")
    return m.select("l_orderkey", F.explode(r.value).alias("key", "value"))


@register("conform_tuple", """
SELECT o_orderkey, CASE WHEN o_custkey * 50 <= 65535 THEN o_orderstatus END AS t_1,
       CASE WHEN o_custkey * 50 <= 65535 THEN CAST(o_custkey * 50 AS INTEGER) END AS t_2,
       CASE WHEN o_custkey * 50 <= 65535 THEN o_totalprice > 100000 END AS t_3,
       o_custkey * 50 > 65535 AS bad
FROM orders""")
def q_conform_tuple(spark, sf_dir):
    """Tuple(FixedString(1), UInt16, Bool) built from orders columns."""
    o = orders(spark, sf_dir).select("o_orderkey", F.struct(
        F.col("o_orderstatus"), F.col("o_custkey") * 50, F.col("o_totalprice") > 100000).alias("t"))
    r = conform(F.col("t"), o.schema["t"].dataType, "Tuple(FixedString(1), UInt16, Bool)", "t")
    v = F.when(r.error.isNull(), r.value)
    return o.select("o_orderkey", v["_1"].alias("t_1"), v["_2"].alias("t_2"), v["_3"].alias("t_3"),
                    r.error.isNotNull().alias("bad"))


@register("conform_nullable", """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS value, FALSE AS bad FROM orders""")
def q_conform_nullable(spark, sf_dir):
    """Nullable(String): NULL stays NULL and is not an error."""
    src = F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
    return report(orders(spark, sf_dir), ["o_orderkey"], src, "Nullable(String)")


@register("conform_low_cardinality", """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS value,
       o_orderkey % 9 = 0 AS bad FROM orders""")
def q_conform_low_cardinality(spark, sf_dir):
    """LowCardinality(String) (non-nullable): NULL is an error naming the column."""
    src = F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
    return report(orders(spark, sf_dir), ["o_orderkey"], src, "LowCardinality(String)")


@register("coerce_to_integer", """
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderkey % 10 = 0 THEN 'x' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS INTEGER) AS from_string,
       CAST(trunc(greatest(least(o_totalprice * 1000, 2147483647), -2147483648)) AS INTEGER) AS from_double,
       CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS from_bool,
       CAST(((o_orderkey * 1000000 + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648 AS INTEGER) AS from_long,
       o_orderkey % 10 = 0 AS bad_string
FROM orders""")
def q_coerce_to_integer(spark, sf_dir):
    """Integer from strings, doubles (truncated, saturated), booleans and longs (low 32 bits)."""
    o = orders(spark, sf_dir).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("x"), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("o_orderkey").cast("string")).alias("s"),
        (F.col("o_totalprice") * 1000).alias("d"),
        (F.col("o_totalprice") > 100000).alias("b"),
        (F.col("o_orderkey") * 1000000).alias("l"))
    s = coerce_to_integer(F.col("s"), o.schema["s"].dataType, "s")
    d = coerce_to_integer(F.col("d"), o.schema["d"].dataType, "d")
    b = coerce_to_integer(F.col("b"), o.schema["b"].dataType, "b")
    lg = coerce_to_integer(F.col("l"), o.schema["l"].dataType, "l")
    return o.select("o_orderkey", s.value.alias("from_string"), d.value.alias("from_double"),
                    b.value.alias("from_bool"), lg.value.alias("from_long"), s.error.isNotNull().alias("bad_string"))
