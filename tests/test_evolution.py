"""Columns that change while old files stay as they are."""

import datetime

import pytest
from pyspark.sql import functions as F

from ladle.operators.bindings import TableSpec, of
from ladle.sinks import evolution as E
from ladle.sinks.table import LoadOptions, SchemaDriftError, UnknownColumnError, load, read_table


def rows(spark, path):
    return sorted(map(tuple, E.read(spark, path).collect()), key=str)


def test_columns_change(spark, tmp):
    path = f"{tmp}/t"
    E.create_table(spark, path, TableSpec.of("t", [("k", "Int32"), ("v", "Float32"), ("d", "Decimal(6, 2)")]))
    with pytest.raises(ValueError):
        E.create_table(spark, path, TableSpec.of("t", [("k", "Int32")]))
    E.append(spark.sql("select 1 k, cast(1.5 as float) v, cast(2.25 as decimal(6,2)) d"), path)
    E.add_column(spark, path, "note", "Nullable(String)", "concat('no', 'ne')")
    E.append(spark.sql("select cast(null as string) note, 2 k"), path)  # explicit NULL; v and d left out
    assert rows(spark, path) == [(1, 1.5, __import__("decimal").Decimal("2.25"), "none"), (2, None, None, None)]
    E.rename_column(spark, path, "v", "value")
    E.widen_column(spark, path, "k", "Int64")
    E.widen_column(spark, path, "value", "Float64")
    E.widen_column(spark, path, "d", "Decimal(12, 4)")
    E.append(spark.sql("select 3000000000 k, 2.5D value, 'x' note"), path)
    assert E.read(spark, path).dtypes == [("k", "bigint"), ("value", "double"), ("d", "decimal(12,4)"), ("note", "string")]
    assert [r[:2] + r[3:] for r in rows(spark, path)] == [(1, 1.5, "none"), (2, None, None), (3000000000, 2.5, "x")]
    E.drop_column(spark, path, "note")
    E.add_column(spark, path, "note", "Int32", "4")
    assert [r[3] for r in rows(spark, path)] == [4, 4, 4]  # another column than the one that was dropped
    E.rename_column(spark, path, "value", "v2")
    E.rename_column(spark, path, "k", "value")
    assert [(r.value, r.v2) for r in E.read(spark, path).orderBy("value").collect()] == [(1, 1.5), (2, None), (3000000000, 2.5)]
    assert E.read(spark, path).where("v2 > 2").select("value").collect()[0].value == 3000000000


def test_ids_are_never_given_again(spark, tmp):
    path = f"{tmp}/t"
    E.create_table(spark, path, TableSpec.of("t", [("a", "Int32"), ("b", "Int32")]))
    E.append(spark.sql("select 1 a, 2 b"), path)
    for name in ("b", "c", "c"):
        E.drop_column(spark, path, name)
        E.add_column(spark, path, "c", "Int32")
    assert rows(spark, path) == [(1, None)]


def test_what_is_refused(spark, tmp):
    path = f"{tmp}/t"
    E.create_table(spark, path, TableSpec.of("t", [("a", "Int64"), ("day", "Date")]))
    for change in (lambda: E.widen_column(spark, path, "a", "Int32"), lambda: E.widen_column(spark, path, "a", "String"),
                   lambda: E.append(spark.sql("select 'x' a"), path)):
        with pytest.raises(SchemaDriftError):
            change()
    for change in (lambda: E.rename_column(spark, path, "z", "y"), lambda: E.drop_column(spark, path, "z"), lambda: E.append(spark.sql("select 1 z"), path)):
        with pytest.raises(UnknownColumnError):
            change()
    for change in (lambda: E.rename_column(spark, path, "a", "DAY"), lambda: E.add_column(spark, path, "A", "Int32"), lambda: E.read(spark, f"{tmp}/none")):
        with pytest.raises(ValueError):
            change()
    E.append(spark.sql("select 1L a, date'2020-01-02' day"), path)
    E.widen_column(spark, path, "day", "DateTime64(6)")
    assert rows(spark, path) == [(1, datetime.datetime(2020, 1, 2))]
    with pytest.raises(Exception):
        E.add_column(spark, path, "bad", "Int32", "no such expression(")
    E.drop_column(spark, path, "a")
    with pytest.raises(ValueError):
        E.drop_column(spark, path, "day")


def test_files_of_a_clustered_load_hold_a_span_each(spark, tmp):
    spec = TableSpec.of("t", [("k", "Int64"), ("v", "String")], sort_key=["k"])
    df = spark.range(5000).select(F.xxhash64("id").alias("k"), F.lit("x").alias("v")).repartition(7)
    load(df, [of("k", "k", "Int64"), of("v", "v", "String")], f"{tmp}/t", LoadOptions(cluster=True), table=spec)
    spans = sorted((r.low, r.high, r.n) for r in read_table(spark, f"{tmp}/t").groupBy("_metadata.file_path").agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.count(F.lit(1)).alias("n")).collect())
    assert sum(n for _, _, n in spans) == 5000 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
