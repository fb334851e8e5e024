"""Escaped tab-separated lines, JSON array lines, NULL markers, and typed connection options."""

import pytest
from pyspark.sql import types as T

from ladle.operators.bindings import TableSpec
from ladle.sinks import table as module
from ladle.sinks.connection import Connection
from ladle.sinks.table import LoadOptions, SchemaDriftError, check_drift, known_schema, load_raw, note_schema, parse_raw, read_table, target_schema

SPEC = TableSpec.of("t", [("k", "Int64"), ("name", "String"), ("note", "Nullable(String)", "'none'"), ("v", "Nullable(Float64)")])


def parsed(spark, fmt, *lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    return [(tuple(r[c] for c in SPEC.names), list(r["_errors"])) for r in parse_raw(df, SPEC, fmt, keep=["i"]).orderBy("i").collect()]


def test_tab_separated(spark):
    got = parsed(spark, "tsv", "1\ta\\tb\\\\n\tx\\ny\t2.5", "2\t\t\t", "3\t\\N\t\\N\t\\N", "4\t\\\\N\t\\x\\'\\0\\b\t-1e3", "5\ta", None, "x\ta\tb\t1\n", "6\t\\\\\\t\t\\\\\\\\\t1")
    assert got[0] == ((1, "a\tb\\n", "x\ny", 2.5), [])
    assert got[1] == ((2, "", "none", None), [])
    assert got[2][0][2:] == (None, None) and len(got[2][1]) == 1  # NULL for a column that has none
    assert got[3] == ((4, "\\N", "x'\0\b", -1000.0), [])
    assert got[4][1] == ["Expected 4 fields"] and got[5][1] == ["Null record"] and len(got[6][1]) == 1
    assert got[7] == ((6, "\\\t", "\\\\", 1.0), [])


def test_json_arrays(spark):
    got = parsed(spark, "json_rows", '[1, "a\\tb", null, 2.5]', ' ["2","x","y",null]', "[3,null,null,null]", '{"k":1}', "[1,2]", "[1,", "[4,\"a\",\"b\",1] [5]", None, '[6,"[]",{"a":1},7]')
    assert got[0] == ((1, "a\tb", None, 2.5), []) and got[1] == ((2, "x", "y", None), [])
    assert len(got[2][1]) == 1 and got[3][1] == ["Cannot parse JSON array"] and got[4][1] == ["Expected 4 fields"]
    assert got[5][1] == ["Cannot parse JSON array"] and got[6][1] == ["Cannot parse JSON array"] and got[7][1] == ["Null record"]
    assert got[8] == ((6, "[]", '{"a":1}', 7.0), [])


def test_csv_null_marker(spark):
    got = parsed(spark, "csv", "1,a,\\N,\\N", "2,a,,1")
    assert got == [((1, "a", None, None), []), ((2, "a", "none", 1.0), [])]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="json_rows"):
        parsed(spark, "xml", "1")


def test_loads(spark, tmp):
    lines = spark.createDataFrame([("1\ta\\tb\t\\N\t1",), ("2\tc\t\t\\N",)], "value string")
    load_raw(lines, SPEC, f"{tmp}/t", "tsv")
    assert sorted(map(tuple, read_table(spark, f"{tmp}/t").collect()), key=str) == [(1, "a\tb", None, 1.0), (2, "c", "none", None)]


def test_connection_settings_are_merged():
    c = Connection("jdbc:x://h/db", "t", "me", "secret", settings={"queryTimeout": 5, "socketTimeout": "9"})
    assert "secret" not in repr(c)
    assert c.writer_options({"batchsize": 7}) == {"url": "jdbc:x://h/db", "dbtable": "t", "user": "me", "password": "secret", "batchsize": "7", "isolationLevel": "NONE",
                                                  "queryTimeout": "5", "truncate": "false", "socketTimeout": "9"}
    assert c.with_settings(numPartitions=3).writer_options()["numPartitions"] == "3"
    options = LoadOptions(connection=c, writer_options={"truncate": True}, max_batch_size=20).validate()
    assert options.target_format == "jdbc" and options.writer_options["truncate"] == "true" and options.writer_options["batchsize"] == "20"
    assert LoadOptions(connection=c.with_settings(batchsize=3)).validate().writer_options["batchsize"] == "3"
    for bad in ({"url": "x", "table": "t"}, {"url": "jdbc:x", "table": " "}, {"url": "jdbc:x", "table": "t", "password": "p"},
                {"url": "jdbc:x", "table": "t", "settings": {"batchsize": -1}}, {"url": "jdbc:x", "table": "t", "settings": {"batchsize": "9"}},
                {"url": "jdbc:x", "table": "t", "settings": {"isolationLevel": "SOME"}}, {"url": "jdbc:x", "table": "t", "settings": {"truncate": 1}}):
        with pytest.raises(ValueError):
            Connection(**bad)
    with pytest.raises(ValueError):
        LoadOptions(connection=c, target_format="table").validate()


def test_database_types_are_compared_by_kind(spark, monkeypatch):
    """No database is at hand: its columns are given."""
    options = LoadOptions(target_format="jdbc")
    monkeypatch.setattr(module, "target_schema", lambda *_: T.StructType().add("k", "decimal(20,0)").add("day", "timestamp").add("name", "string"))
    check_drift(spark, "", T.StructType().add("k", "long").add("day", "date").add("name", "string"), options)
    for name, kind in (("k", "string"), ("day", "long"), ("name", "date")):
        with pytest.raises(SchemaDriftError):
            check_drift(spark, "", T.StructType().add(name, kind), options)


def test_noted_columns(spark, tmp):
    """A table's columns are asked of the note, not of every file."""
    path = f"{tmp}/t"
    assert known_schema(spark, path) is None
    spark.range(3).write.parquet(path)
    assert target_schema(spark, path) == T.StructType().add("id", "long")
    note_schema(spark, path, T.StructType().add("id", "long"))
    note_schema(spark, path, T.StructType().add("é", "string").add("id", "long"))
    assert known_schema(spark, path) == target_schema(spark, path) == T.StructType().add("id", "long").add("é", "string")
    assert read_table(spark, path).columns == ["id"]
    with pytest.raises(SchemaDriftError):
        check_drift(spark, path, T.StructType().add("id", "string"))
