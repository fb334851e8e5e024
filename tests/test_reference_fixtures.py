"""Scenarios shaped like the reference's own tests (see SURVEY §5)."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.sizes import header_bytes, row_payload_bytes, value_bytes, varint_len_py
from ladle.operators.bindings import TableSpec, bind_columns, of
from ladle.operators.readback import json_subcolumn
from ladle.sinks.table import LoadOptions, load_raw, read_table


def test_varint_and_value_sizes(spark):
    assert [varint_len_py(n) for n in (0, 127, 128, 16383, 16384)] == [1, 1, 2, 2, 3]
    df = spark.createDataFrame([("a" * 127, "b" * 128, None, [1, 2, 3], {"k": 1}, ("x", 7))],
                               "s1 string, s2 string, n string, arr array<bigint>, m map<string,bigint>, "
                               "t struct<a:string,b:bigint>")
    r = df.select(
        value_bytes(F.col("s1"), "String").alias("s1"), value_bytes(F.col("s2"), "String").alias("s2"),
        value_bytes(F.col("n"), "Nullable(String)").alias("n"),
        value_bytes(F.col("s1"), "Nullable(String)").alias("s1n"),
        value_bytes(F.col("arr"), "Array(Int64)").alias("arr"),
        value_bytes(F.col("m"), "Map(String, UInt64)").alias("m"),
        value_bytes(F.col("t").cast("struct<_1:string,_2:bigint>"), "Tuple(String, Int64)").alias("t"),
        value_bytes(F.lit(5), "SimpleAggregateFunction(max, Int64)").alias("saf"),
        value_bytes(F.lit(5), "Int64").alias("inner"),
    ).first()
    assert (r.s1, r.s2, r.n, r.s1n) == (128, 130, 1, 129)
    assert r.arr == 1 + 3 * 8 and r.m == 1 + (1 + 1) + 8 and r.t == (1 + 1) + 8
    assert r.saf == r.inner == 8  # an aggregate-function column is encoded as its inner type
    assert header_bytes([("id", "Int32")]) == 1 + (1 + 2) + (1 + 5)


def test_datetime_rows_at_each_scale(spark):
    rows = [("user-001", "2024-01-15T10:30:00.000000000Z", 42),
            ("user-002", "2024-02-20T14:15:30.301123321Z", 158),
            ("user-003", "2024-03-10T08:45:12.121234556Z", 7)]
    df = spark.createDataFrame(rows, "id string, created_at string, num_logins int")
    out = bind_columns(df, [of("id", "id", "String"), of("created_at", "s0", "DateTime"),
                            of("created_at", "s3", "DateTime64(3)"), of("created_at", "s6", "DateTime64(6)"),
                            of("created_at", "s9", "DateTime64(9)"), of("num_logins", "n", "Int32")]).orderBy("id")
    got = [tuple(r) for r in out.collect()]
    assert got[1] == ("user-002", dt.datetime(2024, 2, 20, 14, 15, 30), dt.datetime(2024, 2, 20, 14, 15, 30, 301000),
                      dt.datetime(2024, 2, 20, 14, 15, 30, 301123), 1708438530301123321, 158)
    assert got[2][4] == 1710060312121234556 and got[0][4] == 1705314600000000000


def test_json_payload_subcolumn(spark):
    df = spark.createDataFrame([(i, f'{{"index" : "{i}", "bar" : "foo" }}') for i in range(5)],
                               "longPrimitive long, jsonPayload string")
    typed = bind_columns(df, [of("longPrimitive", "longPrimitive", "Int64"), of("jsonPayload", "jsonPayload", "JSON")])
    assert {r.bar for r in typed.select(json_subcolumn(typed, "jsonPayload", "$.bar").alias("bar")).collect()} == {"foo"}


def test_corruption_after_row_5000_keeps_first_5000(spark, tmp):
    """Field 3 becomes unparsable after row 5000: batches holding it are dropped."""
    lines = spark.range(0, 10000, numPartitions=1).select(
        F.concat_ws(",", F.lit("2020-01-01"), F.concat(F.lit("loc_"), F.col("id").cast("string")),
                    F.when(F.col("id") < 5000, F.col("id").cast("string")).otherwise(F.lit("invalid_number")))
        .alias("value"))
    spec = TableSpec.of("covid", [("date", "Date"), ("location_key", "LowCardinality(String)"), ("value", "Int32")])
    out = os.path.join(tmp, "covid")
    res = load_raw(lines, spec, out, "csv", LoadOptions(max_batch_size=1000, failure="drop_batch"))
    assert res.metrics["records_sent"] == 5000 and res.metrics["dropped_batches"] == 5
    assert read_table(spark, out).count() == 5000


def test_every_value_class_round_trips_through_parquet(spark, tmp):
    """The state round trip of the reference, re-aimed: typed values survive a Parquet round trip."""
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("b", T.BooleanType()), ("i8", T.ByteType()), ("i16", T.ShortType()), ("i32", T.IntegerType()),
        ("i64", T.LongType()), ("f", T.FloatType()), ("d", T.DoubleType()), ("s", T.StringType()),
        ("bin", T.BinaryType()), ("dt", T.DateType()), ("ts", T.TimestampNTZType()),
        ("arr", T.ArrayType(T.StringType())), ("m", T.MapType(T.StringType(), T.LongType()))]])
    row = (True, 1, 2, 3, 4, 1.5, 2.5, "emoji \U0001F600", b"\x00\x01", dt.date(2024, 1, 1),
           dt.datetime(2024, 1, 1, 1, 2, 3, 4), ["a", None], {"k": 1})
    df = spark.createDataFrame([row], schema)
    p = os.path.join(tmp, "rt")
    df.write.parquet(p)
    from ladle.operators.readback import round_trip_diff

    r = round_trip_diff(df, spark.read.parquet(p)).first()
    assert (r.n_missing, r.n_extra) == (0, 0)


def test_opaque_record_mapper(spark):
    """A user mapper over opaque records (one pandas batch at a time), then typed bindings."""
    import pandas as pd

    from ladle.operators.bindings import map_records

    raw = spark.createDataFrame([("a=1;b=x",), ("a=2;b=y",)], "rec string")

    def to_map(pdf: pd.DataFrame) -> pd.DataFrame:
        kv = pdf["rec"].str.split(";").map(lambda parts: dict(p.split("=") for p in parts))
        return pd.DataFrame({"a": kv.map(lambda d: d["a"]), "b": kv.map(lambda d: d["b"])})

    mapped = map_records(raw, to_map, "a string, b string")
    out = bind_columns(mapped, [of("a", "a", "UInt8"), of("b", "b", "FixedString(1)")]).orderBy("a").collect()
    assert [tuple(r) for r in out] == [(1, "x"), (2, "y")]


def test_json_as_variant(spark):
    df = spark.createDataFrame([('{"bar": "foo", "n": 3}',)], "j string")
    v = bind_columns(df, [of("j", "j", "JSON")], json_as="variant")
    assert v.schema["j"].dataType.typeName() == "variant"
    r = v.select(F.variant_get("j", "$.bar", "string").alias("bar"), F.variant_get("j", "$.n", "int").alias("n")).first()
    assert (r.bar, r.n) == ("foo", 3)


def test_delimited_record_rules(spark):
    """Blank integers become 0, fields are trimmed, trailing empty fields are dropped
    (so a short row fails by index), dates are strict."""
    from ladle.sources.text import Field, parse_delimited

    fields = [Field("date", "date", 0), Field("key", "string", 1), Field("a", "int_blank_zero", 2),
              Field("b", "int_blank_zero", 3), Field("z", "zero")]
    lines = spark.createDataFrame([(0, "2020-01-01, k1 , ,7"), (1, "2020-01-01,k2,3,"), (2, "2020-1-01,k3,1,2"),
                                   (3, "2020-01-01,k4,x,2")], "id int, value string")
    out = parse_delimited(lines, fields, mode="report", keep=["id"]).orderBy("id").collect()
    assert tuple(out[0])[:6] == (0, __import__("datetime").date(2020, 1, 1), "k1", 0, 7, 0) and out[0]._errors == []
    assert out[1].b is None and out[1]._errors == ["Index 3 out of bounds for length 3"]
    assert out[2].date is None and "could not be parsed" in out[2]._errors[0]
    assert out[3].a is None and out[3]._errors == ['For input string: "x"']


def test_raw_parse_quotes_defaults_and_field_count(spark):
    from ladle.sinks.table import parse_raw

    spec = TableSpec.of("t", [("id", "Int32"), ("name", "String"), ("status", "Nullable(Int32)", "99"),
                              ("note", "String", "'omg'")])
    csv = spark.createDataFrame([('1,"Smith, John",,x',), ("2,b,5,",), ("3,c,7",), ("4,d,1,n,extra",)], "value string")
    out = {r.id: r for r in parse_raw(csv, spec, "csv").collect() if r.id is not None}
    assert out[1].name == "Smith, John" and out[1].status == 99 and out[1]._errors == []
    assert out[2].status == 5 and out[2].note == "omg"  # empty field -> DEFAULT
    bad = parse_raw(csv, spec, "csv").where("size(_errors) > 0").count()
    assert bad == 2  # a short row and a long row are corrupt
    js = spark.createDataFrame([('{"id": 5, "name": "e"}',), ('{"id": 6, "name": "f", "status": null}',)],
                               "value string")
    jo = {r.id: r for r in parse_raw(js, spec, "json").collect()}
    assert jo[5].status == 99 and jo[5].note == "omg" and jo[5]._errors == []
    assert jo[6].status is None  # an explicit null stays NULL even with a DEFAULT


def test_gzip_text_stream_to_typed_table(spark, tmp):
    """gzip CSV files -> text stream -> parsed records -> typed load per micro-batch."""
    from ladle.sources.text import Field, parse_delimited, scan_text_lines
    from ladle.streaming.stream import StreamLoadReport, read_loaded, stream_load

    src = os.path.join(tmp, "lines")
    o = spark.read.parquet(os.path.join("/root/testdata/sf0.001", "orders.parquet"))
    lines = o.select(F.concat_ws(",", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus"),
                                 F.col("o_custkey").cast("string")).alias("value"))
    lines.repartition(3).write.option("compression", "gzip").text(src)
    fields = [Field("date", "date", 0), Field("location_key", "string", 1), Field("new_confirmed", "int_blank_zero", 2)]
    parsed = parse_delimited(scan_text_lines(spark, src, stream=True, max_files_per_trigger=1), fields)
    rep = StreamLoadReport()
    out = os.path.join(tmp, "covid")
    stream_load(parsed, [of("date", "date", "Date"), of("location_key", "location_key", "LowCardinality(String)"),
                         of("new_confirmed", "new_confirmed", "Int32")], out, os.path.join(tmp, "ckpt"), report=rep)
    assert len(rep.batches) == 3 and rep.totals()["records_sent"] == o.count()
    got = read_loaded(spark, out).drop("_batch_id")
    exp = o.select(F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderstatus").alias("location_key"),
                   F.col("o_custkey").cast("int").alias("new_confirmed"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_strict_raw_load_stops_on_a_bad_line(spark, tmp):
    import pytest

    spec = TableSpec.of("t", [("id", "Int32"), ("name", "String")])
    lines = spark.createDataFrame([("1,a",), ("x,b",), ("3,c",)], "value string")
    with pytest.raises(Exception, match="Cannot convert value of column id"):
        load_raw(lines, spec, os.path.join(tmp, "t"), "csv")
    with pytest.raises(Exception, match="Expected 2 fields"):
        load_raw(spark.createDataFrame([("1,a,zzz",)], "value string"), spec, os.path.join(tmp, "u"), "csv")


def test_null_raw_records_are_corrupt(spark, tmp):
    spec = TableSpec.of("t", [("id", "Int32"), ("name", "String")])
    lines = spark.createDataFrame([("1,a",), (None,), ("3,c",)], "value string")
    res = load_raw(lines, spec, os.path.join(tmp, "t"), "csv",
                   LoadOptions(max_batch_size=1, failure="drop_batch", shards=1))
    assert res.metrics["records_sent"] == 2 and res.metrics["dropped_records"] == 1


def test_streaming_fold_recovers_state_after_a_crash(spark, tmp):
    import pytest

    from ladle.operators.batching import annotate_batches, batch_summary
    from ladle.streaming.batching_stream import stream_annotate_batches

    rows = [(i, i * 1000, (i * 37) % 50 + 1) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, t long, sz long").withColumn(
        "ts", F.timestamp_seconds(F.col("t")).cast("timestamp_ntz"))
    src = os.path.join(tmp, "in")
    for i in range(4):  # time-ordered files, written one after another
        df.where((F.col("k") >= i * 100) & (F.col("k") < (i + 1) * 100)).coalesce(1).write.parquet(f"{src}/part={i}")
    schema = spark.read.parquet(f"{src}/part=0").schema
    shard = F.pmod(F.col("k"), F.lit(3))
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")

    def start(crash_at=None):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/part=*")
        ann = stream_annotate_batches(stream, shard, ["ts", "k"], F.col("sz"), 7, 120, F.col("ts"), 30_000)

        def write(bdf, bid):
            bdf.write.mode("overwrite").parquet(f"{out}/_batch_id={bid}")
            if bid == crash_at:
                raise RuntimeError("crash")

        ann.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True) \
            .start().awaitTermination()

    with pytest.raises(Exception):
        start(crash_at=2)
    start()
    got = sorted(tuple(r) for r in batch_summary(spark.read.parquet(out).drop("_batch_id")).collect())
    exp = sorted(tuple(r) for r in batch_summary(annotate_batches(
        df, shard, ["ts", "k"], size=F.col("sz"), max_rows=7, max_bytes=120, ts=F.col("ts"),
        max_time_ms=30_000)).collect())
    assert got == exp


def test_csv_lines_against_python_csv(spark):
    """Quote-aware field splitting and counting vs Python's csv module."""
    import csv
    import io
    import random

    from ladle.sinks.table import parse_raw

    rng = random.Random(13)
    alphabet = ["a", "b", " ", ",", '"', "x", "1"]
    spec = TableSpec.of("t", [("c0", "String"), ("c1", "String"), ("c2", "String")])
    lines, expected = [], []
    for _ in range(600):
        n = rng.choice([3, 3, 3, 2, 4])
        fields = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 5))) for _ in range(n)]
        buf = io.StringIO()
        csv.writer(buf, quoting=csv.QUOTE_MINIMAL, lineterminator="").writerow(fields)
        lines.append(buf.getvalue())
        parsed = next(csv.reader([buf.getvalue()]))
        expected.append(tuple(parsed) if len(parsed) == 3 else None)
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    out = {r.i: r for r in parse_raw(df, spec, "csv", keep=["i"]).collect()}
    for i, exp in enumerate(expected):
        r = out[i]
        if exp is None:
            assert r._errors == ["Expected 3 fields"], (lines[i], r)
        else:
            assert (r.c0, r.c1, r.c2) == exp and r._errors == [], (lines[i], r, exp)


def test_json_lines_against_python_json(spark):
    import json
    import random

    from ladle.sinks.table import parse_raw

    rng = random.Random(17)
    spec = TableSpec.of("t", [("a", "Int32"), ("b", "String"), ("c", "Nullable(Int32)", "5")])
    lines, expected = [], []
    for _ in range(500):
        obj = {}
        for k in ("a", "b", "c", "extra"):
            roll = rng.random()
            if roll < 0.2:
                continue  # absent
            if roll < 0.3:
                obj[k] = None
            elif k == "b":
                obj[k] = rng.choice(["x", "y, z", 'q"uote', ""])
            elif k == "extra":
                obj[k] = {"nested": [1, 2]}
            else:
                obj[k] = rng.randint(-1000, 1000)
        text = json.dumps(obj)
        broken = rng.random() < 0.05
        if broken:
            text = text[:-1]  # drop the closing brace
        lines.append(text)
        if broken:
            expected.append("corrupt")
            continue
        a = obj.get("a")
        b = obj.get("b")
        c = obj["c"] if "c" in obj else 5
        errs = [] if a is not None else ["Null value for non-nullable column: a"]
        errs += [] if b is not None else ["Null value for non-nullable column: b"]
        expected.append((a, b, c, errs))
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    out = {r.i: r for r in parse_raw(df, spec, "json", keep=["i"]).collect()}
    for i, exp in enumerate(expected):
        r = out[i]
        if exp == "corrupt":
            assert r._errors == ["Cannot parse JSON object"], (lines[i], r)
        else:
            a, b, c, errs = exp
            assert r._errors == errs, (lines[i], r)
            assert (r.a, r.b, r.c) == (a, b, c), (lines[i], r)


def test_delimited_records_against_a_python_model(spark):
    """parse_delimited vs a Python model: split dropping trailing empty fields,
    trim, blank int -> 0, strict yyyy-MM-dd."""
    import random
    import re

    from ladle.sources.text import Field, parse_delimited

    rng = random.Random(23)
    fields = [Field("d", "date", 0), Field("k", "string", 1), Field("x", "int_blank_zero", 2),
              Field("y", "int_blank_zero", 3), Field("z", "zero")]

    def java_split(line):
        parts = line.split(",")
        while parts and parts[-1] == "":
            parts.pop()
        return parts or [""]

    def model(line):
        p = java_split(line)
        out, errs = {}, []
        for f in fields:
            if f.kind == "zero":
                out[f.name] = 0
                continue
            if len(p) <= f.index:
                out[f.name] = None
                errs.append("missing")
                continue
            raw = p[f.index].strip()
            if f.kind == "date":
                ok = re.fullmatch(r"\d{4}-\d{2}-\d{2}", raw) is not None
                try:
                    val = dt.date.fromisoformat(raw) if ok else None
                except ValueError:
                    val = None
                out[f.name] = val
                errs += [] if val is not None else ["date"]
            elif f.kind == "string":
                out[f.name] = raw
            else:
                if raw == "":
                    out[f.name] = 0
                elif re.fullmatch(r"[+-]?\d{1,9}", raw):
                    out[f.name] = int(raw)
                else:
                    out[f.name] = None
                    errs.append("int")
        return out, len(errs)

    pieces = ["2020-01-01", "2021-13-01", "2020-1-1", " 2022-02-28 ", "k1", " k 2 ", "", " ", "7", "-3", "+4", "x"]
    lines = [",".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    out = {r.i: r for r in parse_delimited(df, fields, mode="report", keep=["i"]).collect()}
    for i, line in enumerate(lines):
        exp, n_err = model(line)
        r = out[i]
        assert len(r._errors) == n_err, (line, r)
        assert all(getattr(r, k) == v for k, v in exp.items()), (line, r, exp)


def test_payload_sizes_against_a_python_model(spark):
    import random

    rng = random.Random(31)

    def vlen(n):
        k = 1
        while n >= 128:
            n >>= 7
            k += 1
        return k

    def sbytes(s):
        b = len(s.encode())
        return vlen(b) + b

    cols = [("i8", "Int8"), ("u64", "UInt64"), ("d", "Decimal(20, 2)"), ("s", "String"), ("ns", "Nullable(String)"),
            ("fs", "FixedString(3)"), ("dt", "Date32"), ("ts", "DateTime64(6)"), ("arr", "Array(String)"),
            ("m", "Map(String, Int32)"), ("t", "Tuple(Int64, String)"), ("nu", "Nullable(UInt16)")]
    rows, expected = [], []
    for _ in range(300):
        s = "é" * rng.randint(0, 200)
        ns = None if rng.random() < 0.3 else "x" * rng.randint(0, 300)
        arr = ["ab" * rng.randint(0, 70) for _ in range(rng.randint(0, 4))]
        m = {f"k{j}": j for j in range(rng.randint(0, 3))}
        t = (rng.randint(0, 9), "z" * rng.randint(0, 5))
        nu = None if rng.random() < 0.5 else 7
        rows.append((s, ns, arr, m, t, nu))
        expected.append(1 + 8 + 16 + sbytes(s) + (1 if ns is None else 1 + sbytes(ns)) + 3 + 4 + 8
                        + vlen(len(arr)) + sum(sbytes(a) for a in arr)
                        + vlen(len(m)) + sum(sbytes(k) + 4 for k in m)
                        + 8 + sbytes(t[1]) + (1 if nu is None else 1 + 2))
    from ladle.functions.sizes import row_payload_bytes

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, s string, ns string, arr array<string>, m map<string,int>, "
                               "t struct<_1:bigint,_2:string>, nu int")
    df = df.select("i", F.lit(1).cast("tinyint").alias("i8"), F.lit(5).cast("decimal(20,0)").alias("u64"),
                   F.lit(1.5).cast("decimal(20,2)").alias("d"), "s", "ns", F.lit("abc").alias("fs"),
                   F.current_date().alias("dt"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), "arr", "m", "t",
                   "nu")
    got = {r.i: r.n for r in df.select("i", row_payload_bytes(cols).alias("n")).collect()}
    assert all(got[i] == e for i, e in enumerate(expected))


def test_load_json_as_variant(spark, tmp):
    df = spark.createDataFrame([(1, '{"bar": "foo"}'), (2, '{"bar": "baz"}')], "id long, j string")
    out = os.path.join(tmp, "v")
    from ladle.sinks.table import load

    load(df, [of("id", "id", "Int64"), of("j", "j", "JSON")], out, LoadOptions(json_as="variant"), order=["id"])
    back = read_table(spark, out)
    assert back.schema["j"].dataType.typeName() == "variant"
    assert sorted(r.bar for r in back.select(F.variant_get("j", "$.bar", "string").alias("bar")).collect()) == \
        ["baz", "foo"]
