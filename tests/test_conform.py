"""Checked casts: boundary rows, out-of-range values, null rules, wide types."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.conform import coerce_to_integer, conform, json_valid
from ladle.operators.bindings import bind_columns, of

# (target type, Spark input type, min value, max value, expected min, expected max)
BOUNDS = [
    ("Int8", T.ByteType(), -128, 127, -128, 127),
    ("Int16", T.ShortType(), -32768, 32767, -32768, 32767),
    ("Int32", T.IntegerType(), -(2**31), 2**31 - 1, -(2**31), 2**31 - 1),
    ("Int64", T.LongType(), -(2**63), 2**63 - 1, -(2**63), 2**63 - 1),
    ("Int128", T.StringType(), str(-(2**127)), str(2**127 - 1), str(-(2**127)), str(2**127 - 1)),
    ("Int256", T.StringType(), str(-(2**255)), str(2**255 - 1), str(-(2**255)), str(2**255 - 1)),
    ("UInt8", T.IntegerType(), 0, 255, 0, 255),
    ("UInt16", T.IntegerType(), 0, 65535, 0, 65535),
    ("UInt32", T.LongType(), 0, 2**32 - 1, 0, 2**32 - 1),
    ("UInt64", T.DecimalType(20, 0), Decimal(0), Decimal(2**64 - 1), Decimal(0), Decimal(2**64 - 1)),
    ("UInt128", T.StringType(), "0", str(2**128 - 1), "0", str(2**128 - 1)),
    ("UInt256", T.StringType(), "0", str(2**256 - 1), "0", str(2**256 - 1)),
    ("Float64", T.DoubleType(), -1.7976931348623157e308, 1.7976931348623157e308,
     -1.7976931348623157e308, 1.7976931348623157e308),
    ("Decimal(10, 5)", T.StringType(), "-99999.99999", "99999.99999", Decimal("-99999.99999"), Decimal("99999.99999")),
    ("Decimal(76, 0)", T.StringType(), "-" + "9" * 76, "9" * 76, "-" + "9" * 76, "9" * 76),
    ("Date", T.StringType(), "1970-01-01", "2149-06-06", dt.date(1970, 1, 1), dt.date(2149, 6, 6)),
    ("Date32", T.StringType(), "1900-01-01", "2299-12-31", dt.date(1900, 1, 1), dt.date(2299, 12, 31)),
    ("DateTime", T.StringType(), "1970-01-01 00:00:00", "2106-02-07 06:28:15",
     dt.datetime(1970, 1, 1), dt.datetime(2106, 2, 7, 6, 28, 15)),
    ("DateTime64(6)", T.StringType(), "1900-01-01 00:00:00", "2299-12-31 23:59:59.999999",
     dt.datetime(1900, 1, 1), dt.datetime(2299, 12, 31, 23, 59, 59, 999999)),
]


def _one(spark, value, src_type, decl, name="c"):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", src_type, True)]))
    r = conform(F.col("x"), src_type, decl, name)
    return df.select(r.value.alias("v"), r.error.alias("e")).first()


@pytest.mark.parametrize("decl,src,lo,hi,elo,ehi", BOUNDS, ids=[b[0] for b in BOUNDS])
def test_min_max_survive(spark, decl, src, lo, hi, elo, ehi):
    df = spark.createDataFrame([(lo,), (hi,)], T.StructType([T.StructField("x", src, True)]))
    out = bind_columns(df, [of("x", "v", decl)]).collect()
    assert [r.v for r in out] == [elo, ehi]


@pytest.mark.parametrize("decl,src,value", [
    ("Int8", T.IntegerType(), 128), ("Int8", T.IntegerType(), -129), ("UInt8", T.IntegerType(), 256),
    ("UInt8", T.IntegerType(), -1), ("UInt16", T.IntegerType(), 65536), ("UInt32", T.LongType(), 2**32),
    ("UInt64", T.StringType(), str(2**64)), ("Int128", T.StringType(), str(2**127)),
    ("Int128", T.StringType(), str(-(2**127) - 1)), ("UInt256", T.StringType(), str(2**256)),
    ("UInt128", T.StringType(), "-1"), ("Int256", T.StringType(), "12a"),
    ("Decimal(10, 5)", T.StringType(), "100000"), ("Decimal(76, 2)", T.StringType(), "1" * 75),
    ("Float32", T.DoubleType(), 1e39), ("Date", T.StringType(), "1969-12-31"),
    ("Date", T.StringType(), "2149-06-07"), ("DateTime", T.StringType(), "2106-02-07 06:28:16"),
    ("FixedString(3)", T.StringType(), "abcd"), ("UUID", T.StringType(), "not-a-uuid"),
    ("JSON", T.StringType(), '{"a": 1}}'), ("Bool", T.IntegerType(), 2), ("Int32", T.DoubleType(), 1.5),
])
def test_out_of_range_is_an_error(spark, decl, src, value):
    row = _one(spark, value, src, decl)
    assert row.v is None and row.e is not None and "Cannot convert" in row.e


def test_strict_mode_raises(spark):
    df = spark.createDataFrame([(300,)], "x int")
    with pytest.raises(Exception, match="Cannot convert value of column small"):
        bind_columns(df, [of("x", "small", "Int8")]).collect()


def test_null_rules(spark):
    df = spark.createDataFrame([(None,)], "x int")
    # 1. null into non-nullable -> error naming the column
    with pytest.raises(Exception, match="Null value for non-nullable column: id"):
        bind_columns(df, [of("x", "id", "Int32")]).collect()
    # 2. nullable stays null
    assert bind_columns(df, [of("x", "v", "Nullable(Int32)")]).first().v is None
    # 5. UInt8/16/32 null -> 0, also when nullable
    r = bind_columns(df, [of("x", "a", "UInt8"), of("x", "b", "Nullable(UInt16)"), of("x", "c", "UInt32")]).first()
    assert (r.a, r.b, r.c) == (0, 0, 0)
    # option: keep NULL
    assert bind_columns(df, [of("x", "b", "Nullable(UInt16)")], null_unsigned="null").first().b is None
    # 6. UInt64 null: error when non-nullable, NULL when nullable
    with pytest.raises(Exception, match="Null value"):
        bind_columns(df, [of("x", "u", "UInt64")]).collect()
    assert bind_columns(df, [of("x", "u", "Nullable(UInt64)")]).first().u is None
    # 4. a bound key missing from the record reads as NULL
    assert bind_columns(df, [of("missing", "m", "Nullable(String)")]).first().m is None


def test_report_mode_lists_errors(spark):
    df = spark.createDataFrame([(0, 1, None), (1, 300, "x")], "id int, a int, b string")
    out = bind_columns(df, [of("a", "a", "Int8"), of("b", "b", "String")], mode="report",
                       keep=["id"]).orderBy("id").collect()
    assert out[0]._errors == ["Null value for non-nullable column: b"]
    assert out[1].a is None and out[1]._errors == ["Cannot convert value of column a to Int8"]


def test_datetime64_scales(spark):
    s = "2024-03-10T08:45:12.121234556Z"
    assert _one(spark, s, T.StringType(), "DateTime64(9)").v == 1710060312121234556
    assert _one(spark, s, T.StringType(), "DateTime64(3)").v == dt.datetime(2024, 3, 10, 8, 45, 12, 121000)
    assert _one(spark, s, T.StringType(), "DateTime").v == dt.datetime(2024, 3, 10, 8, 45, 12)
    assert _one(spark, "2024-02-20T14:15:30.301123321Z", T.StringType(), "DateTime64(6)").v == \
        dt.datetime(2024, 2, 20, 14, 15, 30, 301123)


def test_composites(spark):
    df = spark.createDataFrame([(["1", "2"], {"a": 1}, ("x", 5, True))],
                               "arr array<string>, m map<string,int>, t struct<a:string,b:int,c:boolean>")
    out = bind_columns(df, [of("arr", "arr", "Array(Int64)"), of("m", "m", "Map(String, UInt64)"),
                            of("t", "t", "Tuple(String, Int64, Bool)")]).first()
    assert out.arr == [1, 2] and out.m == {"a": Decimal(1)} and tuple(out.t) == ("x", 5, True)
    bad = spark.createDataFrame([(["1", "x"],)], "arr array<string>")
    with pytest.raises(Exception, match="Cannot convert"):
        bind_columns(bad, [of("arr", "arr", "Array(Int64)")]).collect()


def test_json_valid(spark):
    cases = ['{"a": 1}', '[1, 2]', '"s"', '1', 'null', '{"a": [1, {"b": null}]}',
             '{"a": 1}}', '1, 2', '1] [2', '{', '', '  ', '1,0] x [', '[1] [2]']
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r.ok for r in df.select(json_valid(F.col("s")).alias("ok")).collect()]
    assert got == [True] * 6 + [False] * 8


def test_coerce_to_integer(spark):
    df = spark.createDataFrame([("12", 3.9, True, 2**32 + 5), ("x", -1e20, False, -1)], "s string, d double, b boolean, l long")
    rows = df.select(*[coerce_to_integer(F.col(c), df.schema[c].dataType, c).value.alias(c) for c in "sdbl"]).collect()
    assert tuple(rows[0]) == (12, 3, 1, 5)
    assert tuple(rows[1]) == (None, -(2**31), 0, -1)


def test_datetime_text_with_zones_and_numbers(spark):
    assert _one(spark, "2024-01-01T10:00:00+02:00", T.StringType(), "DateTime").v == dt.datetime(2024, 1, 1, 8, 0)
    assert _one(spark, "2024-01-01T10:00:00.5Z", T.StringType(), "DateTime64(3)").v == \
        dt.datetime(2024, 1, 1, 10, 0, 0, 500000)
    r = _one(spark, 1700000000, T.LongType(), "DateTime")
    assert r.v is None and "Cannot convert" in r.e
    assert _one(spark, 5, T.IntegerType(), "Date").v is None


def test_wide_integers_against_python_ints(spark):
    """Digit-string bound checks for 128/256-bit types vs exact Python integers."""
    import random

    from ladle.functions.types import INT_BOUNDS

    rng = random.Random(7)
    vals = []
    for _ in range(2000):
        bits = rng.choice([8, 63, 64, 100, 127, 128, 129, 200, 255, 256, 257])
        v = rng.getrandbits(bits) * rng.choice([1, -1])
        text = str(v)
        if rng.random() < 0.2:  # leading zeros and explicit plus signs are still integers
            text = ("-" if v < 0 else rng.choice(["", "+"])) + "000" + str(abs(v))
        if rng.random() < 0.05:
            text = text + "x"
        vals.append(text)
    for t in ("Int128", "Int256", "UInt128", "UInt256"):
        lo, hi = INT_BOUNDS[t]
        vals += [str(lo), str(hi), str(lo - 1), str(hi + 1)]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ("Int128", "Int256", "UInt128", "UInt256"):
        lo, hi = INT_BOUNDS[t]
        r = conform(F.col("s"), T.StringType(), t, "c")
        got = df.select("s", r.value.alias("v"), r.error.isNull().alias("ok")).collect()
        for row in got:
            try:
                iv = int(row.s)
            except ValueError:
                iv = None
            exp_ok = iv is not None and lo <= iv <= hi
            assert row.ok == exp_ok, (t, row.s)
            if exp_ok:
                assert row.v == str(iv), (t, row.s, row.v)


def test_decimal256_against_python_decimals(spark):
    import random
    from decimal import ROUND_HALF_UP, localcontext
    from decimal import Decimal as D

    rng = random.Random(11)
    vals = []
    for _ in range(1500):
        ip = str(rng.getrandbits(rng.choice([10, 100, 200, 240, 260])))
        fp = "".join(rng.choice("0123456789") for _ in range(rng.choice([0, 1, 3, 5])))
        txt = ("-" if rng.random() < 0.5 else "") + ip + ("." + fp if fp or rng.random() < 0.1 else "")
        vals.append(txt)
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    p, sc = 76, 3
    r = conform(F.col("s"), T.StringType(), f"Decimal({p}, {sc})", "c")
    for row in df.select("s", r.value.alias("v"), r.error.isNull().alias("ok")).collect():
        with localcontext(prec=120):  # digits beyond the scale are rounded half up, as for narrower decimals
            d = D(row.s).quantize(D(1).scaleb(-sc), ROUND_HALF_UP)
        int_digits = len(str(abs(int(d)))) if abs(int(d)) > 0 else 0
        exp_ok = int_digits <= p - sc
        assert row.ok == exp_ok, row.s
        if exp_ok:
            assert D(row.v) == d and len(row.v.split(".")[1]) == sc, (row.s, row.v)


def test_decimal256_carries(spark):
    """Rounding up through nines, to another digit, out of the precision, and to nothing."""
    cases = {"9.9995": "10.000", "-0.9999": "-1.000", "0.0004": "0.000", "-0.0004": "0.000", "1.0005": "1.001", "9" * 72 + ".9995": "1" + "0" * 72 + ".000",
             "9" * 73 + ".9995": None, "9" * 73 + ".9994": "9" * 73 + ".999", ".5": "0.500", "7.": "7.000", "+1.9": "1.900", "": None, ".": None, "1e3": None}
    df = spark.createDataFrame([(v,) for v in cases], "s string")
    r = conform(F.col("s"), T.StringType(), "Decimal(76, 3)", "c")
    assert {x.s: x.v if x.ok else None for x in df.select("s", r.value.alias("v"), r.error.isNull().alias("ok")).collect()} == cases
    r = conform(F.col("s"), T.StringType(), "Decimal(40, 0)", "c")
    assert {x.v for x in spark.createDataFrame([("9.5",), ("9.4",)], "s string").select(r.value.alias("v")).collect()} == {"10", "9"}


def test_narrow_integers_against_python(spark):
    import random

    from ladle.functions.types import INT_BOUNDS

    rng = random.Random(3)
    ints = [rng.choice([1, -1]) * rng.getrandbits(rng.choice([6, 7, 8, 9, 15, 16, 17, 31, 32, 33, 62, 63]))
            for _ in range(1500)]
    ints += [b for t in ("Int8", "Int16", "Int32", "Int64", "UInt8", "UInt16", "UInt32") for b in INT_BOUNDS[t]]
    dbls = [float(i) + rng.choice([0.0, 0.0, 0.5, -0.25]) for i in ints[:800]]
    df_l = spark.createDataFrame([(i,) for i in ints], "x long")
    df_s = spark.createDataFrame([(str(i),) for i in ints], "x string")
    df_d = spark.createDataFrame([(d,) for d in dbls], "x double")
    for t in ("Int8", "Int16", "Int32", "Int64", "UInt8", "UInt16", "UInt32", "UInt64"):
        lo, hi = INT_BOUNDS[t]
        for df, conv in ((df_l, int), (df_s, int), (df_d, float)):
            src = df.schema["x"].dataType
            r = conform(F.col("x"), src, t, "c")
            for row in df.select("x", r.value.alias("v"), r.error.isNull().alias("ok")).collect():
                x = conv(row.x)
                whole = float(x).is_integer() if isinstance(x, float) else True
                exp_ok = whole and lo <= x <= hi
                assert row.ok == exp_ok, (t, row.x)
                if exp_ok:
                    assert int(row.v) == int(x), (t, row.x, row.v)


def test_datetime64_floor_against_python(spark):
    import random

    rng = random.Random(5)
    epoch = dt.datetime(1970, 1, 1)
    lo_us = int((dt.datetime(1900, 1, 1) - epoch).total_seconds() * 1e6)
    hi_us = int((dt.datetime(2299, 12, 31, 23, 59, 59) - epoch).total_seconds() * 1e6)
    micros = [rng.randint(lo_us, hi_us) for _ in range(1500)] + [lo_us, hi_us, -1, 0, 1, -999_999, -1_000_001]
    tss = [epoch + dt.timedelta(microseconds=m) for m in micros]
    df = spark.createDataFrame([(t,) for t in tss], "x timestamp_ntz")
    for scale in range(0, 7):
        r = conform(F.col("x"), T.TimestampNTZType(), f"DateTime64({scale})", "c")
        unit = 10 ** (6 - scale)
        for row, m in zip(df.select(r.value.alias("v")).collect(), micros):
            exp = epoch + dt.timedelta(microseconds=(m // unit) * unit)  # floor, also before 1970
            assert row.v == exp, (scale, m, row.v, exp)


def test_date_bounds_and_float32_range_against_python(spark):
    import random
    import struct

    rng = random.Random(9)
    days = [rng.randint(-40000, 150000) for _ in range(1500)]
    dates = [dt.date(1970, 1, 1) + dt.timedelta(days=d) for d in days if -700000 < d < 2900000]
    df = spark.createDataFrame([(d,) for d in dates], "x date")
    for t, lo, hi in (("Date", dt.date(1970, 1, 1), dt.date(2149, 6, 6)),
                      ("Date32", dt.date(1900, 1, 1), dt.date(2299, 12, 31))):
        r = conform(F.col("x"), T.DateType(), t, "c")
        for row, d in zip(df.select(r.value.alias("v"), r.error.isNull().alias("ok")).collect(), dates):
            assert row.ok == (lo <= d <= hi) and (row.v == d if row.ok else row.v is None), (t, d)
    fmax = struct.unpack("f", struct.pack("I", 0x7F7FFFFF))[0]
    vals = [rng.uniform(-1, 1) * 10 ** rng.randint(0, 40) for _ in range(1000)] + [fmax, -fmax, fmax * 1.0000001]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = conform(F.col("x"), T.DoubleType(), "Float32", "c")
    for row, v in zip(df.select(r.value.alias("v"), r.error.isNull().alias("ok")).collect(), vals):
        assert row.ok == (abs(v) <= fmax), v
        if row.ok:
            assert row.v == struct.unpack("f", struct.pack("f", v))[0], v


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_date_times_do_not_follow_the_session_zone(spark, zone):
    """Instants, zoned and zone-less text, wall clocks and dates give the same values under any session zone."""
    from ladle.operators.bindings import bind_columns, of

    before = spark.conf.get("spark.sql.session.timeZone")
    rows = [("2024-03-10T02:30:00.123456Z", "2024-03-10 02:30:00.123456"), ("2024-03-10 02:30:00.5", "2024-03-10 02:30:00.5"),
            ("2024-11-03T01:30:00+02:00", "2024-11-02 23:30:00"), ("1999-12-31", "1999-12-31 00:00:00"), ("nonsense", None)]
    frame = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, s string").selectExpr(
        "i", "s", "timestamp_micros(1709999999123456 + i) as at", "timestamp_ntz'2024-03-10 02:30:00.654321' as wall")
    bound = [of(s, f"{s}_{n}", t) for s in ("s", "at", "wall") for n, t in (("d", "Date"), ("t", "Nullable(DateTime)"), ("t6", "DateTime64(6)"), ("t4", "DateTime64(4)"), ("t9", "DateTime64(9)"))]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = bind_columns(frame, [of("i", "i", "Int32"), *bound], mode="report").selectExpr(
            "i", *[f"cast({s}_{n} as string) as {s}_{n}" for s in ("s", "at", "wall") for n in ("d", "t", "t6", "t4", "t9")]).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for r, (_, wall) in zip(got, rows):
        assert r.s_t6 == (wall and wall.removesuffix(" 00:00:00") + " 00:00:00" * (r.i == 3)) and r.s_t == (wall and wall[:19]) and r.s_d == (wall[:10] if r.i == 3 else None)  # text of a Date has no time
        assert r.at_t6 == f"2024-03-09 15:59:59.12345{6 + r.i}" if r.i < 4 else True
        assert (r.at_d, r.at_t, r.at_t4) == ("2024-03-09", "2024-03-09 15:59:59", "2024-03-09 15:59:59.1234")
        assert r.at_t9 == str((1709999999123456 + r.i) * 1000)
        assert (r.wall_d, r.wall_t, r.wall_t6, r.wall_t4) == ("2024-03-10", "2024-03-10 02:30:00", "2024-03-10 02:30:00.654321", "2024-03-10 02:30:00.6543")
        assert r.wall_t9 == "1710037800654321000"


def test_strict_json_map_keys_and_type_names(spark):
    from ladle.functions.types import parse_type
    from ladle.operators.bindings import bind_columns, of

    texts = ['{"a": 1}', "{'a': 1}", '{"a": "x\ty"}', '{"a": "x\\ty"}', "null", "1 2", '[1, {"b": null}]', '{"a": 1', ' "s" ', ""]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    got = bind_columns(frame, [of("i", "i", "Int32"), of("j", "j", "JSON")], mode="report").orderBy("i").collect()
    assert [r.j is not None for r in got] == [True, False, False, True, True, False, True, False, True, False]
    maps = spark.createDataFrame([(1, {"1": 2, "01": 3}), (2, {"1": 2, "2": 3})], "i int, m map<string,int>")
    got = bind_columns(maps, [of("i", "i", "Int32"), of("m", "m", "Map(Int32, Int32)")], mode="report").orderBy("i").collect()
    assert got[0].m is None and got[0]["_errors"] and got[1].m == {1: 2, 2: 3}
    assert (parse_type("Float").name, parse_type("Nullable(Double)").name) == ("Float32", "Float64")
