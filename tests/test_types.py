import pytest
from pyspark.sql import types as T

from ladle.functions.types import UnsupportedTypeError, parse_type


@pytest.mark.parametrize("decl,spark_type", [
    ("Int8", T.ByteType()), ("UInt8", T.ShortType()), ("UInt16", T.IntegerType()), ("UInt32", T.LongType()),
    ("UInt64", T.DecimalType(20, 0)), ("Int128", T.StringType()), ("Float32", T.FloatType()),
    ("Decimal(10, 5)", T.DecimalType(10, 5)), ("Decimal64(18)", T.DecimalType(18, 18)),
    ("Decimal256(76)", T.StringType()), ("FixedString(10)", T.StringType()), ("Date32", T.DateType()),
    ("DateTime", T.TimestampNTZType()), ("DateTime64(6, 'UTC')", T.TimestampNTZType()),
    ("DateTime64(9)", T.LongType()), ("Array(String)", T.ArrayType(T.StringType())),
    ("Map(String, UInt64)", T.MapType(T.StringType(), T.DecimalType(20, 0))),
])
def test_spark_types(decl, spark_type):
    assert parse_type(decl).spark_type() == spark_type


def test_wrappers():
    t = parse_type("SimpleAggregateFunction(anyLast, LowCardinality(Nullable(String)))")
    assert t.name == "String" and t.nullable and t.low_cardinality and t.agg == "anyLast"
    tup = parse_type("Tuple(String, Int64, Bool)")
    assert [f.name for f in tup.spark_type().fields] == ["_1", "_2", "_3"]
    assert parse_type("Nullable(Decimal(38, 4))").ddl() == "Nullable(Decimal(38, 4))"
    for decl in ("DateTime('UTC')", "DateTime64(3, 'UTC')", "LowCardinality(Nullable(String))", "FixedString(4)",
                 "Map(String, UInt64)", "Tuple(Int32, String)", "SimpleAggregateFunction(sum, Decimal(38, 4))"):
        assert parse_type(decl).ddl() == decl


@pytest.mark.parametrize("decl", ["Enum8('a' = 1)", "Time", "Variant(String)", "IPv4"])
def test_unsupported(decl):
    with pytest.raises(UnsupportedTypeError):
        parse_type(decl).spark_type()


@pytest.mark.parametrize("decl", ["Array()", "Map(String)", "Decimal(x, 2)", "Tuple(", "DateTime64(12)", ""])
def test_malformed_declarations(decl):
    with pytest.raises(UnsupportedTypeError):
        parse_type(decl).spark_type()
