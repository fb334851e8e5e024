"""Target column types: names, Spark storage types and value bounds.

A target type is written the way the target table declares it, e.g.
``Int64``, ``Nullable(Decimal(10, 2))``, ``DateTime64(6, 'UTC')``,
``Array(String)``, ``Map(String, UInt64)``, ``Tuple(String, Int64, Bool)``,
``LowCardinality(String)`` or ``SimpleAggregateFunction(max, Int64)``.
The declaration is parsed once on the driver; nothing here runs per row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T


class UnsupportedTypeError(ValueError):
    """Raised at binding time for a type the writer cannot encode."""


# Bounds of the target types (inclusive).
INT_BOUNDS = {
    "Int8": (-(2**7), 2**7 - 1),
    "Int16": (-(2**15), 2**15 - 1),
    "Int32": (-(2**31), 2**31 - 1),
    "Int64": (-(2**63), 2**63 - 1),
    "Int128": (-(2**127), 2**127 - 1),
    "Int256": (-(2**255), 2**255 - 1),
    "UInt8": (0, 2**8 - 1),
    "UInt16": (0, 2**16 - 1),
    "UInt32": (0, 2**32 - 1),
    "UInt64": (0, 2**64 - 1),
    "UInt128": (0, 2**128 - 1),
    "UInt256": (0, 2**256 - 1),
}
DATE_BOUNDS = {
    "Date": ("1970-01-01", "2149-06-06"),
    "Date32": ("1900-01-01", "2299-12-31"),
}
DATETIME_BOUNDS = {
    "DateTime": ("1970-01-01 00:00:00", "2106-02-07 06:28:15"),
    "DateTime64": ("1900-01-01 00:00:00", "2299-12-31 23:59:59.999999"),
}
# Byte widths of the row binary encoding (used for payload sizes).
FIXED_WIDTH = {
    "Int8": 1, "Int16": 2, "Int32": 4, "Int64": 8, "Int128": 16, "Int256": 32,
    "UInt8": 1, "UInt16": 2, "UInt32": 4, "UInt64": 8, "UInt128": 16, "UInt256": 32,
    "Float32": 4, "Float64": 8, "Bool": 1, "UUID": 16,
    "Date": 2, "Date32": 4, "DateTime": 4, "DateTime64": 8,
}
# Declared decimal families, name -> (max precision, storage width in bytes).
DECIMAL_FAMILIES = {"Decimal32": (9, 4), "Decimal64": (18, 8), "Decimal128": (38, 16), "Decimal256": (76, 32)}
# Types the target documents but the writer cannot encode.
UNSUPPORTED = {"Enum8", "Enum16", "Time", "Time64", "Variant", "Dynamic", "Nothing", "IntervalSecond",
               "IntervalDay", "IPv4", "IPv6", "Object", "Nested", "Point", "Ring", "Polygon"}
SIMPLE_NAMES = set(INT_BOUNDS) | {"Float32", "Float64", "Bool", "String", "JSON", "UUID", "Date", "Date32", "DateTime"}

WIDE_INTS = {"Int128", "Int256", "UInt128", "UInt256"}
SMALL_UNSIGNED = {"UInt8", "UInt16", "UInt32"}


@dataclass(frozen=True)
class TargetType:
    name: str
    nullable: bool = False
    low_cardinality: bool = False
    precision: int | None = None
    scale: int | None = None
    size: int | None = None
    tz: str | None = None
    args: tuple["TargetType", ...] = field(default_factory=tuple)
    agg: str | None = None

    # -- families -------------------------------------------------------
    @property
    def is_decimal(self) -> bool:
        return self.name == "Decimal"

    @property
    def is_wide_decimal(self) -> bool:
        return self.is_decimal and (self.precision or 0) > 38

    @property
    def is_composite(self) -> bool:
        return self.name in ("Array", "Map", "Tuple")

    def inner(self) -> "TargetType":
        """The same type without Nullable/LowCardinality/aggregate wrappers."""
        return TargetType(self.name, False, False, self.precision, self.scale, self.size, self.tz, self.args, None)

    def spark_type(self) -> T.DataType:
        n = self.name
        if n == "Int8":
            return T.ByteType()
        if n in ("Int16", "UInt8"):
            return T.ShortType()
        if n in ("Int32", "UInt16"):
            return T.IntegerType()
        if n in ("Int64", "UInt32"):
            return T.LongType()
        if n == "UInt64":
            return T.DecimalType(20, 0)
        if n in WIDE_INTS:
            return T.StringType()
        if n == "Float32":
            return T.FloatType()
        if n == "Float64":
            return T.DoubleType()
        if n == "Bool":
            return T.BooleanType()
        if n == "Decimal":
            return T.StringType() if self.is_wide_decimal else T.DecimalType(self.precision, self.scale)
        if n in ("String", "FixedString", "JSON", "UUID"):
            return T.StringType()
        if n in ("Date", "Date32"):
            return T.DateType()
        if n == "DateTime":
            return T.TimestampNTZType()
        if n == "DateTime64":
            return T.TimestampNTZType() if (self.scale or 0) <= 6 else T.LongType()
        if n == "Array":
            return T.ArrayType(self.args[0].spark_type(), True)
        if n == "Map":
            return T.MapType(self.args[0].spark_type(), self.args[1].spark_type(), True)
        if n == "Tuple":
            return T.StructType([T.StructField(f"_{i + 1}", a.spark_type(), a.nullable) for i, a in enumerate(self.args)])
        raise UnsupportedTypeError(f"Unsupported target type: {n}")

    def ddl(self) -> str:
        """Declaration text, canonical form."""
        n = self.name
        if n == "Decimal":
            s = f"Decimal({self.precision}, {self.scale})"
        elif n == "FixedString":
            s = f"FixedString({self.size})"
        elif n == "DateTime64":
            s = f"DateTime64({self.scale}" + (f", '{self.tz}')" if self.tz else ")")
        elif n == "DateTime" and self.tz:
            s = f"DateTime('{self.tz}')"
        elif n in ("Array", "Map", "Tuple"):
            s = f"{n}(" + ", ".join(a.ddl() for a in self.args) + ")"
        else:
            s = n
        if self.nullable:
            s = f"Nullable({s})"
        if self.low_cardinality:
            s = f"LowCardinality({s})"
        if self.agg:
            s = f"SimpleAggregateFunction({self.agg}, {s})"
        return s


def _split_args(s: str) -> list[str]:
    out, depth, cur, quote = [], 0, [], False
    for ch in s:
        if ch == "'":
            quote = not quote
        if not quote and ch == "(":
            depth += 1
        elif not quote and ch == ")":
            depth -= 1
        if ch == "," and depth == 0 and not quote:
            out.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


_CALL = re.compile(r"^\s*([A-Za-z_][A-Za-z0-9_]*)\s*(?:\((.*)\))?\s*$", re.S)


# Other names that table declarations use for these types.
ALIASES = {"Float": "Float32", "FLOAT": "Float32", "Double": "Float64", "DOUBLE": "Float64"}


def parse_type(decl: str | TargetType) -> TargetType:
    """Parse a target type declaration (driver side, once per binding)."""
    if isinstance(decl, TargetType):
        return decl
    try:
        return _parse(decl)
    except UnsupportedTypeError:
        raise
    except (IndexError, ValueError) as e:
        raise UnsupportedTypeError(f"Cannot parse type: {decl!r}") from e


def _parse(decl: str) -> TargetType:
    m = _CALL.match(decl)
    if not m:
        raise UnsupportedTypeError(f"Cannot parse type: {decl!r}")
    name, inner = ALIASES.get(m.group(1), m.group(1)), m.group(2)
    args = _split_args(inner) if inner is not None else []
    if name == "Nullable":
        t = parse_type(args[0])
        return TargetType(t.name, True, t.low_cardinality, t.precision, t.scale, t.size, t.tz, t.args, t.agg)
    if name == "LowCardinality":
        t = parse_type(args[0])
        return TargetType(t.name, t.nullable, True, t.precision, t.scale, t.size, t.tz, t.args, t.agg)
    if name == "SimpleAggregateFunction":
        t = parse_type(args[1])
        return TargetType(t.name, t.nullable, t.low_cardinality, t.precision, t.scale, t.size, t.tz, t.args, args[0])
    if name == "Decimal":
        p, s = int(args[0]), int(args[1]) if len(args) > 1 else 0
        if not 1 <= p <= 76 or not 0 <= s <= p:
            raise UnsupportedTypeError(f"Bad decimal: {decl}")
        return TargetType("Decimal", precision=p, scale=s)
    if name in DECIMAL_FAMILIES:
        p = DECIMAL_FAMILIES[name][0]
        return TargetType("Decimal", precision=p, scale=int(args[0]))
    if name == "FixedString":
        return TargetType("FixedString", size=int(args[0]))
    if name == "DateTime64":
        tz = args[1].strip().strip("'") if len(args) > 1 else None
        s = int(args[0]) if args else 3
        if not 0 <= s <= 9:
            raise UnsupportedTypeError(f"DateTime64 scale must be 0..9: {decl}")
        return TargetType("DateTime64", scale=s, tz=tz)
    if name == "DateTime" and args:
        return TargetType("DateTime", tz=args[0].strip().strip("'"))
    if name == "Array":
        return TargetType("Array", args=(parse_type(args[0]),))
    if name == "Map":
        return TargetType("Map", args=(parse_type(args[0]), parse_type(args[1])))
    if name == "Tuple":
        return TargetType("Tuple", args=tuple(parse_type(a) for a in args))
    if name == "Boolean":
        name = "Bool"
    if name in SIMPLE_NAMES:
        return TargetType(name)
    raise UnsupportedTypeError(f"Unsupported target type: {name}")


def schema_of(bindings) -> T.StructType:
    """StructType declared by a list of bindings (never inferred)."""
    return T.StructType([T.StructField(b.name, b.type.spark_type(), b.type.nullable) for b in bindings])
