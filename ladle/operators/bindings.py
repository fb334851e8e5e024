"""Bindings: source column -> named, typed target column.

A binding list plays the role of a record mapper: it is declared once, read
once on the driver, and compiled into one ``select`` of checked casts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.conform import apply_mode, conform
from ladle.functions.types import TargetType, parse_type

RESERVED_RAW = "__ladle_raw__"
ERRORS_COL = "_errors"


@dataclass(frozen=True)
class Binding:
    """``src`` (a column name or a Column expression) bound to target ``name`` of ``type``."""

    src: str | Column
    name: str
    type: TargetType

    def source(self) -> Column:
        return F.col(self.src) if isinstance(self.src, str) else self.src


def of(src: str | Column, name: str, decl: str | TargetType) -> Binding:
    return Binding(src, name, parse_type(decl))


def scalar(src, name, decl: str, nullable: bool = False) -> Binding:
    t = parse_type(decl)
    return Binding(src, name, TargetType(t.name, nullable or t.nullable, t.low_cardinality, t.precision, t.scale,
                                         t.size, t.tz, t.args, t.agg))


def decimal(src, name, precision: int, scale: int, nullable: bool = False) -> Binding:
    return scalar(src, name, f"Decimal({precision}, {scale})", nullable)


def fixed_string(src, name, size: int, nullable: bool = False) -> Binding:
    return scalar(src, name, f"FixedString({size})", nullable)


def datetime64(src, name, scale: int, tz: str | None = "UTC", nullable: bool = False) -> Binding:
    return scalar(src, name, f"DateTime64({scale}, '{tz}')" if tz else f"DateTime64({scale})", nullable)


def array(src, name, element: str) -> Binding:
    return of(src, name, f"Array({element})")


def map_(src, name, key: str, value: str) -> Binding:
    return of(src, name, f"Map({key}, {value})")


def tuple_(src, name, *elements: str) -> Binding:
    return of(src, name, f"Tuple({', '.join(elements)})")


def simple_aggregate(src, name, function: str, decl: str) -> Binding:
    return of(src, name, f"SimpleAggregateFunction({function}, {decl})")


def check_bindings(bindings: Sequence[Binding]) -> None:
    """Driver-side checks, once per load: reserved name, duplicates, types."""
    seen = set()
    for b in bindings:
        if b.name == RESERVED_RAW or (isinstance(b.src, str) and b.src == RESERVED_RAW):
            raise ValueError(f"Column key {RESERVED_RAW} is reserved for raw payloads")
        if b.name in seen:
            raise ValueError(f"Duplicate target column {b.name}")
        seen.add(b.name)
        b.type.spark_type()  # raises UnsupportedTypeError for types the writer cannot encode


def _source_type(df: DataFrame, b: Binding) -> T.DataType:
    if isinstance(b.src, str):
        return df.schema[b.src].dataType if b.src in df.columns else df.select(F.col(b.src)).schema[0].dataType
    return df.select(b.src).schema[0].dataType


def bind_columns(df: DataFrame, bindings: Sequence[Binding], mode: str = "strict", null_unsigned: str = "zero",
                 keep: Iterable[str] = (), json_as: str = "string") -> DataFrame:
    """Rename, order and type the columns in one projection.

    ``mode="strict"`` raises on the first bad value; ``mode="report"`` nulls bad
    values and adds an ``_errors`` array column listing each row's problems.
    ``keep`` carries extra source columns (e.g. a key) through unchanged.
    A key bound but absent from the record is treated as NULL.
    ``json_as="variant"`` stores JSON columns as ``VARIANT`` (parsed once)
    instead of the validated text.
    """
    if json_as not in ("string", "variant"):
        raise ValueError("json_as must be 'string' or 'variant'")
    check_bindings(bindings)
    # Stage 1 computes each typed value and its error once; stage 2 applies the
    # mode on column references (Catalyst keeps the stages apart because the
    # error is referenced twice), so no cast is evaluated repeatedly.
    stage1 = [F.col(k) for k in keep]
    for i, b in enumerate(bindings):
        if isinstance(b.src, str) and b.src not in df.columns:
            src_c, src_t = F.lit(None).cast(b.type.spark_type()), b.type.spark_type()
        else:
            src_c, src_t = b.source(), _source_type(df, b)
        r = conform(src_c, src_t, b.type, b.name, null_unsigned)
        stage1 += [r.value.alias(f"__v{i}"), r.error.alias(f"__e{i}")]
    s1 = df.select(*stage1)
    cols = [F.col(k) for k in keep]
    for i, b in enumerate(bindings):
        v = apply_mode(F.col(f"__v{i}"), F.col(f"__e{i}"), mode)
        if json_as == "variant" and b.type.name == "JSON":
            v = F.try_parse_json(v)
        cols.append(v.alias(b.name))
    if mode == "report":
        cols.append(F.array_compact(F.array(*[F.col(f"__e{i}") for i in range(len(bindings))])).alias(ERRORS_COL))
    return s1.select(*cols)


def match_by_name(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Order columns as the target table does (bindings may come in any order)."""
    missing = [c for c in target_columns if c not in df.columns]
    if missing:
        raise ValueError(f"Columns missing for the target: {missing}")
    return df.select(*[F.col(c) for c in target_columns])


@dataclass(frozen=True)
class Column_:
    """A target table column: name, type and optional SQL DEFAULT expression."""

    name: str
    type: TargetType
    default: str | None = None


@dataclass
class TableSpec:
    """Declared target table (the Spark side keeps it next to a Parquet path)."""

    name: str
    columns: list[Column_] = field(default_factory=list)
    sort_key: tuple[str, ...] = ()

    @staticmethod
    def of(name: str, cols: Sequence[tuple], sort_key: Sequence[str] = ()) -> "TableSpec":
        out = []
        for c in cols:
            n, decl = c[0], c[1]
            out.append(Column_(n, parse_type(decl), c[2] if len(c) > 2 else None))
        return TableSpec(name, out, tuple(sort_key))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type.spark_type(), True) for c in self.columns])


def default_for_omitted(df: DataFrame, table: TableSpec, keep: Iterable[str] = ()) -> DataFrame:
    """Columns of the table that the load left unbound get the table DEFAULT
    (or NULL) for every row; bound columns - including explicit NULLs - are kept,
    and so are the extra columns ``keep``."""
    cols = []
    for c in table.columns:
        if c.name in df.columns:
            cols.append(F.col(c.name).cast(c.type.spark_type()).alias(c.name))
        elif c.default is not None:
            cols.append(F.expr(c.default).cast(c.type.spark_type()).alias(c.name))
        else:
            cols.append(F.lit(None).cast(c.type.spark_type()).alias(c.name))
    return df.select(*cols, *keep)


def map_records(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """Opaque-record adapter: ``fn(pandas.DataFrame) -> pandas.DataFrame`` per
    Arrow batch, for inputs a binding list cannot express."""

    def run(it):
        for pdf in it:
            yield fn(pdf)

    return df.mapInPandas(run, schema)
