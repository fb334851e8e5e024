"""Tables whose columns change: added with a default, renamed, widened, dropped; no file is rewritten.

A table's columns are noted beside its files (:data:`ladle.sinks.table.SCHEMA_FILE`), each
with an id that it keeps for life. In the Parquet files a column's name is made of its id, and readers
give it the name it has now:

* A column that a file lacks reads as its default (NULL without one); an explicit NULL stays NULL.
* A renamed column reads under its new name from old files, too.
* A widened column (more digits, a longer integer, a double for a float, a time for a date) is widened as old files are read.
* A dropped column is not read any more; one added later under the same name is another column,
  which old files lack.

Defaults and widening are those of Spark's own Parquet reader. Files are
appended to the table's folder; a column that a load leaves out reads as its default, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.types import parse_type
from ladle.operators.bindings import TableSpec
from ladle.sinks.table import SchemaDriftError, UnknownColumnError, known_schema, write_schema

ID = "ladle.id"
#: Spark's names for the default that rows written before a column have, and the one of rows to come.
EXISTING, CURRENT = "EXISTS_DEFAULT", "CURRENT_DEFAULT"
LAST_ID = "ladle.last.id"
INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def create_table(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Notes the columns of a new table, whose folder must hold none."""
    if known_schema(spark, path) is not None:
        raise ValueError(f"There is a table at {path}")
    schema = T.StructType()
    for column in spec.columns:
        schema = _added(spark, schema, column.name, column.type.spark_type(), column.default)
    write_schema(spark, path, schema)


def _columns(spark: SparkSession, path: str) -> T.StructType:
    schema = known_schema(spark, path)
    if schema is None or any(ID not in f.metadata for f in schema.fields):
        raise ValueError(f"No table with column ids at {path}")
    return schema


def _name(f: T.StructField) -> str:
    """A column's name in the files."""
    return f"c{f.metadata[ID]}"


def _last(schema: T.StructType) -> int:
    return max((f.metadata.get(LAST_ID, f.metadata[ID]) for f in schema.fields), default=0)


def _added(spark: SparkSession, schema: T.StructType, name: str, kind: T.DataType, default: str | None) -> T.StructType:
    if name.lower() in (f.name.lower() for f in schema.fields):
        raise ValueError(f"There is a column {name}")
    number = _last(schema) + 1
    metadata = {ID: number, LAST_ID: number}
    if default is not None:
        spark.range(0).select(F.expr(default).cast(kind))  # raises for what is no expression
        metadata |= {EXISTING: f"cast(({default}) as {kind.simpleString()})", CURRENT: f"cast(({default}) as {kind.simpleString()})"}
    return T.StructType([*schema.fields, T.StructField(name, kind, True, metadata)])


def add_column(spark: SparkSession, path: str, name: str, decl: str, default: str | None = None) -> None:
    """Adds a column at the end; rows that are there read as ``default``, a constant SQL expression."""
    write_schema(spark, path, _added(spark, _columns(spark, path), name, parse_type(decl).spark_type(), default))


def _place(schema: T.StructType, name: str) -> int:
    if name not in schema.names:
        raise UnknownColumnError(f"No column {name}")
    return schema.names.index(name)


def rename_column(spark: SparkSession, path: str, name: str, new: str) -> None:
    schema = _columns(spark, path)
    at = _place(schema, name)
    if new.lower() in (f.name.lower() for i, f in enumerate(schema.fields) if i != at):
        raise ValueError(f"There is a column {new}")
    f = schema.fields[at]
    schema.fields[at] = T.StructField(new, f.dataType, True, f.metadata)
    write_schema(spark, path, T.StructType(schema.fields))


def drop_column(spark: SparkSession, path: str, name: str) -> None:
    """The column is not read any more; its id is never given again."""
    schema = _columns(spark, path)
    last, at = _last(schema), _place(schema, name)
    left = [f for i, f in enumerate(schema.fields) if i != at]
    if not left:
        raise ValueError("A table has a column at least")
    left[0] = T.StructField(left[0].name, left[0].dataType, True, {**left[0].metadata, LAST_ID: last})
    write_schema(spark, path, T.StructType(left))


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is one of ``new`` that Spark reads from files of ``old``."""
    if old in INTEGERS and new in INTEGERS:
        return INTEGERS.index(new) >= INTEGERS.index(old)
    if old in INTEGERS and isinstance(new, T.DecimalType):
        return new.precision - new.scale >= (10 if old != T.LongType() else 20)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return (old, new) in ((T.FloatType(), T.DoubleType()), (T.IntegerType(), T.DoubleType()), (T.ShortType(), T.DoubleType()), (T.ByteType(), T.DoubleType()),
                          (T.DateType(), T.TimestampNTZType())) or old == new


def widen_column(spark: SparkSession, path: str, name: str, decl: str) -> None:
    """Gives a column a wider type; what would lose values raises."""
    schema, kind = _columns(spark, path), parse_type(decl).spark_type()
    at = _place(schema, name)
    f = schema.fields[at]
    if not widens(f.dataType, kind):
        raise SchemaDriftError(f"Column {name}: {f.dataType.simpleString()} can't be read as {kind.simpleString()}")
    metadata = {k: v.rpartition(" as ")[0] + f" as {kind.simpleString()})" if k in (EXISTING, CURRENT) else v for k, v in f.metadata.items()}
    schema.fields[at] = T.StructField(name, kind, True, metadata)
    write_schema(spark, path, T.StructType(schema.fields))


def append(df: DataFrame, path: str) -> None:
    """Appends rows by column names; columns of the table that ``df`` lacks read as their defaults."""
    schema = _columns(df.sparkSession, path)
    have = {f.name: f for f in schema.fields}
    for f in df.schema.fields:
        if f.name not in have:
            raise UnknownColumnError(f"Column {f.name} is not in the table {path}")
        if not widens(f.dataType, have[f.name].dataType):
            raise SchemaDriftError(f"Column {f.name}: got {f.dataType.simpleString()}, table has {have[f.name].dataType.simpleString()}")
    rows = df.select(*[F.col(f"`{f.name}`").cast(have[f.name].dataType).alias(_name(have[f.name])) for f in df.schema.fields])
    rows.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows under the table's present columns."""
    schema = _columns(spark, path)
    files = T.StructType([T.StructField(_name(f), f.dataType, True, {k: v for k, v in f.metadata.items() if k in (EXISTING, CURRENT)}) for f in schema.fields])
    rows = spark.read.schema(files).option("recursiveFileLookup", "true").parquet(path)
    return rows.select(*[F.col(_name(f)).alias(f.name, metadata={}) for f in schema.fields])
