"""Read-back queries used to check what was loaded."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_sorted(df: DataFrame, cols: Sequence[str], order_by: str) -> DataFrame:
    return df.select(*cols).orderBy(F.col(order_by).asc())


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def count_rows_where(df: DataFrame, cond: Column | str) -> DataFrame:
    return df.where(cond).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def filter_limit(df: DataFrame, cond: Column | str, order_by: Sequence[str], n: int) -> DataFrame:
    return df.where(cond).orderBy(*order_by).limit(n)


def json_subcolumn(df: DataFrame, col: str, path: str, as_type: str = "string") -> Column:
    return F.get_json_object(F.col(col), path).try_cast(as_type)


def error_log_count(log: DataFrame, table: str, code: int,
                    types: Sequence[str] = ("ExceptionBeforeStart", "ExceptionWhileProcessing")) -> DataFrame:
    cond = F.col("type").isin(*types) & (F.col("exception_code") == code) & F.array_contains("tables", table)
    return count_rows_where(log, cond)


def first_containing(df: DataFrame, col: str, needle: str, order_by: Sequence[str]) -> DataFrame:
    return df.where(F.col(col).contains(needle)).orderBy(*order_by).limit(1)


def _set_comparable(df: DataFrame) -> DataFrame:
    """Maps cannot take part in set operations: compare them as sorted entry arrays."""
    from pyspark.sql import types as T

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType):
            c = F.array_sort(F.map_entries(c))
        cols.append(c.alias(f.name))
    return df.select(*cols)


#: Ranges of a round-trip check; a row that differs costs two of them at most a second look.
FINGERPRINT_RANGES = 1 << 14


def fingerprints(df: DataFrame, ranges: int = FINGERPRINT_RANGES) -> DataFrame:
    """(range, n, one, other): rows of each range of row hashes, and the sums of two 64-bit hashes of all columns.

    The sums don't depend on the rows' order and are added up in the tasks, so what is
    shuffled is a few numbers per range.
    """
    rows = _set_comparable(df)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    hashed = rows.select(F.xxhash64(*columns).alias("one"), F.xxhash64(F.lit("other"), *columns[::-1]).alias("other"))
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    return hashed.groupBy(F.pmod("one", F.lit(ranges)).alias("range")).agg(F.count(F.lit(1)).alias("n"), wide("one").alias("one"), wide("other").alias("other"))


def round_trip_diff(written: DataFrame, read: DataFrame, ranges: int = FINGERPRINT_RANGES) -> DataFrame:
    """Rows missing after the round trip and rows that appeared (both 0 when equal), and the rows read.

    Both sides are compared by the fingerprints of ranges of their rows' hashes first.
    Only the rows of ranges that differ are then compared in full, by one aggregate whose
    rows count +1 and -1. Equal tables are never shuffled.
    """
    columns = written.columns
    read = read.select(*[F.col(f"`{c}`") for c in columns])
    one, other = fingerprints(written, ranges), fingerprints(read, ranges)
    both = one.join(other.select("range", *[F.col(c).alias(f"r_{c}") for c in ("n", "one", "other")]), "range", "full")
    same = F.col("n").eqNullSafe(F.col("r_n")) & F.col("one").eqNullSafe(F.col("r_one")) & F.col("other").eqNullSafe(F.col("r_other"))
    # A number per range.
    compared = both.agg(F.coalesce(F.sum("r_n"), F.lit(0)).alias("n"), F.collect_list(F.when(~same, F.col("range"))).alias("ranges")).first()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    n_read = F.lit(compared["n"]).cast("bigint").alias("n_read")
    spark = written.sparkSession
    if not compared["ranges"]:
        return spark.range(1).select(F.lit(0).cast("bigint").alias("n_missing"), F.lit(0).cast("bigint").alias("n_extra"), n_read)
    differing = F.broadcast(spark.createDataFrame([(int(r),) for r in compared["ranges"]], "differing long"))

    def some(df: DataFrame, sign: int) -> DataFrame:
        rows = _set_comparable(df)
        of = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(ranges))
        return rows.join(differing, of == F.col("differing"), "left_semi").withColumn("__sign", F.lit(sign))

    net = some(written, 1).unionByName(some(read, -1)).groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("__sign").alias("__net"))
    return net.agg(total(F.greatest(F.col("__net"), F.lit(0))).alias("n_missing"), total(F.greatest(-F.col("__net"), F.lit(0))).alias("n_extra"), n_read)


def count_files(df: DataFrame) -> DataFrame:
    """Distinct data files behind a table (small-file check after batching); reads no data columns."""
    return df.select("_metadata.file_path").agg(F.count_distinct("file_path").cast("bigint").alias("files"))
