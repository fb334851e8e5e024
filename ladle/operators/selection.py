"""The n-th key of a table, without sorting it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A range of this many rows or fewer is sorted.
SORTED_ROWS = 100_000
#: Ranks that quantiles are asked for lie within a share of 1 / ACCURACY.
ACCURACY = 10_000


def nth_key(df: DataFrame, key: str, n: int, *, sorted_rows: int = SORTED_ROWS, accuracy: int = ACCURACY):
    """The ``n``-th least value of a number, date or timestamp column, from 1; the greatest if there are fewer, None without any.

    Quantile sketches (merged in the tasks) give a pivot near the rank and a bound on either
    side; counts tell which of the ranges between them holds the rank. Each round looks at
    that range alone, which shrinks by about ``accuracy``, so two or three rounds leave few rows, or equal ones.
    No task sees more than sketches of the others. Nulls don't count.
    """
    if n < 1:
        raise ValueError("ranks count from 1")
    column, keys = F.col("key"), df.select(df[key].alias("key")).where(F.col("key").isNotNull())
    rows = keys.count()
    if not rows:
        return None
    n, low, high, open_low, open_high = min(n, rows), None, None, False, False

    def inside() -> DataFrame:
        some = keys
        if low is not None:
            some = some.where(column > F.lit(low) if open_low else column >= F.lit(low))
        if high is not None:
            some = some.where(column < F.lit(high) if open_high else column <= F.lit(high))
        return some

    def count(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    while rows > sorted_rows:
        share, slack = n / rows, 2 / accuracy
        lower, pivot, upper = inside().agg(F.percentile_approx("key", [max(0.0, share - slack), share, min(1.0, share + slack)], accuracy)).first()[0]
        below, before, upto, above = inside().agg(count(column < F.lit(lower), "a"), count(column < F.lit(pivot), "b"), count(column <= F.lit(pivot), "c"),
                                                  count(column <= F.lit(upper), "d")).first()
        if before < n <= upto:
            return pivot
        if n <= before:
            high, open_high, rows = pivot, True, before
            if n > below:
                low, open_low, n, rows = lower, False, n - below, before - below
        else:
            low, open_low, n, rows = pivot, True, n - upto, rows - upto
            if n <= above - upto:
                high, open_high, rows = upper, False, above - upto
    return inside().orderBy("key").limit(n).agg(F.max("key")).first()[0]


def split_by_ordinal(df: DataFrame, key: str, n: int, name: str = "part") -> DataFrame:
    """``df`` with the column ``name``: ``first`` for rows up to the ``n``-th key (ties included), else ``rest`` (null keys too)."""
    bound = nth_key(df, key, n)
    return df.withColumn(name, F.when(df[key] <= F.lit(bound), F.lit("first")).otherwise(F.lit("rest")))
