"""Rollup tables: the merge of simple-aggregate columns, batch or streaming.

A column declared ``SimpleAggregateFunction(f, T)`` is written as its inner
value and merged per sort key with ``f``. Merges are associative, so a rollup
of partial rollups equals the rollup of the whole (re-mergeable): every
function here keeps whatever it needs to merge again.

* ``max`` / ``min`` / ``sum`` - plain aggregates (map-side partial aggregation).
* ``anyLast`` - the value of the latest row by an explicit order column
  (``max_by``); the order value is kept in ``<col>__ord`` for re-merging.
* ``groupArrayArray`` - the concatenation of arrays, kept as a multiset
  ``(key, element, count)`` so no group is ever collected into one row.
* ``sumMap`` - per (key, map key) sums, kept as ``(key, map_key, value)`` rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _agg(fn: str, col: str, order: str | None, out: str, skip_nulls: bool = True) -> list[Column]:
    c = F.col(col)
    if fn == "max":
        return [F.max(c).alias(out)]
    if fn == "min":
        return [F.min(c).alias(out)]
    if fn == "sum":
        return [F.sum(c).alias(out)]
    if fn == "anyLast":
        if order is None:
            raise ValueError("anyLast needs an order column")
        o = F.col(order)
        if skip_nulls:
            return [F.max_by(c, F.when(c.isNotNull(), o)).alias(out), F.max(F.when(c.isNotNull(), o)).alias(out + "__ord")]
        return [F.max_by(c, o).alias(out), F.max(o).alias(out + "__ord")]
    raise ValueError(f"unsupported simple aggregate {fn}")


def rollup(df: DataFrame, key: Sequence[str], specs: Sequence[tuple[str, str, str | None]],
           skip_nulls: bool = True) -> DataFrame:
    """Merge rows per ``key``. ``specs`` = [(column, function, order column)];
    scalar functions only (see :func:`concat_arrays` / :func:`sum_map`)."""
    aggs = []
    for col, fn, order in specs:
        aggs += _agg(fn, col, order, col, skip_nulls)
    return df.groupBy(*key).agg(*aggs)


def remerge(partials: Sequence[DataFrame], key: Sequence[str], specs: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Merge partial rollups (same functions; anyLast uses the kept order)."""
    u = partials[0]
    for p in partials[1:]:
        u = u.unionByName(p)
    aggs = []
    for col, fn, _ in specs:
        if fn == "anyLast":
            aggs += [F.max_by(F.col(col), F.col(col + "__ord")).alias(col), F.max(col + "__ord").alias(col + "__ord")]
        else:
            aggs += _agg(fn, col, None, col)
    return u.groupBy(*key).agg(*aggs)


def concat_arrays(df: DataFrame, key: Sequence[str], arr: str, out: str = "element") -> DataFrame:
    """groupArrayArray as a multiset: (key..., element, count).

    A key with an empty (or null) array keeps a row (key..., NULL, 0): no key is lost.
    """
    e = df.select(*key, F.posexplode_outer(F.col(arr)).alias("_pos", out))
    return e.groupBy(*key, out).agg(F.count("_pos").cast("bigint").alias("count"))


def _at_most(rows: DataFrame, key: Sequence[str], size: Column, most: int, of: str) -> DataFrame:
    """``rows``; a key whose ``size`` exceeds ``most`` raises before any of its rows is collected.

    The window and what is then grouped by the key share one shuffle.
    """
    sized = rows.withColumn("_n", size.over(Window.partitionBy(*key)))
    checked = F.when(F.col("_n") > most, F.raise_error(F.lit(f"More than {most} {of} under one key")).cast("bigint")).otherwise(F.col("_n"))
    return sized.withColumn("_n", checked).where(F.col("_n").isNull() | (F.col("_n") >= 0)).drop("_n")


def as_array(rows: DataFrame, key: Sequence[str], out: str = "element", most: int = 1_000_000) -> DataFrame:
    """The multiset as one sorted array per key. A key with more than ``most`` elements raises: its array would not fit a row."""
    checked = _at_most(rows, key, F.sum("count"), most, "elements")
    held = checked.groupBy(*key).agg(F.collect_list(F.when(F.col("count") > 0, F.struct(F.col(out).alias("e"), "count"))).alias("_parts"))
    return held.select(*key, F.flatten(F.transform(F.array_sort("_parts"), lambda p: F.array_repeat(p["e"], p["count"].cast("int")))).alias("array"))


def remerge_concat(partials: Sequence[DataFrame], key: Sequence[str], out: str = "element") -> DataFrame:
    u = partials[0]
    for p in partials[1:]:
        u = u.unionByName(p)
    return u.groupBy(*key, out).agg(F.sum("count").cast("bigint").alias("count"))


def sum_map(df: DataFrame, key: Sequence[str], m: str) -> DataFrame:
    """sumMap as rows: (key..., map_key, value) summed over the group; a key with an empty map keeps a row (key..., NULL, NULL)."""
    e = df.select(*key, F.explode_outer(F.col(m)).alias("map_key", "_v"))
    return e.groupBy(*key, "map_key").agg(F.sum("_v").alias("value"))


def remerge_sum_map(partials: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    u = partials[0]
    for p in partials[1:]:
        u = u.unionByName(p)
    return u.groupBy(*key, "map_key").agg(F.sum("value").alias("value"))


def as_map(rows: DataFrame, key: Sequence[str], most: int = 1_000_000) -> DataFrame:
    """sumMap rows as one map per key. A key with more than ``most`` map keys raises: its map would not fit a row."""
    checked = _at_most(rows, key, F.count("map_key"), most, "map keys")
    held = checked.groupBy(*key).agg(F.collect_list(F.when(F.col("map_key").isNotNull(), F.struct("map_key", "value"))).alias("_entries"))
    return held.select(*key, F.map_from_entries(F.array_sort("_entries")).alias("map"))


def streaming_rollup(stream: DataFrame, key: Sequence[str], specs: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Same merge on a stream; write it with ``outputMode("update")``."""
    return rollup(stream, key, specs)
