"""The n-th key by selection, and the round-trip check by fingerprints."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ladle.operators.readback import fingerprints, round_trip_diff
from ladle.operators.selection import nth_key, split_by_ordinal


@pytest.mark.parametrize("kind", ["spread", "ties", "one value", "skewed"])
@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_nth_key(spark, kind, accuracy):
    rng = random.Random(3)
    values = {"spread": [rng.randrange(10 ** 9) for _ in range(2000)], "ties": [rng.randrange(12) for _ in range(2000)], "one value": [7] * 500,
              "skewed": [0] * 900 + [int(1.02 ** i) for i in range(900)]}[kind]
    df = spark.createDataFrame([(v, 1) for v in values] + [(None, 1)], "k long, key int").repartition(5)
    values.sort()
    for n in (1, 2, 17, len(values) // 2, len(values) - 1, len(values), len(values) + 5):
        assert nth_key(df, "k", n, sorted_rows=10, accuracy=accuracy) == values[min(n, len(values)) - 1]


def test_nth_key_of_other_types(spark):
    df = spark.range(300).select((F.col("id") / 7).alias("d"), F.expr("date_add(date'2020-01-01', int(id))").alias("day"), F.col("id").cast("decimal(20,2)").alias("dec"))
    assert nth_key(df, "d", 100, sorted_rows=5) == 99 / 7
    assert str(nth_key(df, "day", 32, sorted_rows=5)) == "2020-02-01"
    assert nth_key(df, "dec", 3, sorted_rows=5) == Decimal(2)
    assert nth_key(df.where("id < 0") if "id" in df.columns else df.where("d < 0"), "d", 1) is None
    with pytest.raises(ValueError):
        nth_key(df, "d", 0)


def test_split(spark):
    df = spark.createDataFrame([(k,) for k in (5, 1, 3, 3, 9, None)], "k long")
    assert sorted((r.k or 0, r.part) for r in split_by_ordinal(df, "k", 2).collect()) == [(0, "rest"), (1, "first"), (3, "first"), (3, "first"), (5, "rest"), (9, "rest")]
    assert {r.part for r in split_by_ordinal(df.where("k > 100"), "k", 2).collect()} == set()


def rows(n):
    return [(i % 50, f"t{i}" if i % 9 else None, [i, None], {"a": i, "b": None}, float("nan") if i % 5 == 0 else i / 3) for i in range(n)]


SCHEMA = "k long, `te.xt` string, arr array<int>, m map<string, int>, f double"


@pytest.mark.parametrize("ranges", [1, 16, 1 << 14])
def test_round_trip(spark, ranges):
    base = rows(400)
    one = spark.createDataFrame(base, SCHEMA).repartition(3)
    same = spark.createDataFrame(base[::-1], SCHEMA).repartition(5)
    assert tuple(round_trip_diff(one, same, ranges).first()) == (0, 0, 400)
    changed = base[3:] + base[10:12] + [(1, "new", [], {}, None)]
    other = spark.createDataFrame(changed, SCHEMA).select("f", "m", "arr", "`te.xt`", "k")
    assert tuple(round_trip_diff(one, other, ranges).first()) == (3, 3, 400)
    none = one.where("k < 0")
    assert tuple(round_trip_diff(one, none, ranges).first()) == (400, 0, 0) and tuple(round_trip_diff(none, none, ranges).first()) == (0, 0, 0)


def test_doubled_rows_are_seen(spark):
    """A row twice on one side, or two rows swapped between ranges, change the sums."""
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert tuple(round_trip_diff(one, one.union(one)).first()) == (0, 2, 4)
    assert tuple(round_trip_diff(one, spark.createDataFrame([(1, "b"), (2, "a")], "k long, v string")).first()) == (2, 2, 2)


def test_an_equal_table_moves_a_few_numbers_per_range(spark):
    big = spark.range(20_000).select("id", F.repeat(F.lit("x"), 50).alias("text"))
    assert fingerprints(big, 8).count() == 8
