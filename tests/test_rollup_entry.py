"""Rollups re-merge, read-back helpers, and the driver contract."""

import os
import re

from pyspark.sql import functions as F

from ladle.operators.rollup import concat_arrays, remerge, remerge_concat, remerge_sum_map, rollup, sum_map
from tests.conftest import SF_SMALL

SPECS = [("mx", "max", None), ("last", "anyLast", "ts"), ("tot", "sum", None)]


def test_rollup_of_rollups_equals_rollup(spark):
    rows = [(i % 7, i, f"s{i}", i * 1.5, [i % 3, i % 5], {"a": i, "b": 1}) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, ts int, last string, tot double, arr array<int>, m map<string,int>")
    df = df.withColumn("mx", F.col("ts"))
    whole = {r.k: (r.mx, r.last, r.tot) for r in rollup(df, ["k"], SPECS).collect()}
    a, b = df.where("ts % 2 = 0"), df.where("ts % 2 = 1")
    merged = remerge([rollup(a, ["k"], SPECS), rollup(b, ["k"], SPECS)], ["k"], SPECS)
    assert {r.k: (r.mx, r.last, r.tot) for r in merged.collect()} == whole
    c_whole = sorted(map(tuple, concat_arrays(df, ["k"], "arr").collect()), key=str)
    c_merged = sorted(map(tuple, remerge_concat([concat_arrays(a, ["k"], "arr"), concat_arrays(b, ["k"], "arr")],
                                                ["k"]).collect()), key=str)
    assert c_whole == c_merged
    m_whole = sorted(map(tuple, sum_map(df, ["k"], "m").collect()), key=str)
    m_merged = sorted(map(tuple, remerge_sum_map([sum_map(a, ["k"], "m"), sum_map(b, ["k"], "m")], ["k"]).collect()), key=str)
    assert m_whole == m_merged


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["shard", "n_batches", "n_rows", "bytes_sent", "max_rows_per_batch", "min_rows_per_batch"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert not [k for k in set(q) - set(o) if k != "pipeline" and not re.match(r"op\d+_", k)]


def test_oracles_on_smallest_tables(spark):
    """Every registered query that has a DuckDB oracle against it on sf0.001."""
    import __spark_entry__ as E
    from tests.oracle_check import compare

    res = compare(spark, SF_SMALL, keys=list(E.oracle_sql()), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows_only")}
    assert not bad, bad


def test_streaming_rollup_equals_batch_rollup(spark, tmp):
    from ladle.streaming.rollup_stream import read_rollup, stream_rollup
    from ladle.streaming.stream import batch_folder, file_stream

    o = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet")).select(
        "o_custkey", F.col("o_totalprice").alias("mx"), F.col("o_orderstatus").alias("last"),
        F.struct("o_orderdate", "o_orderkey").alias("ord"))
    src = os.path.join(tmp, "in")
    o.repartition(5, "o_custkey").write.parquet(src)
    specs = [("mx", "max", None), ("last", "anyLast", "ord")]
    out = os.path.join(tmp, "rollup")
    stream_rollup(file_stream(spark, src, spark.read.parquet(src).schema, 2), ["o_custkey"], specs, out,
                  os.path.join(tmp, "ckpt"))
    got = {r.o_custkey: (r.mx, r.last) for r in read_rollup(spark, out).collect()}
    exp = {r.o_custkey: (r.mx, r.last) for r in rollup(o, ["o_custkey"], specs).collect()}
    assert got == exp


def test_streaming_rollup_is_exactly_once_across_a_crash(spark, tmp, monkeypatch):
    import pytest

    from ladle.streaming.rollup_stream import read_rollup, stream_rollup
    from ladle.streaming.stream import batch_folder, file_stream

    o = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet")).select(
        "o_custkey", F.col("o_totalprice").alias("mx"), F.col("o_totalprice").cast("decimal(38,4)").alias("tot"))
    src = os.path.join(tmp, "in")
    o.repartition(4, "o_custkey").write.parquet(src)
    specs = [("mx", "max", None), ("tot", "sum", None)]
    out, ckpt = os.path.join(tmp, "rollup"), os.path.join(tmp, "ckpt")
    schema = spark.read.parquet(src).schema

    from ladle.streaming import rollup_stream as module

    tries = {"n": 0}

    def crashing(path, name, batch_id):
        # The folder is asked for when a partial is written; the next micro-batch's write fails behind it.
        tries["n"] += 1
        if batch_id == 2:
            rollup(spark.read.schema(schema).parquet(src), ["o_custkey"], specs).write.mode("overwrite").parquet(batch_folder(path, name, batch_id))
            raise RuntimeError("crash after writing version 2")
        return batch_folder(path, name, batch_id)

    with monkeypatch.context() as m, pytest.raises(Exception, match="crash after writing"):
        m.setattr(module, "batch_folder", crashing)
        stream_rollup(file_stream(spark, src, schema, 1), ["o_custkey"], specs, out, ckpt)
    assert tries["n"] == 3
    stream_rollup(file_stream(spark, src, schema, 1), ["o_custkey"], specs, out, ckpt)
    got = {r.o_custkey: (r.mx, r.tot) for r in read_rollup(spark, out).collect()}
    exp = {r.o_custkey: (r.mx, r.tot) for r in rollup(o, ["o_custkey"], specs).collect()}
    assert got == exp  # the replayed micro-batch did not add its sums twice


def test_remerge_random_splits(spark):
    import random

    rng = random.Random(41)
    rows = [(rng.randint(0, 20), i, rng.choice(["a", "b", None]), rng.randint(-50, 50),
             [rng.randint(0, 5) for _ in range(rng.randint(0, 3))], {rng.choice("xyz"): rng.randint(1, 9)})
            for i in range(600)]
    df = spark.createDataFrame(rows, "k int, ord int, last string, v int, arr array<int>, m map<string,int>") \
        .withColumn("mx", F.col("v")).withColumn("mn", F.col("v")).withColumn("tot", F.col("v"))
    specs = [("mx", "max", None), ("mn", "min", None), ("tot", "sum", None), ("last", "anyLast", "ord")]
    whole = sorted(tuple(r) for r in rollup(df, ["k"], specs).select("k", "mx", "mn", "tot", "last").collect())
    c_whole = sorted(map(tuple, concat_arrays(df, ["k"], "arr").collect()), key=str)
    m_whole = sorted(map(tuple, sum_map(df, ["k"], "m").collect()), key=str)
    for seed in range(3):
        cut = F.pmod(F.xxhash64("ord", F.lit(seed)), F.lit(3)) == 0
        a, b = df.where(cut), df.where(~cut)
        merged = remerge([rollup(a, ["k"], specs), rollup(b, ["k"], specs)], ["k"], specs)
        assert sorted(tuple(r) for r in merged.select("k", "mx", "mn", "tot", "last").collect()) == whole
        assert sorted(map(tuple, remerge_concat([concat_arrays(a, ["k"], "arr"), concat_arrays(b, ["k"], "arr")],
                                                ["k"]).collect()), key=str) == c_whole
        assert sorted(map(tuple, remerge_sum_map([sum_map(a, ["k"], "m"), sum_map(b, ["k"], "m")],
                                                 ["k"]).collect()), key=str) == m_whole


def test_two_streams_feed_one_rollup(spark, tmp):
    from ladle.streaming.rollup_stream import compact_rollup, read_rollup, stream_rollup

    out, specs = os.path.join(tmp, "rollup"), [("v", "sum", None)]
    for name in ("a", "b"):
        src = os.path.join(tmp, name)
        spark.createDataFrame([(1, 2), (2, 3), (1, 100)], "k int, v long").repartition(2).write.parquet(src)
        stream = spark.readStream.schema("k int, v long").option("maxFilesPerTrigger", 1).parquet(src)
        stream_rollup(stream, ["k"], specs, out, os.path.join(tmp, f"ckpt-{name}"))
    assert {r.k: r.v for r in read_rollup(spark, out).collect()} == {1: 204, 2: 6}
    compact_rollup(spark, out, os.path.join(tmp, "compact"))
    assert {r.k: r.v for r in read_rollup(spark, os.path.join(tmp, "compact")).collect()} == {1: 204, 2: 6}


def test_keys_with_only_empty_collections_stay(spark):
    from ladle.operators.rollup import as_array, as_map

    arrays = spark.createDataFrame([(1, [3, 1]), (1, [1]), (2, []), (3, None), (4, [7]), (4, [])], "k int, a array<int>")
    multiset = concat_arrays(arrays, ["k"], "a")
    assert {r.k: r.array for r in as_array(multiset, ["k"]).collect()} == {1: [1, 1, 3], 2: [], 3: [], 4: [7]}
    twice = remerge_concat([multiset, multiset], ["k"])
    assert {r.k: r.array for r in as_array(twice, ["k"]).collect()} == {1: [1, 1, 1, 1, 3, 3], 2: [], 3: [], 4: [7, 7]}
    maps = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2, "b": 3}), (2, {}), (3, None)], "k int, m map<string,long>")
    rows = sum_map(maps, ["k"], "m")
    assert {r.k: r.map for r in as_map(remerge_sum_map([rows, rows], ["k"]), ["k"]).collect()} == {1: {"a": 6, "b": 6}, 2: {}, 3: {}}


def test_compaction_in_place(spark, tmp):
    """Partials are merged into snapshots while streams go on; a replayed micro-batch isn't counted twice; old snapshots stay until they expire."""
    import os

    import pytest

    from ladle.operators.rollup import rollup
    from ladle.streaming.rollup_stream import _keep_spec, compact_in_place, expire_snapshots, read_rollup, snapshots
    from ladle.streaming.stream import batch_folder

    path, specs = os.path.join(tmp, "t"), [("mx", "max", None), ("tot", "sum", None)]
    assert read_rollup(spark, path) is None
    _keep_spec(spark, path, ["k"], specs)
    assert read_rollup(spark, path) is None and compact_in_place(spark, path) == 0

    def batch(stream, number, *rows):
        df = spark.createDataFrame([(k, v, v) for k, v in rows], "k int, mx long, tot long")
        rollup(df, ["k"], specs).write.mode("overwrite").parquet(batch_folder(path, stream, number))

    def found(snapshot=None):
        return {r.k: (r.mx, r.tot) for r in read_rollup(spark, path, snapshot).collect()}

    batch("a", 0, (1, 5), (2, 7))
    batch("a", 1, (1, 6))
    batch("b", 0, (1, 1))
    assert compact_in_place(spark, path) == 1 and compact_in_place(spark, path) == 1 and found() == found(1) == {1: (6, 12), 2: (7, 7)}
    batch("a", 1, (1, 6))  # replayed: its driver was lost before it committed
    batch("a", 2, (3, 4))
    assert found() == {1: (6, 12), 2: (7, 7), 3: (4, 4)} and found(1) == {1: (6, 12), 2: (7, 7)}
    os.makedirs(batch_folder(path, "c", 0))  # being written: nothing of it counts yet
    rollup(spark.createDataFrame([(9, 9, 9)], "k int, mx long, tot long"), ["k"], specs).write.parquet(os.path.join(path, "_snapshot=2"))  # an interrupted compaction
    assert found() == {1: (6, 12), 2: (7, 7), 3: (4, 4)}
    assert compact_in_place(spark, path) == 2 and found(2) == found() == {1: (6, 12), 2: (7, 7), 3: (4, 4)}
    assert snapshots(spark, path) == {1: {"a": 1, "b": 0}, 2: {"a": 2, "b": 0}}
    expire_snapshots(spark, path, keep=2)
    assert found(1) == {1: (6, 12), 2: (7, 7)} and not os.path.exists(batch_folder(path, "a", 0)) and os.path.exists(batch_folder(path, "a", 2))
    expire_snapshots(spark, path)
    assert found() == {1: (6, 12), 2: (7, 7), 3: (4, 4)} and not os.path.exists(batch_folder(path, "a", 2))
    with pytest.raises(ValueError):
        found(1)
    batch("b", 1, (2, 1))
    assert found() == {1: (6, 12), 2: (7, 8), 3: (4, 4)}
