"""Loads that write batch by batch: limits, retry, drop, stop, once-only, histograms."""

import glob
import json
import os
import random
import time
import types

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ladle.operators.batching import NO_LIMIT, simulate_flush
from ladle.operators.bindings import TableSpec, of
from ladle.operators.failures import RetryPolicy
from ladle.sinks import batches as B
from ladle.sinks.table import LoadOptions, read_table

BINDINGS = [of("k", "k", "Int64"), of("text", "text", "String")]


class Flaky(B.BatchWriter):
    """Fails the first two tries of every second batch with a lost connection."""

    def send(self, rows, name):
        mark = f"{os.path.dirname(self.path)}/tries-{os.path.basename(name)}-{rows.column(0)[0].as_py()}"
        tries = len(glob.glob(mark + ".*"))
        if rows.column(0)[0].as_py() % 2 == 0 and tries < 2:
            open(f"{mark}.{tries}", "w").close()
            raise ConnectionError("Connection reset by peer")
        super().send(rows, name)


class FlakyTable(B.BatchTable):
    @classmethod
    def name(cls):
        return "flaky_batches"

    def writer(self, schema, overwrite):
        return Flaky(json.loads(self.options["load"]))


def rows_of(spark, n, partitions=1, size=lambda i: 3):
    df = spark.createDataFrame([(i, "x" * size(i)) for i in range(n)], "k long, text string")
    return df.repartitionByRange(partitions, "k").sortWithinPartitions("k")


def batches_of(spark, path):
    files = read_table(spark, path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.sort_array(F.collect_list("k")).alias("keys"))
    return sorted(r["keys"] for r in files.collect())


@pytest.mark.parametrize("max_rows, max_bytes", [(7, 10_000), (1000, 120), (7, 120), (1, 10_000)])
def test_batches_keep_the_limits(spark, tmp, max_rows, max_bytes):
    size = lambda i: (i * 7) % 30 + (200 if i % 23 == 4 else 0)  # noqa: E731 - some above the byte limit
    path = f"{tmp}/t"
    options = LoadOptions(max_batch_size=max_rows, max_batch_bytes=max_bytes, max_record_bytes=100)
    with pytest.raises(Exception, match="record limit"):
        B.load_batches(rows_of(spark, 100, size=size), BINDINGS, path, "first", options)
    options = LoadOptions(max_batch_size=max_rows, max_batch_bytes=max(max_bytes, 300), max_record_bytes=300)
    result = B.load_batches(rows_of(spark, 100, size=size), BINDINGS, path, "first", options)
    ids, _ = simulate_flush([8 + (1 if size(i) < 128 else 2) + size(i) for i in range(100)], max_rows=max_rows, max_bytes=max(max_bytes, 300))
    want = [[i for i in range(100) if ids[i] == b] for b in range(max(ids) + 1)]
    assert batches_of(spark, path) == want and result.metrics["batches"] == len(want) and result.metrics["rows"] == 100


def test_every_partition_is_a_writer(spark, tmp):
    B.load_batches(rows_of(spark, 100, 4), BINDINGS, f"{tmp}/t", "a", LoadOptions(max_batch_size=10))
    found = batches_of(spark, f"{tmp}/t")
    assert sorted(sum(found, [])) == list(range(100)) and all(len(b) <= 10 for b in found) and len(glob.glob(f"{tmp}/t/a/part-*")) == 4


def test_a_batch_waits_no_longer_than_its_time(spark, tmp, monkeypatch):
    """A writer whose rows come slowly, as one task would call it."""
    monkeypatch.setattr(B, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))

    def slowly():
        for at in range(0, 60, 10):
            time.sleep(0.05)
            yield pa.RecordBatch.from_arrays([pa.array(range(at, at + 10)), pa.array([8] * 10), pa.array([[]] * 10, pa.list_(pa.string())), pa.array([None] * 10, pa.string())],
                                             names=["k", "_size", "_errors", "_record"])

    for most_ms, batches in ((1, 6), (10_000, 1)):
        staging = f"{tmp}/t/_staging/a-{most_ms}"
        writer = B.BatchWriter({"path": f"{tmp}/t", "load_id": f"a{most_ms}", "staging": staging, "began": 0.0, "failure": "stop", "max_batch_size": 1000,
                                "max_batch_bytes": 1 << 20, "max_time_in_buffer_ms": most_ms, "max_retries": 0, "retry_pause_s": 0.0})
        done = writer.write(slowly())
        assert done.batches == batches and done.rows == 60
        writer.commit([done])
    assert sorted(sum(batches_of(spark, f"{tmp}/t"), [])) == sorted([*range(60)] * 2)


def test_only_failing_batches_are_tried_again(spark, tmp):
    result = B.load_batches(rows_of(spark, 60), BINDINGS, f"{tmp}/t", "a", LoadOptions(max_batch_size=5), target=FlakyTable, retry_pause_s=0.0)
    # Batches begin at 0, 5, 10...: every second one failed twice.
    assert result.metrics["retries"] == 12 and result.metrics["batches"] == 12
    assert batches_of(spark, f"{tmp}/t") == [list(range(i, i + 5)) for i in range(0, 60, 5)]
    assert sum(result.metrics["histograms"]["failure_us"].values()) == 12 and sum(result.metrics["histograms"]["write_us"].values()) == 12


def test_retries_end(spark, tmp):
    with pytest.raises(Exception, match="failed after 2 attempts"):
        B.load_batches(rows_of(spark, 6), BINDINGS, f"{tmp}/t", "a", LoadOptions(retry=RetryPolicy.limited(1)), target=FlakyTable, retry_pause_s=0.0)
    assert B.load_of(f"{tmp}/t", "a") is None and glob.glob(f"{tmp}/t/_staging/*") == []


def corrupt(spark, n, partitions=1):
    value = F.when(F.col("id") % 17 == 3, F.lit("none")).otherwise(F.col("id").cast("string"))
    return spark.range(0, n, 1, partitions).select(F.col("id").alias("k"), value.alias("v"))


CORRUPT = [of("k", "k", "Int64"), of("v", "v", "Float64")]


def test_stop(spark, tmp):
    with pytest.raises(Exception, match="Corrupt row in batch"):
        B.load_batches(corrupt(spark, 100), CORRUPT, f"{tmp}/t", "a", LoadOptions(max_batch_size=10))
    assert B.load_of(f"{tmp}/t", "a") is None and glob.glob(f"{tmp}/t/*.parquet") == glob.glob(f"{tmp}/t/_staging/*") == []


@pytest.mark.parametrize("partitions", [1, 3])
def test_rejected_batches_keep_their_rows_and_reasons(spark, tmp, partitions):
    result = B.load_batches(corrupt(spark, 100, partitions), CORRUPT, f"{tmp}/t", "a", LoadOptions(max_batch_size=10, failure="drop_batch"))
    accepted = [r.k for r in read_table(spark, f"{tmp}/t").collect()]
    rejected = B.read_rejected(spark, f"{tmp}/t").collect()
    assert sorted(accepted + [r.k for r in rejected]) == list(range(100))
    assert read_table(spark, f"{tmp}/t").columns == ["k", "v"]
    bad = {i for i in range(100) if i % 17 == 3}
    by_batch = {}
    for r in rejected:
        by_batch.setdefault(r["_batch"], []).append(r)
    assert all(any(r.k in bad for r in rows) for rows in by_batch.values()) and not bad & set(accepted)
    for r in rejected:
        assert bool(r["_errors"]) == (r.k in bad) and (json.loads(r["_record"]) == {"k": r.k, "v": "none"} if r.k in bad else r["_record"] is None)
        assert r.v == (None if r.k in bad else float(r.k))
    assert result.metrics["dropped_batches"] == len(by_batch) and result.metrics["dropped_rows"] == len(rejected) and result.metrics["rows"] == len(accepted)


def test_all_batches_or_none_rejected(spark, tmp):
    B.load_batches(corrupt(spark, 10), CORRUPT, f"{tmp}/all", "a", LoadOptions(failure="drop_batch"))
    assert B.read_accepted(spark, f"{tmp}/all").collect() == [] and B.read_rejected(spark, f"{tmp}/all").count() == 10
    B.load_batches(corrupt(spark, 3), CORRUPT, f"{tmp}/none", "a", LoadOptions(failure="drop_batch"))
    assert B.read_accepted(spark, f"{tmp}/none").count() == 3 and B.read_rejected(spark, f"{tmp}/none").collect() == []
    assert B.load_log(spark, f"{tmp}/nothing").collect() == []


def test_a_load_is_done_once(spark, tmp):
    path = f"{tmp}/t"
    first = B.load_batches(rows_of(spark, 50), BINDINGS, path, "monday", LoadOptions(max_batch_size=20)).metrics
    again = B.load_batches(rows_of(spark, 50), BINDINGS, path, "monday", LoadOptions(max_batch_size=20)).metrics
    assert not first["already_loaded"] and again["already_loaded"] and again["batches"] == first["batches"] == 3
    B.load_batches(rows_of(spark, 10), BINDINGS, path, "tuesday")
    assert sorted(r.k for r in read_table(spark, path).collect()) == sorted([*range(50), *range(10)])
    log = {r.load_id: r.rows for r in B.load_log(spark, path).collect()}
    assert log == {"monday": 50, "tuesday": 10}


class Stranded(B.BatchWriter):
    """Loses its driver: as it begins to commit, or just behind the rename."""

    def commit(self, messages):
        if not os.path.exists(f"{os.path.dirname(self.path)}/commits"):
            super().commit(messages)
            open(f"{os.path.dirname(self.path)}/commits", "w").close()
            raise RuntimeError("lost behind the rename")
        raise RuntimeError("lost before the rename")

    def abort(self, messages):
        pass


class StrandedTable(B.BatchTable):
    @classmethod
    def name(cls):
        return "stranded_batches"

    def writer(self, schema, overwrite):
        return Stranded(json.loads(self.options["load"]))


def test_a_lost_driver_neither_loses_nor_doubles_rows(spark, tmp):
    path = f"{tmp}/t"
    for load_id in ("a", "b"):  # a is lost behind its rename, b before it
        with pytest.raises(Exception, match="lost"):
            B.load_batches(rows_of(spark, 30), BINDINGS, path, load_id, target=StrandedTable)
    assert glob.glob(f"{path}/_staging/b-*") and sorted(r.k for r in read_table(spark, path).collect()) == list(range(30))
    assert B.load_batches(rows_of(spark, 30), BINDINGS, path, "a").metrics["already_loaded"]
    assert not B.load_batches(rows_of(spark, 30), BINDINGS, path, "b").metrics["already_loaded"]
    assert sorted(r.k for r in read_table(spark, path).collect()) == sorted([*range(30)] * 2)
    B.clear_staging(path)
    assert glob.glob(f"{path}/_staging*") == [] and read_table(spark, path).count() == 60


def test_attempts_that_were_not_committed_go(spark, tmp):
    path = f"{tmp}/t"
    said = {"path": path, "load_id": "a", "staging": f"{path}/_staging/a-1", "began": 0.0}
    writer = B.BatchWriter(said)
    for attempt in ("part-0-x", "part-0-y"):
        writer.send(pa.record_batch({"k": [1]}), f"{path}/_staging/a-1/{attempt}/batch-0.parquet")
    writer.send(pa.record_batch({"k": [1]}), f"{path}/_staging/a-1/_rejected/part-0-x/batch-1.parquet")
    writer.commit([B.BatchCommit("part-0-y", rows=1, batches=1), None])
    assert [r.k for r in read_table(spark, path).collect()] == [1] and glob.glob(f"{path}/a/_rejected/*") == []
    # Another run of the same load, late: what is there stays.
    late = B.BatchWriter(said | {"staging": f"{path}/_staging/a-2"})
    late.send(pa.record_batch({"k": [2]}), f"{path}/_staging/a-2/part-0-z/batch-0.parquet")
    late.commit([B.BatchCommit("part-0-z", rows=1, batches=1)])
    assert [r.k for r in read_table(spark, path).collect()] == [1] and glob.glob(f"{path}/_staging/*") == []


def test_declared_table_and_empty_load(spark, tmp):
    table = TableSpec.of("t", [("k", "Int64"), ("text", "String"), ("kind", "String", "'new'")], sort_key=["k"])
    none = rows_of(spark, 5).where("k < 0")
    assert B.load_batches(none, BINDINGS, f"{tmp}/t", "none", table=table).metrics["rows"] == 0
    B.load_batches(rows_of(spark, 5), BINDINGS, f"{tmp}/t", "some", table=table)
    assert [tuple(r) for r in read_table(spark, f"{tmp}/t").orderBy("k").collect()] == [(i, "xxx", "new") for i in range(5)]
    for bad in ("", "_a", ".a", "a/b"):
        with pytest.raises(ValueError):
            B.load_batches(none, BINDINGS, f"{tmp}/t", bad)


@given(st.integers(0, 1 << 62), st.integers(0, 1 << 62))
def test_buckets(a, b):
    assert (a <= b) <= (B.bucket_of(a) <= B.bucket_of(b))
    low = B.bucket_floor(B.bucket_of(a))
    assert low <= a <= low * (1 + 1 / 128) and B.bucket_of(low) == B.bucket_of(a)


def test_merged_quantiles(spark):
    rng = random.Random(5)
    values = {name: [int(rng.expovariate(1 / 5000)) for _ in range(n)] for name, n in (("a", 500), ("b", 3), ("c", 40))}
    logs = []
    for name, own in values.items():
        commit = B.BatchCommit()
        for v in own:
            commit.count("us", v)
        logs.append((name, commit.histograms))
    log = spark.createDataFrame(logs, "load_id string, histograms map<string, map<string, long>>")
    every = sorted(sum(values.values(), []))
    row = B.quantiles(log, [0.5, 0.999, 1.0, 0.0]).first()
    assert row.n == len(every)
    for share, got in ((0.5, row.p50), (0.999, row.p99_9), (1.0, row.p100), (0.0, row.p0)):
        exact = every[max(1, -(-int(len(every) * share * 1000) // 1000)) - 1]
        assert got == B.bucket_floor(B.bucket_of(exact))
    assert {r.load_id: r.n for r in B.quantiles(log, [0.5], ["load_id"]).collect()} == {k: len(v) for k, v in values.items()}


def test_simulation_default():
    assert simulate_flush([1, 2], max_rows=NO_LIMIT)[0] == [0, 0]
