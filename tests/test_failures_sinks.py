"""Failure policies, retry, options and guards, sinks and streaming."""

import os

import pytest
from pyspark.sql import functions as F

from ladle.operators.bindings import TableSpec, bind_columns, default_for_omitted, of
from ladle.operators.failures import (
    FATAL,
    RETRIABLE,
    RetriesExhausted,
    RetryPolicy,
    classify_message,
    drop_corrupt_batches,
    mark_bad,
    retry_batch,
    stop_on_corrupt,
)
from ladle.operators.batching import annotate_batches
from ladle.functions.types import UnsupportedTypeError
from ladle.sinks.table import LoadOptions, SchemaDriftError, load, load_raw, preflight, read_table
from ladle.streaming.stream import file_stream, read_loaded, stream_load


@pytest.mark.parametrize("msg,expected", [
    ("Read timed out after 30000 ms", RETRIABLE), ("Write timed out after 1 s", RETRIABLE),
    ("Code: 1. Insert failed due to x", RETRIABLE), ("recv: Connection reset by peer", RETRIABLE),
    ("Broken pipe (Write failed)", RETRIABLE), ("connect: Connection timed out", RETRIABLE),
    ("x Read timed out after 3 s", FATAL), ("Unknown table", FATAL), (None, FATAL),
])
def test_classify_message(msg, expected):
    assert classify_message(msg) == expected


def test_retry_policies():
    with pytest.raises(ValueError):
        RetryPolicy.limited(-1)
    calls = {"n": 0}

    def flaky(k):
        def w():
            calls["n"] += 1
            if calls["n"] < k:
                raise IOError("Broken pipe")
        return w

    assert retry_batch(flaky(5), RetryPolicy.forever(), sleep_s=0.0) == 5
    calls["n"] = 0
    with pytest.raises(RetriesExhausted):
        retry_batch(flaky(10), RetryPolicy.limited(2), sleep_s=0.0)
    assert calls["n"] == 3  # first try + 2 retries
    calls["n"] = 0
    assert retry_batch(flaky(1), RetryPolicy.limited(0), sleep_s=0.0) == 1

    def fatal():
        raise IOError("Table does not exist")
    with pytest.raises(IOError):
        retry_batch(fatal, RetryPolicy.forever())


def test_stop_and_drop_policies(spark):
    df = spark.createDataFrame([(i, "x" if i == 7 else str(i)) for i in range(20)], "k long, v string")
    typed = mark_bad(bind_columns(df, [of("k", "k", "Int64"), of("v", "v", "Int32")], mode="report"))
    with pytest.raises(Exception, match="Corrupt row"):
        stop_on_corrupt(typed).collect()
    ann = annotate_batches(typed, F.lit(0), ["k"], max_rows=5)
    kept = sorted(r.k for r in drop_corrupt_batches(ann).collect())
    assert kept == [k for k in range(20) if not 5 <= k < 10]


def test_options_validation():
    LoadOptions().validate()
    for bad in (dict(max_batch_size=0), dict(max_buffered=100, max_batch_size=100),
                dict(max_batch_bytes=10, max_record_bytes=20), dict(failure="ignore")):
        with pytest.raises(ValueError):
            LoadOptions(**bad).validate()


def test_guards(spark, tmp):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="reserved"):
        bind_columns(df, [of("a", "__ladle_raw__", "Int32")])
    with pytest.raises(UnsupportedTypeError):
        bind_columns(df, [of("a", "e", "Enum8('x' = 1)")])
    with pytest.raises(FileNotFoundError):
        preflight(spark, os.path.join(tmp, "nope"), must_exist=True)


def test_load_metrics_and_drift(spark, tmp):
    path = os.path.join(tmp, "t")
    df = spark.range(1234).select(F.col("id").alias("k"), (F.col("id") * 2).cast("string").alias("s"))
    res = load(df, [of("k", "k", "Int64"), of("s", "s", "String")], path,
               LoadOptions(shards=3, max_batch_size=100, batch_metrics=True), order=["k"])
    assert res.metrics["records_sent"] == 1234 and res.metrics["dropped_records"] == 0
    assert res.metrics["requests"] >= 13  # sum over shards of ceil(rows / 100)
    assert res.metrics["flushes_by_rows"] + res.metrics["flushes_at_end"] == res.metrics["requests"]
    assert res.metrics["rows_per_batch_max"] == 100 and res.metrics["retries"] == 0
    assert res.metrics["requests_submitted"] == res.metrics["requests"]
    assert res.metrics["bytes_per_batch_min"] > 0 and res.metrics["write_seconds"] > 0
    assert read_table(spark, path).count() == 1234
    with pytest.raises(SchemaDriftError):
        load(df, [of("k", "k", "Int32")], path, order=["k"])


def test_drop_batch_load(spark, tmp):
    path = os.path.join(tmp, "t")
    df = spark.createDataFrame([(i, "bad" if i == 3 else str(i)) for i in range(1000)], "k long, v string")
    res = load(df, [of("k", "k", "Int64"), of("v", "v", "Int32")], path,
               LoadOptions(max_batch_size=100, failure="drop_batch", shards=1), order=["k"])
    assert res.metrics["dropped_batches"] == 1 and res.metrics["dropped_records"] == 100
    assert read_table(spark, path).count() == 900


def test_raw_csv_sent_as_json_drops_everything(spark, tmp):
    spec = TableSpec.of("t", [("date", "Date"), ("location_key", "String"), ("value", "Int32")])
    lines = spark.createDataFrame([(f"2020-01-01,loc_{i:02d},100",) for i in range(50)], "value string")
    res = load_raw(lines, spec, os.path.join(tmp, "j"), "json",
                   LoadOptions(max_batch_size=25, failure="drop_batch", shards=1))
    assert res.metrics["records_sent"] == 0 and res.metrics["dropped_records"] == 50
    mixed = spark.createDataFrame([(f"2020-01-0{1 + i % 9},loc_{i:02d},{'100' if i < 25 else 'not_a_number'}",)
                                   for i in range(50)], "value string")
    p2 = os.path.join(tmp, "c")
    load_raw(mixed, spec, p2, "csv", LoadOptions(max_batch_size=25, failure="drop_batch", shards=1))
    assert read_table(spark, p2).count() == 25


def test_defaults_and_null(spark):
    spec = TableSpec.of("t", [("id", "Int32"), ("extra_col", "String", "'omg'"),
                              ("status", "Nullable(Int32)", "99")])
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, status int")
    out = default_for_omitted(bind_columns(df, [of("id", "id", "Int32"), of("status", "status", "Nullable(Int32)")]),
                              spec).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "omg", None), (2, "omg", 5)]


def test_stream_restart_no_loss(spark, tmp, monkeypatch):
    src = os.path.join(tmp, "in")
    spark.range(200).select(F.col("id").alias("k")).repartition(5).write.parquet(src)
    schema = spark.read.parquet(src).schema
    out, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")
    b = [of("k", "k", "Int64")]

    from ladle.streaming import stream as module

    whole = module.batch_writer

    def crashing(*args):
        own = whole(*args)

        def write(df, batch_id):
            own(df, batch_id)
            if batch_id == 2:
                raise RuntimeError("boom")

        return write

    with monkeypatch.context() as m, pytest.raises(Exception, match="boom"):
        m.setattr(module, "batch_writer", crashing)
        stream_load(file_stream(spark, src, schema, 1), b, out, ckpt)
    from ladle.streaming.stream import StreamLoadReport

    rep = StreamLoadReport()
    stream_load(file_stream(spark, src, schema, 1), b, out, ckpt, report=rep)
    got = sorted(r.k for r in read_loaded(spark, out).collect())
    assert got == list(range(200))
    # the replayed micro-batch (2) and the rest were loaded by the restarted query
    assert min(rep.batches) == 2 and rep.totals()["records_sent"] == sum(
        1 for r in read_loaded(spark, out).where("_batch_id >= 2").collect())


def test_partition_local_writers_need_no_shuffle(spark, tmp):
    """Default load: each input partition is one writer, batching in arrival order."""
    df = spark.range(0, 1000, numPartitions=2).select(F.col("id").alias("k"))
    from ladle.sinks.table import prepare

    ann = prepare(df, [of("k", "k", "Int64")], LoadOptions(max_batch_size=100, batch_metrics=True), ["k"])
    plan = ann._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    res = load(df, [of("k", "k", "Int64")], os.path.join(tmp, "t"), LoadOptions(max_batch_size=100, batch_metrics=True), order=["k"])
    assert res.metrics["requests"] == 10 and res.metrics["flushes_by_rows"] == 10
    assert read_table(spark, os.path.join(tmp, "t")).count() == 1000


def test_backlog_guards_and_writer_options(spark, tmp):
    from ladle.sinks.table import BacklogModeError

    backlog = os.path.join(tmp, "backlog")
    spark.createDataFrame([("1,alpha",), ("2,beta",)], "value string").write.parquet(backlog)
    typed = spark.createDataFrame([(1, "alpha")], "id int, name string")
    b = [of("id", "id", "Int32"), of("name", "name", "String")]
    with pytest.raises(BacklogModeError):
        load(typed, b, backlog, order=["id"])
    spec = TableSpec.of("t", [("id", "Int32"), ("name", "String")])
    with pytest.raises(BacklogModeError):
        load_raw(typed, spec, os.path.join(tmp, "x"))
    # drain the backlog through a raw load into a typed table
    out = os.path.join(tmp, "drained")
    load_raw(spark.read.parquet(backlog), spec, out, "csv")
    assert sorted(tuple(r) for r in read_table(spark, out).collect()) == [(1, "alpha"), (2, "beta")]
    with pytest.raises(FileNotFoundError):
        load(typed, b, os.path.join(tmp, "missing"), LoadOptions(require_table=True), order=["id"])
    js = os.path.join(tmp, "as_json")
    load(typed, b, js, LoadOptions(target_format="json", writer_options={"compression": "gzip"}), order=["id"])
    assert spark.read.json(js).count() == 1


def test_batch_timeout_fails_or_retries(spark, tmp):
    import time as _t

    from ladle.operators.failures import BatchTimeout

    calls = {"n": 0}

    def slow_then_fast():
        calls["n"] += 1
        if calls["n"] == 1:
            # a Spark job that outlives the timeout: it is cancelled
            spark.range(0, 8, numPartitions=8).rdd.map(lambda x: _t.sleep(5) or x).count()

    with pytest.raises(BatchTimeout):
        retry_batch(slow_then_fast, RetryPolicy.forever(), timeout_s=1.0, spark=spark)
    calls["n"] = 0
    assert retry_batch(slow_then_fast, RetryPolicy.limited(1), timeout_s=1.0, on_timeout="retry", spark=spark) == 2


def test_drop_batch_plan_has_one_shuffle(spark):
    """Whole batches from the fold: the drop policy adds no exchange of its own."""
    from ladle.sinks.table import prepare

    df = spark.range(0, 1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    b = [of("k", "k", "Int64"), of("v", "v", "Int32")]
    hashed = prepare(df, b, LoadOptions(failure="drop_batch", shards=4), ["k"]).where("_batch_bad = 0")
    assert hashed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    local = prepare(df, b, LoadOptions(failure="drop_batch"), ["k"]).where("_batch_bad = 0")
    assert "Exchange" not in local._jdf.queryExecution().executedPlan().toString()


def test_writers_do_not_follow_the_size(spark, tmp):
    """Ten times the table: the same writer for each key, and the same shares of rows."""
    from ladle.operators.batching import hash_shard

    with pytest.raises(ValueError, match="shards"):
        LoadOptions(shards="auto").validate()
    df = spark.range(0, 500).select(F.col("id").alias("k"))
    ten = df.crossJoin(spark.range(10).select(F.col("id").alias("copy")))
    once = {r.k: r.s for r in df.select("k", hash_shard(["k"], 16).alias("s")).collect()}
    assert all(once[r.k] == r.s for r in ten.select("k", hash_shard(["k"], 16).alias("s")).distinct().collect())


def test_stop_check_survives_pruning(spark):
    df = spark.createDataFrame([(i, "x" if i == 7 else str(i), "c") for i in range(20)], "k long, v string, c string")
    typed = mark_bad(bind_columns(df, [of("k", "k", "Int64"), of("v", "v", "Int32"), of("c", "c", "String")], mode="report"))
    for read in (lambda d: d.select("c").collect(), lambda d: d.select("k").collect(), lambda d: d.count(), lambda d: d.groupBy("c").count().collect()):
        with pytest.raises(Exception, match="Corrupt row"):
            read(stop_on_corrupt(typed))
    assert stop_on_corrupt(typed.where("k > 7")).count() == 12


def test_streams_and_batch_loads_share_a_table(spark, tmp):
    """Two streams with checkpoints of their own, then a batch load: all rows stay."""
    b, out = [of("k", "k", "Int64")], os.path.join(tmp, "out")
    for name, first in (("a", 0), ("b", 10)):
        src = os.path.join(tmp, name)
        spark.range(first, first + 10).select(F.col("id").alias("k")).repartition(2).write.parquet(src)
        stream_load(file_stream(spark, src, spark.read.parquet(src).schema, 1), b, out, os.path.join(tmp, f"ckpt-{name}"))
    load(spark.range(20, 23).select(F.col("id").alias("k")), b, out)
    assert sorted(r.k for r in read_loaded(spark, out).collect()) == list(range(23))
    assert sorted(r.k for r in read_table(spark, out).collect()) == list(range(23))
    with pytest.raises(SchemaDriftError):
        load(spark.range(3).select(F.col("id").alias("k")), [of("k", "k", "String")], out)


def test_undeclared_columns_and_catalog_tables(spark, tmp):
    from ladle.operators.bindings import TableSpec
    from ladle.sinks.table import UnknownColumnError

    spec = TableSpec.of("t", [("a", "Int32")])
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(UnknownColumnError, match="b"):
        load(df, [of("a", "a", "Int32"), of("b", "b", "Int32")], os.path.join(tmp, "t"), table=spec)
    with pytest.raises(SchemaDriftError, match="a"):
        load(df, [of("a", "a", "String")], os.path.join(tmp, "t"), table=spec)
    options = LoadOptions(target_format="table", writer_options={"path": os.path.join(tmp, "managed")})
    with pytest.raises(FileNotFoundError):
        preflight(spark, "ladle_test_table", must_exist=True, attempts=1, options=options)
    try:
        for _ in range(2):
            load(df, [of("a", "a", "Int32"), of("b", "b", "Int32")], "ladle_test_table", options)
        assert sorted(map(tuple, spark.table("ladle_test_table").collect())) == [(1, 2), (1, 2)]
        with pytest.raises(UnknownColumnError, match="a2"):
            load(df, [of("a", "a2", "Int32"), of("b", "b", "Int32")], "ladle_test_table", options)
    finally:
        spark.sql("DROP TABLE IF EXISTS ladle_test_table")


def test_load_without_batches_stays_in_the_jvm(spark, tmp):
    from ladle.sinks.table import prepare

    df = spark.range(100).select(F.col("id").alias("k"))
    plan = prepare(df, [of("k", "k", "Int64")], LoadOptions(), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
    res = load(df, [of("k", "k", "Int64")], os.path.join(tmp, "t"))
    assert res.metrics["records_sent"] == 100 and res.metrics["bytes_sent"] == 800 and res.metrics["dropped_records"] == 0


def test_hot_key_spreads_over_writers(spark):
    """A business key holding a third of all rows does not pile up in one writer:
    writers come from a hash of the unique key."""
    from ladle.operators.batching import annotate_batches, hash_shard

    n = 30000
    df = spark.range(n).select(F.col("id").alias("line"),
                               F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("orderkey"))
    ann = annotate_batches(df, hash_shard(["orderkey", "line"], 8), ["orderkey", "line"], size=F.lit(10),
                           max_rows=500, complete=True)
    per = [r["count"] for r in ann.groupBy("shard").count().collect()]
    assert len(per) == 8 and max(per) < 1.3 * n / 8


def test_empty_inputs(spark, tmp):
    empty = spark.createDataFrame([], "k long, v string")
    b = [of("k", "k", "Int64"), of("v", "v", "String")]
    res = load(empty, b, os.path.join(tmp, "e"), LoadOptions(shards=4, batch_metrics=True), order=["k"])
    assert res.metrics["records_sent"] == 0 and res.metrics["requests"] == 0
    res2 = load(empty, b, os.path.join(tmp, "e2"), order=["k"])
    assert res2.metrics["records_sent"] == 0
    spec = TableSpec.of("t", [("k", "Int64"), ("v", "String")])
    assert load_raw(spark.createDataFrame([], "value string"), spec, os.path.join(tmp, "r"), "csv").metrics[
        "records_sent"] == 0
    from ladle.operators.batching import annotate_batches, batch_summary

    assert batch_summary(annotate_batches(empty, F.lit(0), ["k"], max_rows=5, complete=True)).count() == 0


def test_classify_random_cause_chains(spark):
    import random

    from pyspark.sql import types as T

    from ladle.operators.failures import CORRUPTION_CODES, classify

    rng = random.Random(29)
    kinds = ["server", "connect", "socket_timeout", "io", "other"]
    msgs = [None, "Read timed out after 1 s", "x Read timed out after", "Write timed out after 2",
            "Insert failed: y", "a Connection reset by peer", "Broken pipe", "Connection timed out!", "boom"]

    def model(chain):
        servers = [c for c in chain if c[0] == "server"]
        kind, code, retry, msg = servers[0] if servers else chain[-1]
        if kind == "server":
            return "retriable" if retry else "corruption" if code in CORRUPTION_CODES else "fatal"
        if kind in ("connect", "socket_timeout"):
            return "retriable"
        if kind == "io" and msg is not None and (
                msg.startswith("Read timed out after") or msg.startswith("Write timed out after")
                or any(p in msg for p in ("Insert failed", "Connection reset by peer", "Broken pipe",
                                          "Connection timed out"))):
            return "retriable"
        return "fatal"

    chains = [[(rng.choice(kinds), rng.choice([6, 27, 60, 117, 252, None]), rng.random() < 0.3, rng.choice(msgs))
               for _ in range(rng.randint(1, 4))] for _ in range(400)]
    cause = T.StructType([T.StructField("kind", T.StringType()), T.StructField("code", T.IntegerType()),
                          T.StructField("retryable", T.BooleanType()), T.StructField("message", T.StringType())])
    df = spark.createDataFrame([(i, c) for i, c in enumerate(chains)],
                               T.StructType([T.StructField("i", T.IntegerType()),
                                             T.StructField("causes", T.ArrayType(cause))]))
    got = {r.i: r.cat for r in df.select("i", classify(F.col("causes")).alias("cat")).collect()}
    assert all(got[i] == model(c) for i, c in enumerate(chains))


def test_load_with_event_time_limit(spark, tmp):
    """Time flushes through load(): one writer, rows in event-time order."""
    from ladle.operators.batching import simulate_flush

    rows = [(i, i * 700, (i * 13) % 40 + 1) for i in range(300)]  # 0.7 s apart
    df = spark.createDataFrame(rows, "k long, t long, n int").withColumn(
        "ts", F.timestamp_seconds(F.col("t") / 1000).cast("timestamp_ntz")).drop("t").coalesce(1)
    b = [of("k", "k", "Int64"), of("ts", "ts", "DateTime64(3)"), of("n", "n", "Int32")]
    res = load(df, b, os.path.join(tmp, "t"), LoadOptions(max_batch_size=20, max_time_in_buffer_ms=5000, batch_metrics=True),
               order=["k"], event_time="ts")
    sizes = [8 + 8 + 4] * len(rows)
    _, reasons = simulate_flush(sizes, [r[1] * 1000 for r in rows], 20, 5 * 1024 * 1024, 5000 * 1000)
    by = {"rows": 0, "bytes": 0, "time": 0, "end": 0}
    for r in reasons.values():
        by[r] += 1
    m = res.metrics
    assert (m["flushes_by_rows"], m["flushes_by_time"], m["flushes_at_end"]) == (by["rows"], by["time"], by["end"])
    assert m["requests"] == len(reasons) and m["records_sent"] == 300


def test_data_text_never_decides_a_retry(spark, tmp):
    """A value that reads like a broken connection is the data's fault; a real one is tried again."""
    from ladle.operators.bindings import TableSpec
    from ladle.operators.failures import FATAL, RETRIABLE, classify_exception

    spec = TableSpec.of("t", [("id", "Int32")])
    lines = spark.createDataFrame([("Broken pipe",), ("Connection reset by peer",)], "value string")
    with pytest.raises(Exception, match="Cannot convert"):
        load_raw(lines, spec, os.path.join(tmp, "t"), "csv", LoadOptions(retry=RetryPolicy.forever()))
    try:
        spark.range(1).select(F.raise_error(F.lit("Broken pipe"))).collect()
    except Exception as e:
        assert classify_exception(e) == FATAL
    jvm = spark._jvm
    wrapped = jvm.java.lang.RuntimeException("x", jvm.java.net.ConnectException("refused"))
    assert classify_exception(type("E", (Exception,), {"java_exception": wrapped})()) == RETRIABLE
    data = jvm.java.lang.RuntimeException("Broken pipe", jvm.java.lang.NumberFormatException("Broken pipe"))
    assert classify_exception(type("E", (Exception,), {"java_exception": data})()) == FATAL
    reset = jvm.java.lang.RuntimeException("x", jvm.java.io.IOException("Connection reset by peer"))
    assert classify_exception(type("E", (Exception,), {"java_exception": reset})()) == RETRIABLE
