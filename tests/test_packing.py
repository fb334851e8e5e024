"""Batches formed by many tasks against the row-at-a-time simulation."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ladle.operators.batching import NO_LIMIT, simulate_flush
from ladle.operators.packing import chunk_summary, pack_batches, packed_summary, through

SIZES = st.lists(st.one_of(st.integers(0, 30), st.just(0), st.integers(20, 300)), min_size=0, max_size=90)


def open_state(sizes, max_rows, max_bytes):
    """(rows, bytes, number) of the batch open behind ``sizes``, row by row."""
    rows = held = batch = 0
    for size in sizes:
        if rows and held + size > max_bytes:
            rows, held, batch = 0, 0, batch + 1
        rows, held = rows + 1, held + size
        if rows >= max_rows or held >= max_bytes:
            rows, held, batch = 0, 0, batch + 1
    return rows, held, batch


@settings(max_examples=500, deadline=None)
@given(SIZES, SIZES, st.one_of(st.integers(1, 9), st.just(NO_LIMIT)), st.one_of(st.integers(1, 150), st.just(NO_LIMIT)))
def test_a_chunk_leads_from_any_open_batch_to_the_next(before, sizes, max_rows, max_bytes):
    upto, ends = chunk_summary(np.array(sizes, np.int64), max_rows, max_bytes, True)
    got = through(open_state(before, max_rows, max_bytes), len(sizes), sum(sizes), upto, ends, max_rows, max_bytes)
    assert got == open_state(before + sizes, max_rows, max_bytes)


@pytest.mark.parametrize("max_rows, max_bytes", [(7, None), (None, 300), (7, 300), (1, None), (None, 1)])
@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_one_stream_over_many_tasks(spark, max_rows, max_bytes, partitions):
    rows = [(i, (i * 37) % 90 + (700 if i % 41 == 5 else 0) if i % 13 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, sz long").repartition(5)
    packed = pack_batches(df, None, ["k"], F.col("sz"), max_rows, max_bytes, partitions)
    batches, reasons = simulate_flush([s or 0 for _, s in rows], max_rows=max_rows or NO_LIMIT, max_bytes=max_bytes or NO_LIMIT)
    assert [r.batch for r in packed.orderBy("k").collect()] == batches
    assert {r.batch: r.reason for r in packed_summary(packed, max_rows, max_bytes).collect()} == reasons


def test_many_streams(spark):
    """Streams that fill many chunks, and chunks that hold many streams."""
    rows = [(s, i, (i * 31 + (s or 0)) % 70) for s, n in ((0, 400), (1, 3), (2, 1), (7, 90), (None, 60)) for i in range(n)] + [(s, 0, 5) for s in range(100, 160)]
    df = spark.createDataFrame(rows, "s long, k long, sz long").repartition(4)
    packed = pack_batches(df, F.col("s"), ["k"], F.col("sz"), 9, 200, 6)
    got = {}
    for r in packed.orderBy("k").collect():
        got.setdefault(r.shard, []).append(r.batch)
    want = {s: simulate_flush([z for o, _, z in rows if o == s], max_rows=9, max_bytes=200)[0] for s in {r[0] for r in rows}}
    assert got == want


def test_nothing_and_no_limit(spark):
    empty = spark.createDataFrame([], "k long, sz long")
    assert pack_batches(empty, None, ["k"], F.col("sz"), 5).collect() == []
    with pytest.raises(ValueError):
        pack_batches(empty, None, ["k"])
