"""Batches of one writer's stream, formed by many tasks.

Each writer (shard) sends its rows in order; a batch takes rows until ``max_rows`` or
``max_bytes`` is reached, by the rules of :mod:`ladle.operators.batching`. Where a batch
ends depends on where the last one did, back to the stream's first row; yet a long
stream needn't pass one task:

1. Rows are range-partitioned and sorted by (shard, order) and kept (``checkpoint``),
   so a partition is a *chunk* of the streams, whatever is recomputed.
2. A batch that is open when a chunk begins ends within its first few rows (no more than fit
   a batch), and all that follows depends on that place only. So each chunk says, for every
   such place, what batch is open at its end and how many batches were closed: one small row.
3. Those rows, in order, lead from one chunk's open batch to the next one's.
4. Each chunk then numbers its own batches from the open one it begins with.

The streams are sorted once, and read twice. Only a chunk's first stream can have begun in another
chunk, so what is handed around is a row or two per chunk, however many shards there are.

Edge cases: a null shard is a shard of its own (the first); a null size is 0 bytes; a row above
``max_bytes`` is a batch of its own; without rows there are no batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators.batching import NO_LIMIT, _fold_run
from ladle.session import ensure_checkpoint_dir

#: Stands for a null shard, which sorts first.
NULL_SHARD = -(1 << 62)
SUMMARY = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("first", T.BooleanType()), T.StructField("shard", T.LongType()),
                        T.StructField("bytes", T.BinaryType()), T.StructField("ends", T.BinaryType())])


def next_starts(upto: np.ndarray, max_rows: int, max_bytes: int) -> np.ndarray:
    """For each row the one that opens the batch behind a batch it opens; -1 if the batch is still open at the end.

    ``upto`` are the running bytes, with a 0 in front.
    """
    n = len(upto) - 1
    at = np.arange(n)
    reached = np.searchsorted(upto, upto[:-1] + max_bytes, side="left")
    exact = upto[np.minimum(reached, n)] == upto[:-1] + max_bytes
    by_bytes = np.where(exact, reached, np.maximum(reached - 1, at + 1))
    by_bytes[reached > n] = n + 1
    # A row above the limit that ends the chunk is closed by itself.
    found = np.minimum(by_bytes, at + max_rows)
    return np.where(found <= n, found, -1)


def chunk_summary(sizes: np.ndarray, max_rows: int, max_bytes: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """The running bytes of a chunk's first rows, and for each row among them that may open a batch the chunk's end:
    rows and bytes of the batch open there, and how many batches were closed on the way.

    Without ``whole`` only for its first row.
    """
    n, upto = len(sizes), np.concatenate(([0], np.cumsum(sizes)))
    follow = next_starts(upto, max_rows, max_bytes)
    last = min(n, max_rows, int(np.searchsorted(upto, max_bytes, side="left"))) if whole else 0
    starts = np.arange(last + 1)
    closed = np.zeros(last + 1, np.int64)
    moving = np.flatnonzero(starts < n)
    while len(moving):
        then = follow[starts[moving]]
        on = then >= 0
        moving = moving[on]
        starts[moving] = then[on]
        closed[moving] += 1
        moving = moving[starts[moving] < n]
    ends = np.stack((n - starts, upto[n] - upto[starts], closed))
    return upto[:last + 1].astype("<i8"), ends.astype("<i8")


def through(state: tuple[int, int, int], n_rows: int, n_bytes: int, upto: np.ndarray, ends: np.ndarray, max_rows: int, max_bytes: int) -> tuple[int, int, int]:
    """(rows, bytes, number) of the batch open behind a chunk, from those of the one open before it."""
    rows, held, batch = state
    if rows == 0:
        return int(ends[0, 0]), int(ends[1, 0]), batch + int(ends[2, 0])
    reached = int(np.searchsorted(upto, max_bytes - held, side="left"))
    by_bytes = n_rows + 1
    if reached < len(upto):
        by_bytes = reached if upto[reached] == max_bytes - held else reached - 1
    elif n_bytes > max_bytes - held:
        by_bytes = len(upto) - 1
    cut = min(by_bytes, max_rows - rows)
    if cut > n_rows:
        return rows + n_rows, held + n_bytes, batch
    return int(ends[0, cut]), int(ends[1, cut]), batch + 1 + int(ends[2, cut])


def _runs(shard: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
    return list(zip(cuts[:-1], cuts[1:]))


def pack_batches(df: DataFrame, shard: Column | None, order: Sequence[str], size: Column | None = None, max_rows: int | None = None,
                 max_bytes: int | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` with ``shard`` (a whole number; 0 if none is given), ``_size`` and ``batch``, its batch's number in the shard from 0.

    ``order`` must be a total order within a shard. ``partitions`` is the number of chunks
    (the session's shuffle partitions if not given).
    """
    if max_rows is None and max_bytes is None:
        raise ValueError("batches need a row or a byte limit")
    spark, most_rows, most_bytes = df.sparkSession, max_rows or NO_LIMIT, max_bytes or NO_LIMIT
    ensure_checkpoint_dir(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = df.withColumn("shard", F.coalesce((F.lit(0) if shard is None else shard).cast("bigint"), F.lit(NULL_SHARD))).withColumn(
        "_size", F.coalesce((F.lit(0) if size is None else size).cast("bigint"), F.lit(0)))
    chunks = named.repartitionByRange(partitions, "shard", *order).sortWithinPartitions("shard", *order).withColumn("_chunk", F.spark_partition_id())
    chunks = chunks.checkpoint()

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in rows.columns] for rows in batches if rows.num_rows]
        if not parts:
            return
        chunk, shards, sizes = (np.concatenate(x) for x in zip(*parts))
        runs = _runs(shards)
        out = []
        for a, b in runs[:1] + runs[1:][-1:]:
            upto, ends = chunk_summary(sizes[a:b], most_rows, most_bytes, a == 0)
            out.append((int(chunk[0]), a == 0, int(shards[a]), np.concatenate(([b - a, int(sizes[a:b].sum())], upto)).astype("<i8").tobytes(), ends.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()))], names=SUMMARY.fieldNames())

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, out = None, (0, 0, 0), []
        for rows in batches:
            for chunk, first, of, raw, packed in zip(*(c.to_pylist() for c in rows.columns)):
                if of != current:
                    current, state = of, (0, 0, 0)
                if first:
                    out.append((chunk, *state))
                head = np.frombuffer(raw, "<i8")
                state = through(state, int(head[0]), int(head[1]), head[2:], np.frombuffer(packed, "<i8").reshape(3, -1), most_rows, most_bytes)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["chunk", "rows", "bytes", "batch"])

    # At most two rows per chunk.
    summaries = chunks.select("_chunk", "shard", "_size").mapInArrow(summarize, SUMMARY)
    entries = summaries.coalesce(1).sortWithinPartitions("chunk", F.desc("first")).mapInArrow(lead, "chunk int, rows long, bytes long, batch long")
    entry = {r.chunk: (r.rows, r.bytes, r.batch) for r in entries.collect()}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for rows in batches:
            if not rows.num_rows:
                continue
            shards, sizes = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "_size"))
            if state is None:
                state, current = [*entry[rows.column("_chunk")[0].as_py()], None], int(shards[0])
            batch, marks = np.zeros(len(shards), np.int64), np.full(len(shards), None, object)
            for a, b in _runs(shards):
                if shards[a] != current:
                    state, current = [0, 0, 0, None], int(shards[a])
                _fold_run(sizes[a:b], sizes[a:b], state, most_rows, most_bytes, None, batch[a:b], marks[a:b], marks[a:b])
            columns = [c for name, c in zip(rows.schema.names, rows.columns) if name != "_chunk"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(batch)], names=[*(n for n in rows.schema.names if n != "_chunk"), "batch"])

    schema = T.StructType([f for f in chunks.schema.fields if f.name != "_chunk"] + [T.StructField("batch", T.LongType(), False)])
    numbered = chunks.mapInArrow(number, schema)
    return numbered.withColumn("shard", F.when(F.col("shard") != NULL_SHARD, F.col("shard")))


def packed_summary(packed: DataFrame, max_rows: int | None = None, max_bytes: int | None = None, extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per (shard, batch): rows, bytes, and why it closed (``bytes``, ``rows``, or ``end`` of the stream)."""
    per = packed.groupBy("shard", "batch").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_size").alias("n_bytes"), *extra_aggs)
    last = per.groupBy(F.col("shard").alias("_of")).agg(F.max("batch").alias("_last"))
    found = per.join(last, F.col("shard").eqNullSafe(F.col("_of")))
    reason = F.when(F.col("n_bytes") >= (max_bytes or NO_LIMIT), "bytes").when(F.col("n_rows") >= (max_rows or NO_LIMIT), "rows").when(
        F.col("batch") == F.col("_last"), "end").otherwise("bytes")
    return found.withColumn("reason", reason).drop("_of", "_last")
