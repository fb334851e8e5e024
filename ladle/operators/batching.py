"""Group rows into write batches per writer shard.

Semantics (one writer = one shard, rows in a total order within the shard):

* After each row enters the buffer, while the buffer holds ``>= max_rows`` rows
  or ``>= max_bytes`` bytes, a batch is flushed. A flush takes at most
  ``max_rows`` rows from the head and stops *before* the row that would push the
  batch over ``max_bytes``; a batch that reaches the byte cap exactly is flushed
  with that row. A row above the cap on its own is a batch of its own.
* A timer of ``max_time`` starts when a row enters an empty buffer and no timer
  is pending; when it fires it flushes everything buffered. A size flush does
  not cancel it. On event time, a row at or after the firing instant arrives
  after the flush.
* End of input flushes the rest.

Each row gets ``batch`` (0-based per shard) and ``_first`` (the row opens its
batch). The reason a batch closed is
``rows`` / ``bytes`` (threshold reached; ``bytes`` wins when both hold),
``time`` (timer) or ``end`` (end of input).

Plan: one shuffle by shard, a sort within partitions, then a ``mapInArrow``
fold that keeps O(1) state per shard and steps batch by batch with
``searchsorted`` over prefix sums (Python work per batch, not per row). Rows
never leave their task; wide payload columns pass through Arrow untouched.
Shards should come from a hash of a unique key (see :func:`hash_shard`), so a
hot business key cannot pile up in one task.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.conform import micros_since_epoch

NO_LIMIT = 1 << 62


def hash_shard(keys: Sequence[str | Column], shards: int) -> Column:
    """Writer shard from a hash of (unique) key columns."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.pmod(F.xxhash64(*cols), F.lit(shards)).cast("int")


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def batch_by_count(df: DataFrame, max_rows: int, shard: Column, order: Sequence[str | Column]) -> DataFrame:
    """Consecutive groups of at most ``max_rows`` rows per shard (count limit only).

    One shuffle by shard and a sort inside each shard (the window is
    partitioned by shard, never global).
    """
    w = Window.partitionBy("shard").orderBy(*_cols(order))
    d = df.withColumn("shard", shard)
    rn = F.row_number().over(w) - 1
    return d.withColumn("batch", F.floor(rn / F.lit(max_rows)).cast("bigint"))


# ---------------------------------------------------------------------------
# The flush fold (bytes / rows / time)


def _fold_run(sz, ts, st, max_rows, max_bytes, max_time, batch, close, prev):
    """Fold one shard run (arrays of one shard, in order) from state ``st``.

    ``st`` = [c, b, next_batch, fire] is updated in place: rows and bytes of
    the open batch, the id the next row joins, and the pending timer (None or
    a time in the unit of ``ts``). ``batch``/``close``/``prev`` are filled in.

    Invariant after every row: c < max_rows and b < max_bytes (else the batch
    would have been flushed), so all buffered rows belong to the open batch.
    Hence whole stretches of rows can be assigned at once: the open batch
    takes rows until the first row whose arrival reaches a limit (found with
    ``searchsorted`` on prefix sums). That row either fits (the batch closes
    with it: ``close`` stamp) or overflows the byte cap (the batch closes
    before it and it opens the next one: ``prev`` stamp on it). A timer splits
    the run into segments [anchor, anchor + max_time); at the segment end the
    open batch closes ("time" stamp on the next row) and the next row sets a
    new timer. Python work is per batch and per timer segment, not per row.
    """
    m = len(sz)
    P = np.zeros(m + 1, dtype=np.int64)
    np.cumsum(sz, out=P[1:])
    c, b, bid, fire = st
    use_time = max_time is not None
    i = 0
    while i < m:
        if use_time:
            if fire is not None and ts[i] >= fire:
                if c > 0:
                    prev[i] = "time"
                    bid += 1
                    c = b = 0
                fire = None
            if fire is None and c == 0:
                fire = int(ts[i]) + max_time
            seg_end = int(np.searchsorted(ts, fire, side="left"))
            if seg_end <= i:
                seg_end = i + 1
        else:
            seg_end = m
        j = i
        while j < seg_end:
            k_cnt = j + (max_rows - c) - 1
            target = P[j] + (max_bytes - b)
            k_b = int(np.searchsorted(P, target, side="left")) - 1
            k = min(k_cnt, k_b)
            if k >= seg_end:
                batch[j:seg_end] = bid
                c += seg_end - j
                b += int(P[seg_end] - P[j])
                j = seg_end
                break
            tot = b + int(P[k + 1] - P[j])
            if tot <= max_bytes:
                batch[j:k + 1] = bid
                close[k] = "bytes" if tot >= max_bytes else "rows"
                bid += 1
                c = b = 0
                j = k + 1
            else:
                if k == j and c == 0:
                    # A record above the limit on its own.
                    batch[j] = bid
                    close[j] = "bytes"
                    k += 1
                else:
                    batch[j:k] = bid
                    prev[k] = "bytes"
                bid += 1
                c = b = 0
                j = k
        i = seg_end
    st[0], st[1], st[2], st[3] = c, b, bid, fire


def _segments(shard, batch):
    """Start offsets of (shard, batch) runs in a sorted chunk."""
    m = len(batch)
    change = np.ones(m, dtype=bool)
    change[1:] = (shard[1:] != shard[:-1]) | (batch[1:] != batch[:-1])
    return np.flatnonzero(change)


def _batch_arrays(batch, first, close, prev, shard, bad, complete, next_prev=None, next_shard=None, sz=None):
    """The columns the fold adds, as (name, pyarrow array) pairs.

    Complete mode: every row gets its batch's close reason, badness and
    totals. The last batch of the slice is closed by its own stamp, or by the
    stamp on the row that follows the slice (``next_prev``, same shard), else
    by the end of the shard's input.
    """
    out = [("batch", pa.array(batch, pa.int64())), ("_first", pa.array(first, pa.bool_()))]
    if not complete:
        return out + [("_close", pa.array(close, pa.string())), ("_prev", pa.array(prev, pa.string()))]
    m = len(batch)
    starts = _segments(shard, batch)
    ends = np.append(starts[1:], m)
    reason = np.empty(m, dtype=object)
    batch_bad = np.zeros(m, dtype=np.int32)
    seg_bad = np.maximum.reduceat(bad, starts) if bad is not None else np.zeros(len(starts), dtype=np.int32)
    seg_rows = np.diff(np.append(starts, m)).astype(np.int64)
    seg_bytes = np.add.reduceat(sz, starts).astype(np.int64)
    for i, (a, e) in enumerate(zip(starts, ends)):
        r = close[e - 1]
        if r is None:
            if e < m:
                nxt_prev, nxt_shard = prev[e], shard[e]
            else:
                nxt_prev, nxt_shard = next_prev, next_shard
            if nxt_shard is not None and nxt_shard == shard[a]:
                r = nxt_prev
        reason[a:e] = r if r is not None else "end"
        batch_bad[a:e] = seg_bad[i]
    return out + [("reason", pa.array(reason, pa.string())), ("_batch_bad", pa.array(batch_bad, pa.int32())),
                  ("_batch_rows", pa.array(np.repeat(seg_rows, seg_rows), pa.int64())),
                  ("_batch_bytes", pa.array(np.repeat(seg_bytes, seg_rows), pa.int64()))]


def _attach(rb, added, lo=0, hi=None):
    """``rb`` plus rows [lo, hi) of the added columns (no copy of ``rb``)."""
    hi = rb.num_rows + lo if hi is None else hi
    cols = [rb.column(i) for i in range(rb.num_columns)] + [a.slice(lo, hi - lo) for _, a in added]
    return pa.RecordBatch.from_arrays(cols, names=list(rb.schema.names) + [n for n, _ in added])


def _make_fold(max_rows, max_bytes, max_time, complete=False, bad_col=None):
    """The per-partition fold. In ``complete`` mode the rows of the open batch
    are held (at most ``max_rows`` rows / ``max_bytes`` bytes) and each batch is
    emitted whole, carrying its close reason and whether it holds a bad row."""

    def fold(batches):
        state = {"shard": None, "st": None, "last": -1}
        held = None  # (Arrow slices, batch, first, close, prev, shard, size, bad) of the open batch
        for rb in batches:
            m = rb.num_rows
            if m == 0:
                continue
            shard = rb.column("shard").to_numpy(zero_copy_only=False)
            sz = rb.column("_size").to_numpy(zero_copy_only=False).astype(np.int64)
            ts = (rb.column("_t").to_numpy(zero_copy_only=False).astype(np.int64)
                  if max_time is not None else np.zeros(m, dtype=np.int64))
            bad = (rb.column(bad_col).to_numpy(zero_copy_only=False).astype(np.int32)
                   if bad_col is not None else None)
            batch = np.zeros(m, dtype=np.int64)
            close = np.full(m, None, dtype=object)
            prev = np.full(m, None, dtype=object)
            first = np.zeros(m, dtype=bool)
            cuts = np.flatnonzero(shard[1:] != shard[:-1]) + 1
            for s, e in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [m]))):
                if state["shard"] != shard[s]:
                    state["shard"] = shard[s]
                    state["st"] = [0, 0, 0, None]
                    state["last"] = -1
                out_b = batch[s:e]
                _fold_run(sz[s:e], ts[s:e], state["st"], max_rows, max_bytes, max_time, out_b, close[s:e], prev[s:e])
                first[s] = out_b[0] != state["last"]
                first[s + 1:e] = out_b[1:] != out_b[:-1]
                state["last"] = int(out_b[-1])
            if not complete:
                yield _attach(rb, _batch_arrays(batch, first, close, prev, shard, bad, False))
                continue
            # Complete mode: the open batch's rows are held as zero-copy slices
            # of their Arrow chunks; only the small per-row arrays are joined.
            pieces = [rb]
            if held is not None:
                pieces = held[0] + [rb]
                batch, first, close, prev, shard, sz = (np.concatenate((h, x)) for h, x in zip(
                    held[1:7], (batch, first, close, prev, shard, sz)))
                bad = np.concatenate((held[7], bad)) if bad is not None else None
            n = len(batch)
            # Hold the last batch unless a threshold already closed it on its last row.
            cut = n if close[n - 1] is not None else int(_segments(shard, batch)[-1])
            if cut > 0:
                added = _batch_arrays(batch[:cut], first[:cut], close[:cut], prev[:cut], shard[:cut],
                                      bad[:cut] if bad is not None else None, True,
                                      prev[cut] if cut < n else None, shard[cut] if cut < n else None, sz=sz[:cut])
            off, keep_pieces = 0, []
            for p in pieces:
                lo, hi = off, off + p.num_rows
                if lo < cut:
                    take = min(hi, cut) - lo
                    yield _attach(p.slice(0, take), added, lo, lo + take)
                    if take < p.num_rows:
                        keep_pieces.append(p.slice(take))
                else:
                    keep_pieces.append(p)
                off = hi
            held = None if cut == n else (keep_pieces, batch[cut:], first[cut:], close[cut:], prev[cut:],
                                          shard[cut:], sz[cut:], bad[cut:] if bad is not None else None)
        if held is not None:
            added = _batch_arrays(held[1], held[2], held[3], held[4], held[5], held[7], True, sz=held[6])
            off = 0
            for p in held[0]:
                yield _attach(p, added, off, off + p.num_rows)
                off += p.num_rows

    return fold


def annotate_batches(df: DataFrame, shard: Column, order: Sequence[str | Column], size: Column | None = None,
                     max_rows: int | None = None, max_bytes: int | None = None, ts: Column | None = None,
                     max_time_ms: int | None = None, partitions: int | None = None,
                     keep_helpers: bool = False, complete: bool = False, bad: str | None = None) -> DataFrame:
    """Add ``shard``, ``batch``, ``_first`` and either the close stamps
    ``_close``/``_prev`` (streaming emission) or, with ``complete=True``, the
    per-batch ``reason``, ``_batch_bad`` (max of the int column ``bad``),
    ``_batch_rows`` and ``_batch_bytes`` on every row (see module doc).

    ``shard=None`` makes every input partition one writer that batches its
    rows in arrival order (like parallel sink writers; no shuffle). A shard
    column instead hash-distributes rows to writers and orders each writer's
    rows by ``order`` (one shuffle; batches independent of the input layout).
    ``order`` must give a total order within a shard and, with a time limit,
    start with the event time ``ts``. ``size`` is the per-row byte count.
    ``complete`` holds one open batch per task, so it needs a row or byte limit.
    """
    if complete and max_rows is None and max_bytes is None:
        raise ValueError("complete batches need a row or byte limit (bounded memory)")
    local = shard is None
    d = df.withColumn("shard", F.spark_partition_id() if local else shard.cast("int"))
    d = d.withColumn("_size", F.coalesce((size if size is not None else F.lit(0)).cast("bigint"), F.lit(0)))
    max_time = None
    if max_time_ms is not None:
        if ts is None:
            raise ValueError("time limit needs an event-time column")
        # Rows without an event time sort first and count as arriving at the earliest instant.
        d = d.withColumn("_t", F.coalesce(micros_since_epoch(ts.cast("timestamp_ntz")), F.lit(-(2**62))))
        max_time = int(max_time_ms) * 1000
    if local:
        # One writer per input partition, rows in arrival (read) order: no
        # exchange at all. A time limit orders each partition by event time.
        if order:
            d = d.sortWithinPartitions(*_cols(order))
    else:
        # Without an explicit count AQE may coalesce small shard partitions
        # (several shards per task are fine: the fold resets per shard run).
        d = (d.repartition(partitions, "shard") if partitions else d.repartition("shard"))
        d = d.sortWithinPartitions("shard", *_cols(order))
    extra = [T.StructField("batch", T.LongType(), False), T.StructField("_first", T.BooleanType(), False)]
    if complete:
        extra += [T.StructField("reason", T.StringType(), True), T.StructField("_batch_bad", T.IntegerType(), False),
                  T.StructField("_batch_rows", T.LongType(), False), T.StructField("_batch_bytes", T.LongType(), False)]
    else:
        extra += [T.StructField("_close", T.StringType(), True), T.StructField("_prev", T.StringType(), True)]
    schema = T.StructType(d.schema.fields + extra)
    out = d.mapInArrow(_make_fold(max_rows or NO_LIMIT, max_bytes or NO_LIMIT, max_time, complete, bad), schema)
    if not keep_helpers and max_time is not None:
        out = out.drop("_t")
    return out


def batch_summary(annotated: DataFrame, extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per (shard, batch): rows, bytes, and the reason it closed.

    With complete batches the reason is on every row. Otherwise it is on the
    batch's last row, or on the next batch's first row (overflow / timer),
    else the batch ended with the input.
    """
    if "reason" in annotated.columns:
        return annotated.groupBy("shard", "batch").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("_size").alias("n_bytes"), F.max("reason").alias("reason"),
            *extra_aggs)
    per = annotated.groupBy("shard", "batch").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("_size").alias("n_bytes"),
        F.max("_close").alias("_close"),
        F.max("_prev").alias("_prev"),
        *extra_aggs,
    )
    w = Window.partitionBy("shard").orderBy("batch")
    reason = F.coalesce(F.col("_close"), F.lead("_prev").over(w), F.lit("end"))
    return per.withColumn("reason", reason).drop("_close", "_prev")


def count_batch_summary(batched: DataFrame, max_rows: int, extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """Per-batch summary after :func:`batch_by_count` (full batch -> rows, last partial -> end)."""
    per = batched.groupBy("shard", "batch").agg(F.count(F.lit(1)).alias("n_rows"), *extra_aggs)
    return per.withColumn("reason", F.when(F.col("n_rows") >= max_rows, F.lit("rows")).otherwise(F.lit("end")))


def reject_oversized(df: DataFrame, size: Column | str, max_record_bytes: int,
                     mode: str = "strict") -> tuple[DataFrame, DataFrame | None]:
    """Rows larger than ``max_record_bytes`` (equal is allowed).

    strict: ``size`` must name a column the rest of the plan consumes; it is
    rewritten in place to raise on the first oversized row (a projection: a
    filter would be pushed below, and re-run, the casts). report: return
    (ok rows, rejected rows).
    """
    c = F.col(size) if isinstance(size, str) else size
    if mode == "strict":
        name = size if isinstance(size, str) else c._jc.toString()
        if name not in df.columns:
            raise ValueError("strict record check needs the size as an existing column")
        msg = F.concat(F.lit("Record of "), c.cast("string"),
                       F.lit(f" bytes exceeds the record limit of {max_record_bytes} bytes"))
        return df.withColumn(name, F.when(c > F.lit(max_record_bytes), F.raise_error(msg)).otherwise(c)), None
    return df.where(c <= F.lit(max_record_bytes)), df.where(c > F.lit(max_record_bytes))


def simulate_flush(sizes, times=None, max_rows=NO_LIMIT, max_bytes=NO_LIMIT, max_time=None):
    """Row-at-a-time reference of the writer's flush rules (small inputs, tests).

    Returns (batch ids, per-batch reasons)."""
    c = b = 0
    bid = 0
    fire = None
    out, reasons = [], {}
    for i, sz in enumerate(sizes):
        t = times[i] if times is not None else 0
        if max_time is not None and fire is not None and t >= fire:
            if c > 0:
                reasons[bid] = "time"
                bid += 1
                c = b = 0
            fire = None
        if max_time is not None and fire is None and c == 0:
            fire = t + max_time
        if c > 0 and b + sz > max_bytes:
            reasons[bid] = "bytes"
            bid += 1
            c, b = 1, sz
        else:
            c, b = c + 1, b + sz
        out.append(bid)
        if c >= max_rows or b >= max_bytes:
            reasons[bid] = "bytes" if b >= max_bytes else "rows"
            bid += 1
            c = b = 0
    if c > 0:
        reasons[bid] = "end"
    return out, reasons
