"""Batch annotation on a stream: the flush fold as a stateful streaming operator.

``applyInPandasWithState`` keyed by writer shard carries each shard's O(1)
buffer state (rows, bytes, next batch id, pending timer, last batch) from one
micro-batch to the next, so batch ids and close stamps on a stream equal the
batch result on the same ordered input. Only one shard's rows of one
micro-batch are in memory at a time (bounded by ``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger``). Rows must reach each shard in order (event time
first) across micro-batches, as a writer receives them.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ladle.functions.conform import micros_since_epoch
from ladle.operators.batching import NO_LIMIT, _fold_run

STATE_SCHEMA = "c long, b long, bid long, fire long, has_fire boolean, last long"


def stream_annotate_batches(stream: DataFrame, shard: Column, order: Sequence[str], size: Column,
                            max_rows: int | None = None, max_bytes: int | None = None, ts: Column | None = None,
                            max_time_ms: int | None = None) -> DataFrame:
    """Add ``shard``, ``batch``, ``_first``, ``_close``, ``_prev`` to a streaming
    DataFrame (same meaning as :func:`ladle.operators.batching.annotate_batches`)."""
    d = stream.withColumn("shard", shard.cast("int")).withColumn("_size", size.cast("bigint"))
    max_time = None
    if max_time_ms is not None:
        d = d.withColumn("_t", micros_since_epoch(ts.cast("timestamp_ntz")))
        max_time = int(max_time_ms) * 1000
    n_rows, n_bytes = max_rows or NO_LIMIT, max_bytes or NO_LIMIT
    out_schema = T.StructType(d.schema.fields + [
        T.StructField("batch", T.LongType()), T.StructField("_first", T.BooleanType()),
        T.StructField("_close", T.StringType()), T.StructField("_prev", T.StringType())])
    order = list(order)

    def step(key, pdfs, state):
        if state.exists:
            c, b, bid, fire, has_fire, last = state.get
            st = [int(c), int(b), int(bid), int(fire) if has_fire else None]
        else:
            st, last = [0, 0, 0, None], -1
        pdf = pd.concat(list(pdfs), ignore_index=True)
        if len(pdf):
            pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
            m = len(pdf)
            sz = pdf["_size"].to_numpy(dtype=np.int64)
            tt = pdf["_t"].to_numpy(dtype=np.int64) if max_time is not None else np.zeros(m, dtype=np.int64)
            batch = np.zeros(m, dtype=np.int64)
            close = np.full(m, None, dtype=object)
            prev = np.full(m, None, dtype=object)
            _fold_run(sz, tt, st, n_rows, n_bytes, max_time, batch, close, prev)
            first = np.empty(m, dtype=bool)
            first[0] = batch[0] != last
            first[1:] = batch[1:] != batch[:-1]
            last = int(batch[-1])
            pdf = pdf.assign(batch=batch, _first=first, _close=close, _prev=prev)
            yield pdf
        state.update((st[0], st[1], st[2], st[3] if st[3] is not None else 0, st[3] is not None, last))

    return d.groupBy("shard").applyInPandasWithState(step, out_schema, STATE_SCHEMA, "append",
                                                      GroupStateTimeout.NoTimeout)
