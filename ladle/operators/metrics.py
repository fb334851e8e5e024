"""Load metrics as aggregates over batch-annotated rows or a load log.

Counters: records and bytes sent (payload + one header per batch), requests
(batches), dropped batches and records, flushes by reason. Distributions:
rows and bytes per batch, and a latency window of the last N samples.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASONS = ("rows", "bytes", "time", "end")


def load_metrics(annotated: DataFrame, header_bytes: int) -> DataFrame:
    """The same counters as :func:`observed_load_metrics`, as a one-row DataFrame."""
    return annotated.agg(*observed_load_metrics(header_bytes))


def observed_load_metrics(header_bytes: int) -> list:
    """Aggregates for ``DataFrame.observe`` over complete-batch rows (with
    ``_first``, ``reason``, ``_batch_bad``, ``_size``): the load's counters,
    gathered during the write itself (no second pass)."""
    kept = F.col("_batch_bad") == 0
    first = F.col("_first")
    out = [
        F.count_if(kept).cast("bigint").alias("records_sent"),
        (F.coalesce(F.sum(F.when(kept, F.col("_size"))), F.lit(0)) + F.count_if(first & kept) * F.lit(header_bytes))
        .cast("bigint").alias("bytes_sent"),
        F.count_if(first).cast("bigint").alias("requests"),
        F.count_if(first & ~kept).cast("bigint").alias("dropped_batches"),
        F.count_if(~kept).cast("bigint").alias("dropped_records"),
    ]
    names = {"rows": "flushes_by_rows", "bytes": "flushes_by_bytes", "time": "flushes_by_time", "end": "flushes_at_end"}
    out += [F.count_if(first & (F.col("reason") == r)).cast("bigint").alias(n) for r, n in names.items()]
    # Batch-size distributions (rows and bytes per batch), read on each batch's first row.
    for col, name in (("_batch_rows", "rows_per_batch"), ("_batch_bytes", "bytes_per_batch")):
        v = F.when(first, F.col(col))
        out += [F.min(v).alias(f"{name}_min"), F.avg(v).alias(f"{name}_avg"), F.max(v).alias(f"{name}_max"),
                F.percentile_approx(v, 0.5).alias(f"{name}_p50"), F.percentile_approx(v, 0.99).alias(f"{name}_p99")]
    return out


def sent_metrics() -> list:
    """The counters of a load that forms no batches: rows and payload bytes sent, none dropped."""
    return [F.count(F.lit(1)).cast("bigint").alias("records_sent"), F.coalesce(F.sum("_size"), F.lit(0)).cast("bigint").alias("bytes_sent"),
            F.coalesce(F.sum(F.lit(0)), F.lit(0)).cast("bigint").alias("dropped_records"),
            F.coalesce(F.sum(F.lit(0)), F.lit(0)).cast("bigint").alias("dropped_batches")]


def flush_reason_counts(summary: DataFrame) -> DataFrame:
    """Flushes by reason (each flush counted once)."""
    return summary.groupBy("reason").agg(F.count(F.lit(1)).cast("bigint").alias("flushes"))


def batch_distribution(summary: DataFrame, by: Sequence[str] = ("shard",)) -> DataFrame:
    """Rows and bytes per batch: min / avg / max / median / p99 per group."""
    aggs = []
    for c, name in (("n_rows", "rows"), ("n_bytes", "bytes")):
        aggs += [F.min(c).cast("bigint").alias(f"min_{name}"), F.max(c).cast("bigint").alias(f"max_{name}"),
                 F.avg(c).alias(f"avg_{name}"), F.median(c).alias(f"median_{name}")]
    return summary.groupBy(*by).agg(F.count(F.lit(1)).cast("bigint").alias("batches"), *aggs)


def latency_window(log: DataFrame, value: str, order: Sequence[str], window: int = 1000) -> DataFrame:
    """Statistics of the last ``window`` samples (newest by ``order``).

    The window is a top-k (per-partition top-k, then a bounded merge), never a
    global sort. Filter the log first for one histogram (e.g. failures).
    """
    last = log.orderBy(*[F.col(o).desc() for o in order]).limit(window)
    return last.agg(*_stats(value))


def _stats(value: str):
    return [F.count(F.lit(1)).cast("bigint").alias("samples"), F.min(value).alias("min"), F.max(value).alias("max"),
            F.avg(value).alias("mean"), F.percentile(value, 0.5).alias("p50"),
            F.percentile(value, 0.99).alias("p99")]


def send_time(log: DataFrame, send: str, ack: str, by: Sequence[str] = ()) -> DataFrame:
    """Last ack minus its send time (the gauge keeps the latest request)."""
    return log.groupBy(*by).agg(F.max_by(F.col(ack) - F.col(send), F.col(ack)).alias("send_time"))
