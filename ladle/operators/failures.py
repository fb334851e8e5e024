"""Failure handling: error classification, corrupt rows, batch policies, retry.

Error classification works on a load log where each error is an ordered
cause chain ``causes: array<struct<kind, code, retryable, message>>`` (outer
exception first). ``kind`` is one of ``server``, ``connect``,
``socket_timeout``, ``io`` or ``other``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Server error codes that mean the batch's data is corrupt.
CORRUPTION_CODES = (6, 27, 33, 38, 41, 72, 117)
# I/O messages treated as transient. The first two must start
# the message; the others may appear anywhere in it.
RETRIABLE_PREFIXES = ("Read timed out after", "Write timed out after")
RETRIABLE_PARTS = ("Insert failed", "Connection reset by peer", "Broken pipe", "Connection timed out")

RETRIABLE, CORRUPTION, FATAL = "retriable", "corruption", "fatal"


def root_cause(causes: Column) -> Column:
    """First server error in the cause chain, else the deepest cause."""
    servers = F.filter(causes, lambda c: c["kind"] == "server")
    return F.when(F.size(servers) > 0, servers[0]).otherwise(F.element_at(causes, -1))


def classify(causes: Column) -> Column:
    """retriable / corruption / fatal for a cause chain (pure column expression)."""
    r = root_cause(causes)
    kind, code, retry, msg = r["kind"], r["code"], r["retryable"], r["message"]
    io_retriable = None
    for p in RETRIABLE_PREFIXES:
        cond = msg.startswith(p)
        io_retriable = cond if io_retriable is None else io_retriable | cond
    for p in RETRIABLE_PARTS:
        io_retriable = io_retriable | msg.contains(p)
    return (F.when(kind == "server", F.when(retry, F.lit(RETRIABLE))
                   .when(code.isin(*CORRUPTION_CODES), F.lit(CORRUPTION)).otherwise(F.lit(FATAL)))
            .when(kind.isin("connect", "socket_timeout"), F.lit(RETRIABLE))
            .when((kind == "io") & msg.isNotNull() & io_retriable, F.lit(RETRIABLE))
            .otherwise(F.lit(FATAL)))


def classify_message(message: str | None, kind: str = "io") -> str:
    """Driver-side twin of :func:`classify` for one exception (used by the retry loop)."""
    if kind in ("connect", "socket_timeout"):
        return RETRIABLE
    if kind == "io" and message is not None:
        if any(message.startswith(p) for p in RETRIABLE_PREFIXES) or any(p in message for p in RETRIABLE_PARTS):
            return RETRIABLE
    return FATAL


#: Java exception classes that mean the connection failed, whatever their message.
CONNECT_CLASSES = {"ConnectException", "NoRouteToHostException", "UnknownHostException", "SocketException"}
TIMEOUT_CLASSES = {"SocketTimeoutException"}
IO_CLASSES = {"IOException", "EOFException", "InterruptedIOException", "HttpHostConnectException", "NoHttpResponseException"}


def classify_exception(error: BaseException) -> str:
    """RETRIABLE or FATAL for an exception of a write, by its root cause's class first and its message second.

    Only errors of the connection are worth another try. What a user's data or
    code raised (failed casts, ``raise_error``, Python errors in tasks) is fatal,
    whatever text the data put into the message.
    """
    java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    if java is not None:
        return _classify_java(java)
    seen: set[int] = set()
    while error.__cause__ is not None and id(error) not in seen:
        seen.add(id(error))
        error = error.__cause__
    if isinstance(error, (ConnectionError, TimeoutError)):
        return RETRIABLE
    if type(error) is OSError:  # a plain I/O error; its subclasses for files and the like are not the connection's
        return classify_message(str(error))
    return FATAL


def _classify_java(error) -> str:
    root, depth = error, 0
    while root.getCause() is not None and depth < 50:
        root, depth = root.getCause(), depth + 1
    name = root.getClass().getSimpleName()
    if name in CONNECT_CLASSES:
        return RETRIABLE
    if name in TIMEOUT_CLASSES:
        return classify_message(root.getMessage(), "socket_timeout")
    if name in IO_CLASSES:
        return classify_message(root.getMessage())
    return FATAL


def mark_bad(df: DataFrame, errors_col: str = "_errors") -> DataFrame:
    """``_bad`` = the row has at least one conformance error."""
    return df.withColumn("_bad", (F.size(F.col(errors_col)) > 0).cast("int"))


def flag_corrupt_batches(annotated: DataFrame, bad_col: str = "_bad") -> DataFrame:
    """``_batch_bad`` = 1 on every row of a batch that holds a bad row.

    The window is partitioned by (shard, batch): the fold's output is already
    hash-partitioned by shard, so no new exchange is needed.
    """
    w = Window.partitionBy("shard", "batch")
    return annotated.withColumn("_batch_bad", F.max(F.col(bad_col)).over(w))


def drop_corrupt_batches(annotated: DataFrame, bad_col: str = "_bad") -> DataFrame:
    """Drop every batch that holds a bad row; the others are kept whole.

    Batches emitted whole by the fold (``complete=True``) already carry
    ``_batch_bad``, so this is a plain filter; otherwise a window per batch.
    """
    flagged = annotated if "_batch_bad" in annotated.columns else flag_corrupt_batches(annotated, bad_col)
    return flagged.where(F.col("_batch_bad") == 0).drop("_batch_bad")


STOP_MESSAGE = "Corrupt row in batch"


def stop_on_corrupt(df: DataFrame, bad_col: str = "_bad", message: str = STOP_MESSAGE) -> DataFrame:
    """Fail the job at the first bad row (default policy).

    A projection, not a filter: a filter would be pushed below the casts and
    make Spark evaluate them twice. Every output column carries the check, so
    whichever of them is read, it can't be pruned away; a plain count of the
    rows reads the check through a generated column, which can't either.
    """
    bad = F.col(bad_col) == 1
    checked = df.select(*[F.when(bad, F.raise_error(F.lit(message))).otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])
    generated = F.explode(F.array(F.col(bad_col))).alias("__checked")
    return checked.select("*", generated).where(F.col("__checked").isNull() | (F.col("__checked") >= 0)).drop("__checked")


def error_rows(df: DataFrame, errors_col: str = "_errors") -> DataFrame:
    """Rows with at least one error, with the checks evaluated once.

    A plain ``where(size(_errors) > 0)`` is pushed below the parsing and cast
    projections with their expressions inlined, so the whole parse runs again
    inside the filter. Filtering on a generated column cannot be pushed below
    the generator (``explode_outer`` also adds no inferred pre-filter).
    """
    first = F.explode_outer(F.slice(F.col(errors_col), 1, 1)).alias("__first_error")
    return df.select("*", first).where(F.col("__first_error").isNotNull()).drop("__first_error")


@dataclass(frozen=True)
class RetryPolicy:
    """``forever()`` or ``limited(n)``: n retries after the first try (n >= 0)."""

    max_retries: int | None = None

    @staticmethod
    def forever() -> "RetryPolicy":
        return RetryPolicy(None)

    @staticmethod
    def limited(n: int) -> "RetryPolicy":
        if n < 0:
            raise ValueError("maxRetries must be >= 0")
        return RetryPolicy(n)

    def allows(self, attempt: int) -> bool:
        """attempt counts from 1 (the first try)."""
        return self.max_retries is None or attempt <= self.max_retries + 1


class RetriesExhausted(RuntimeError):
    pass


class BatchTimeout(TimeoutError):
    """A batch write ran longer than its request timeout (retriable when the
    policy says so)."""


def run_with_timeout(write: Callable[[], None], timeout_s: float | None, spark=None) -> None:
    """Run one batch write; past ``timeout_s`` seconds cancel its Spark jobs
    (job group) and raise :class:`BatchTimeout`."""
    if not timeout_s:
        write()
        return
    import threading
    import uuid

    group = f"ladle-batch-{uuid.uuid4().hex[:12]}"
    err: list[BaseException] = []

    def target():
        try:
            if spark is not None:
                spark.sparkContext.setJobGroup(group, "ladle batch write", interruptOnCancel=True)
            write()
        except BaseException as e:  # noqa: BLE001 - re-raised in the caller
            err.append(e)

    t = threading.Thread(target=target, daemon=True)
    t.start()
    t.join(timeout_s)
    if t.is_alive():
        if spark is not None:
            spark.sparkContext.cancelJobGroup(group)
        t.join()  # an old write must be over before another one starts
        raise BatchTimeout(f"Batch write exceeded its request timeout of {timeout_s} s")
    if err:
        raise err[0]


def retry_batch(write: Callable[[], None], policy: RetryPolicy,
                classify_exc: Callable[[BaseException], str] | None = None,
                on_retry: Callable[[int, BaseException], None] | None = None,
                sleep_s: float = 1.0, timeout_s: float | None = None, on_timeout: str = "fail",
                spark=None) -> int:
    """Run ``write`` (one batch) until it succeeds; transient errors are retried
    as the policy allows, others re-raised at once. Returns the attempts used.

    ``sleep_s`` is the pause before the second try; it doubles up to a minute.

    ``timeout_s`` bounds each attempt; a timed-out attempt fails the load
    (``on_timeout="fail"``) or is retried (``"retry"``).

    Spark already retries failed *tasks*; this loop covers a failed batch
    commit (e.g. inside ``foreachBatch``), which Spark does not retry.
    """
    if on_timeout not in ("fail", "retry"):
        raise ValueError("on_timeout must be 'fail' or 'retry'")
    base = classify_exc or classify_exception

    def kind(e: BaseException) -> str:
        if isinstance(e, BatchTimeout):
            return RETRIABLE if on_timeout == "retry" else FATAL
        return base(e)

    attempt = 1
    while True:
        try:
            run_with_timeout(write, timeout_s, spark)
            return attempt
        except Exception as e:  # noqa: BLE001
            if kind(e) != RETRIABLE:
                raise
            if not policy.allows(attempt + 1):
                raise RetriesExhausted(f"Batch failed after {attempt} attempts") from e
            if on_retry:
                on_retry(attempt, e)
            attempt += 1
            if sleep_s:
                time.sleep(min(60.0, sleep_s * 2 ** min(attempt - 2, 6)))  # longer each time, up to a minute
