"""ladle: typed, batched, failure-aware table loading on Spark.

Declare how source columns bind to typed target columns; ladle turns the
bindings into checked Spark column expressions, groups rows into batches by
count, bytes and time per writer shard, applies a failure policy, writes the
result in batch or through Structured Streaming, and reports load metrics.
All row work runs on executors as DataFrame expressions.
"""

from ladle.functions.types import TargetType, parse_type
from ladle.operators.bindings import Binding, TableSpec, bind_columns, of
from ladle.operators.failures import RetryPolicy
from ladle.sinks.table import LoadOptions, LoadResult, load, load_raw
from ladle.streaming.stream import stream_load

__all__ = ["TargetType", "parse_type", "Binding", "TableSpec", "bind_columns", "of", "RetryPolicy", "LoadOptions",
           "LoadResult", "load", "load_raw", "stream_load"]
