"""Registry of the operator queries exposed by ``__spark_entry__``.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` that reads the given
tables and runs one operator over them, plus (where SQL can express it) an
equivalent DuckDB SQL string used as the correctness oracle.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ladle.session import checkpoint_dir, configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.__module__ = fn.__module__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "ladle-tables", f"{what}-{uuid.uuid4().hex[:12]}")
