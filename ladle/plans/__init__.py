"""Registered operator queries (see :mod:`ladle.plans.registry`)."""

import importlib

MODULES = ["flagship", "batches", "conformance", "projections", "io", "failure_queries", "metric_queries", "rollups", "readbacks"]


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"ladle.plans.{m}")
