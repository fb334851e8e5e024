"""Column names that don't clash with those of a user's table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores behind it until ``df`` has no such column (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(name: str) -> Column:
    """The column of exactly that name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def every(df: DataFrame) -> list[Column]:
    return [named(c) for c in df.columns]
