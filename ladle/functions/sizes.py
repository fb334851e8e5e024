"""Payload sizes as Column expressions (used by the byte limits and metrics).

Sizes follow the row binary layout of a typed row: fixed-width numbers,
length-prefixed (unsigned LEB128 varint) strings, one marker byte per
nullable value, and a count prefix for arrays and maps. A raw text row is
the byte length of its normalized line.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.functions.types import FIXED_WIDTH, TargetType, parse_type


def varint_len(n: Column) -> Column:
    """Bytes of the unsigned LEB128 encoding of n (n >= 0)."""
    return (F.when(n < 1 << 7, 1).when(n < 1 << 14, 2).when(n < 1 << 21, 3)
            .when(n < 1 << 28, 4).when(n < 1 << 35, 5).otherwise(6))


def varint_len_py(n: int) -> int:
    k = 1
    while n >= 128:
        n >>= 7
        k += 1
    return k


def decimal_width(precision: int) -> int:
    return 4 if precision <= 9 else 8 if precision <= 18 else 16 if precision <= 38 else 32


def value_bytes(c: Column, t: TargetType | str) -> Column:
    """Encoded size of one (already conformed) value, including the null marker."""
    t = parse_type(t)
    n = t.name
    if n in FIXED_WIDTH:
        body = F.lit(FIXED_WIDTH[n])
    elif n == "Decimal":
        body = F.lit(decimal_width(t.precision))
    elif n == "FixedString":
        body = F.lit(t.size)
    elif n in ("String", "JSON"):
        ln = F.octet_length(c.cast("string"))
        body = varint_len(ln) + ln
    elif n == "Array":
        et = t.args[0]
        body = varint_len(F.size(c)) + F.aggregate(c, F.lit(0).cast("bigint"),
                                                   lambda acc, x: acc + value_bytes(x, et).cast("bigint"))
    elif n == "Map":
        kt, vt = t.args
        body = varint_len(F.size(c)) + F.aggregate(
            F.map_entries(c), F.lit(0).cast("bigint"),
            lambda acc, e: acc + value_bytes(e["key"], kt).cast("bigint") + value_bytes(e["value"], vt).cast("bigint"))
    elif n == "Tuple":
        parts = [value_bytes(c.getField(f"_{i + 1}"), a) for i, a in enumerate(t.args)]
        body = parts[0]
        for p in parts[1:]:
            body = body + p
    else:
        raise ValueError(f"No size rule for {n}")
    if t.nullable:
        return F.when(c.isNull(), F.lit(1)).otherwise(body + 1)
    return body


def row_payload_bytes(columns: Sequence[tuple[str, TargetType | str]]) -> Column:
    """Encoded size of a typed row: the sum over its target columns."""
    total = None
    for name, t in columns:
        v = value_bytes(F.col(name), t).cast("bigint")
        total = v if total is None else total + v
    return total


def header_bytes(columns: Sequence[tuple[str, TargetType | str]]) -> int:
    """Size of the names-and-types header sent once per batch (driver constant)."""
    cols = [(n, parse_type(t).ddl()) for n, t in columns]
    size = varint_len_py(len(cols))
    for n, decl in cols:
        nb, tb = len(n.encode()), len(decl.encode())
        size += varint_len_py(nb) + nb + varint_len_py(tb) + tb
    return size


def normalize_raw_line(c: Column) -> Column:
    """Raw text payload: NULL stays NULL, '' stays '', else ends with one newline."""
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(c == "", F.lit(""))
            .when(c.endswith("\n"), c)
            .otherwise(F.concat(c, F.lit("\n"))))


def raw_payload_bytes(c: Column) -> Column:
    """Bytes of the normalized line, computed without building it (no text copy)."""
    n = F.octet_length(c)
    return F.when(c.isNull(), F.lit(None)).when(c.endswith("\n") | (n == 0), n).otherwise(n + 1)
