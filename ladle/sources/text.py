"""Text sources: lines of (gzip) text files, and delimited-record parsing."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.conform import apply_mode

LINE_COL = "value"


def scan_text_lines(spark: SparkSession, path: str, stream: bool = False,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per line (column ``value``). ``.gz`` files are decompressed by
    the reader (one task per gzip file, as gzip does not split)."""
    if stream:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    return spark.read.text(path)


@dataclass(frozen=True)
class Field:
    """One target field of a delimited record.

    ``kind``: ``date`` (strict yyyy-MM-dd), ``string`` (trimmed),
    ``int_blank_zero`` (trimmed; blank -> 0; else must parse), ``zero`` (constant 0).
    ``index`` is the 0-based field position (unused for ``zero``).
    """

    name: str
    kind: str
    index: int | None = None


def split_fields(line: Column, sep: str = ",") -> Column:
    """Split like Java's ``String.split``: trailing empty fields are dropped."""
    esc = "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep
    trimmed = F.regexp_replace(line, f"({esc})+$", "")
    return F.when(trimmed == "", F.array(F.lit(""))).otherwise(F.split(trimmed, esc, -1))


# Error texts follow the JDK's wording for the same failures (index, number
# and date parsing), so report-mode messages read like the original errors.
def parse_delimited(df: DataFrame, fields: Sequence[Field], line_col: str = LINE_COL, sep: str = ",",
                    mode: str = "strict", keep: Sequence[str] = ()) -> DataFrame:
    """Parse delimited text records into typed columns.

    A missing field or an unparsable value is an error: strict mode raises,
    report mode nulls the value and lists the problem in ``_errors``.
    Staged projections: the line is split once, each field is extracted once,
    and values and errors are derived from those columns.
    """
    keep = list(keep)
    s1 = df.select(*keep, split_fields(F.col(line_col), sep).alias("__parts"))
    s1 = s1.select(*keep, "__parts", F.size("__parts").alias("__n"))
    parsed = [f for f in fields if f.kind != "zero"]
    raws = [F.when(F.col("__n") > F.lit(f.index), F.trim(F.element_at("__parts", f.index + 1))).alias(f"__r{i}")
            for i, f in enumerate(parsed)]
    s2 = s1.select(*keep, "__n", *raws)
    stage = [F.col(k) for k in keep]
    for i, f in enumerate(parsed):
        raw = F.col(f"__r{i}")
        present = F.col("__n") > F.lit(f.index)
        missing = F.when(~present, F.concat(F.lit(f"Index {f.index} out of bounds for length "),
                                            F.col("__n").cast("string")))
        if f.kind == "date":
            v = F.try_to_date(raw, "yyyy-MM-dd")
            bad = F.when(present & v.isNull(), F.concat(F.lit("Text '"), raw, F.lit(f"' could not be parsed for {f.name}")))
        elif f.kind == "string":
            v, bad = raw, F.lit(None).cast("string")
        elif f.kind == "int_blank_zero":
            v = F.when(raw == "", F.lit(0)).otherwise(raw.try_cast("int"))
            bad = F.when(present & v.isNull(), F.concat(F.lit('For input string: "'), raw, F.lit('"')))
        else:
            raise ValueError(f"unknown field kind {f.kind}")
        stage += [v.alias(f"__v{i}"), F.coalesce(missing, bad).alias(f"__e{i}")]
    s3 = s2.select(*stage)
    cols, k = [F.col(c) for c in keep], 0
    for f in fields:
        if f.kind == "zero":
            cols.append(F.lit(0).alias(f.name))
        else:
            cols.append(apply_mode(F.col(f"__v{k}"), F.col(f"__e{k}"), mode).alias(f.name))
            k += 1
    if mode == "report":
        cols.append(F.array_compact(F.array(*[F.col(f"__e{i}") for i in range(len(parsed))])).alias("_errors"))
    return s3.select(*cols)
