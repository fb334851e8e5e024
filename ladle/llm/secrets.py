r"""Secret scans over a ledger of blobs, in DataFrame operations only.

Every text is addressed by its SHA-256. The ledger (a Parquet folder) holds the
findings of each (blob, rule version) ever scanned. A scan takes the blobs that
the ledger lacks, reads one text of each, appends what it finds, and joins the
findings back to every row whose text has that address; a second scan of the same
history reads no text through the rules. The version follows the rules: others, or a
new version's, scan all blobs again.

Positions: Spark's regular expressions give the matches and the pieces between
them (``regexp_extract_all``, ``split``); adding up their lengths gives starts and
ends in code points, end exclusive.

Edge cases: a null text is the empty text, which has no findings; null keys and
repeated rows are kept, each with its findings; texts that match nothing have an
empty array; an empty table gives an empty result; other columns are dropped by
``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.names import every, named, unused


@dataclass(frozen=True)
class Rule:
    """``pattern`` in Java's syntax; with ``least``, a match counts if its group ``group`` has that many characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules. A run of hexadecimal digits or an access key is
# maximal, so its least length can stand in the pattern.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "2"
SPAN = "struct<start:int,rule:int,end:int>"
#: Entries that are appended to one array; longer ones are put together from such blocks.
BLOCK = 64
MARK = "[secret]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(rows: Column) -> Column:
    """An array in pieces of ``BLOCK`` entries."""
    numbers = F.when(F.size(rows) > 0, F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda i: F.slice(rows, i * BLOCK + 1, BLOCK))


def _running(rows: Column, add: Callable[[Column, Column], Column], step: Callable[[Column, Column], Column], kind: str) -> Column:
    """What ``step`` appends to its state (at, out) over all rows; ``add`` tells how ``at`` moves on by a row.

    Appending copies an array, so it is done block by block, each from the ``at`` before it.
    """
    empty = F.array().cast(f"array<{kind}>")

    def block(blocks: Column) -> Column:
        before = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda s, block: F.struct(
            F.aggregate(block, s["at"], add).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), before.alias("before")), lambda x: F.aggregate(
            x["block"], F.struct(x["before"].alias("at"), empty.alias("out")), step, lambda s: s["out"])))

    return _let(_blocks(rows), block)


def spans_of(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text, an array of (start, number of the rule, end), in that order."""

    def of(number: int, rule: Rule) -> Column:
        def size(array: Column) -> Column:
            return F.transform(array, lambda x: F.length(x))

        def zipped(matches: Column) -> Column:
            pieces = size(F.split(text, rule.pattern, -1))
            counted = size(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))) if rule.least else size(matches)
            return F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("gap"), size(matches).alias("size"), counted.alias("counted"))

        def step(s: Column, x: Column) -> Column:
            start = s["at"] + x["gap"]
            span = F.struct(start.alias("start"), F.lit(number).alias("rule"), (start + x["size"]).alias("end"))
            return F.struct((start + x["size"]).alias("at"), F.when(x["counted"] >= rule.least, F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

        rows = _let(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), zipped)
        found = _let(rows, lambda rows: _running(rows, lambda at, x: at + x["gap"] + x["size"], step, SPAN))
        return F.when(F.coalesce(text, F.lit("")).rlike(rule.pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))

    return F.array_sort(F.concat(*[of(i, rule) for i, rule in enumerate(rules)]))


def version_of(rules: tuple[Rule, ...], version: str = RULE_VERSION) -> str:
    """A version that no other rules have."""
    return f"{version}-{hashlib.sha256(repr(rules).encode()).hexdigest()[:16]}"


def scan(docs: DataFrame, ledger: str, *, rules: tuple[Rule, ...] = RULES, version: str = RULE_VERSION, text: str = "text",
         key: str = "doc_id", work: str) -> DataFrame:
    """(key, blob_id, spans) of each row of ``docs``; ``ledger`` gains what it lacked.

    ``ledger`` and ``work`` are folders that all workers share; ``work`` must be new.
    """
    spark, version = docs.sparkSession, version_of(rules, version)
    rows = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text")).withColumn("blob_id", F.sha2("text", 256))
    rows.select("key", "blob_id").write.parquet(f"{work}/history")
    history = spark.read.parquet(f"{work}/history")
    known = spark.createDataFrame([], f"blob_id string, version string, spans array<{SPAN}>")
    if _exists(spark, ledger):
        known = spark.read.parquet(ledger)
    unseen = history.groupBy("blob_id").agg(F.min("key").alias("first_key")).join(
        known.where(F.col("version") == version).select("blob_id"), "blob_id", "left_anti").withColumnRenamed("blob_id", "unseen_id")
    # One text of each unseen blob; rows that agree in key and text leave one entry.
    texts = rows.join(unseen.hint("shuffle_hash"), F.col("key").eqNullSafe(F.col("first_key")) & (F.col("blob_id") == F.col("unseen_id")), "left_semi")
    texts.select("blob_id", F.lit(version).alias("version"), spans_of(F.col("text"), rules).alias("spans")).dropDuplicates(
        ["blob_id"]).write.mode("append").parquet(ledger)
    # Two scans at the same time may both add a blob, with the same findings.
    findings = spark.read.parquet(ledger).where(F.col("version") == version).select("blob_id", "spans").distinct()
    return history.join(findings, "blob_id").select(F.col("key").alias(key), "blob_id", "spans")


def _exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def written(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = MARK) -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""

    def step(s: Column, x: Column) -> Column:
        piece = F.struct(s["at"].alias("start"), x["start"].alias("end"))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(piece))).otherwise(s["out"]).alias("out"))

    def cut(block: Column) -> Column:
        """The pieces of a block, from the stretch of text that holds them."""
        first = F.get(block, F.lit(0))["start"]
        stretch = F.substring(text, first + 1, F.element_at(block, F.lit(-1))["end"] - first)
        return _let(stretch, lambda held: F.transform(block, lambda x: F.concat(F.substring(held, x["start"] - first + 1, x["end"] - x["start"]), F.lit(mark))))

    pieces = _running(spans, lambda at, x: F.greatest(at, x["end"]), step, "struct<start:int,end:int>")
    before = F.array_join(F.flatten(_let(pieces, lambda held: _let(_blocks(held), lambda blocks: F.transform(blocks, cut)))), "")
    tail = F.substring(text, F.array_max(F.transform(spans, lambda x: x["end"])) + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(before, tail)).otherwise(text)


def redact(docs: DataFrame, ledger: str, *, text: str = "text", key: str = "doc_id", work: str) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by a mark; all columns and rows are kept, null texts too.

    Rows and findings meet by the text's address, and only rows with findings are
    joined again.
    """
    found = scan(docs, ledger, text=text, key=key, work=work).where(F.size("spans") > 0).select("blob_id", "spans").dropDuplicates(["blob_id"])
    blob, spans = unused(docs, "blob_id", "spans")
    joined = docs.withColumn(blob, F.sha2(docs[text], 256)).join(found.select(F.col("blob_id").alias(blob), F.col("spans").alias(spans)), blob, "left")
    return joined.withColumn(text, redacted(named(text), F.coalesce(F.col(spans), F.array().cast(f"array<{SPAN}>")))).select(*every(docs))
