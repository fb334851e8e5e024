"""From documents to token ids: quality, near copies, secrets, mixture, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it as
Parquet under the session's shared folder and reads it back for the next one, so a
lost executor costs a stage's tasks, not the stages before. All stages but the last
keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import bytebpe, lines, mixing, nearcopies, secrets
from ladle.llm.queries import TARGETS
from ladle.plans.registry import scratch_path, table
from ladle.session import configure

#: Bytes of rows handed to a Python worker at once. Executors go from stage to stage with a heap that has grown to its
#: full size, so what a batch takes beside it, in the executor and in each worker, is kept small.
BATCH_BYTES = 4 * 1024 * 1024


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or hold mostly boilerplate lines go."""
    configure(spark, BATCH_BYTES)
    return lines.keep(docs, lines.fit(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies stays, the one of the least id."""
    configure(spark, BATCH_BYTES)
    return nearcopies.keep_one(docs, scratch_path(spark, "pipeline-copies"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text."""
    folder = scratch_path(spark, "pipeline-secrets")
    clean = secrets.redact(docs, f"{folder}/ledger", work=f"{folder}/work")
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target shares of domains ask for."""
    return mixing.mixed(docs, mixing.label_domains(table(spark, sf_dir, "labels")), TARGETS, scratch_path(spark, "pipeline-mixture"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each document."""
    configure(spark, BATCH_BYTES)
    coded = bytebpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality rules", quality), ("near copies", near_copies), ("secrets", no_secrets), ("mixture", mixture), ("token ids", token_ids)]
#: The stages' classifiers, hashes and tokenizer are beyond SQL; tests hold the rows of run() on a small folder against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
