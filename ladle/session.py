"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder read from the session (never a machine-local temp dir on a
cluster)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ladle") -> SparkSession:
    """Session for tests and the bench (local mode). On a cluster, build the
    session from the cluster's own config and call :func:`configure`."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("LADLE_DRIVER_MEMORY", "8g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


ARROW_BATCH_BYTES = 64 * 1024 * 1024


def configure(spark: SparkSession, batch_bytes: int = ARROW_BATCH_BYTES) -> SparkSession:
    """Set the session options the loader relies on: UTC everywhere, and an
    Arrow batch byte cap so wide rows cannot make one Python batch huge. A lower
    cap that is set already stays."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        cur = int(str(spark.conf.get(key)).rstrip("bB").rstrip("kKmMgG") or 0)
    except (ValueError, Exception):  # noqa: BLE001 - unparsable / unknown: leave it
        cur = 0
    if cur <= 0 or cur > batch_bytes:
        spark.conf.set(key, str(batch_bytes))
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent (tests, local runs) is a private folder
    created; on a cluster the setting names shared storage.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a shared folder: written tables and stream "
                               "checkpoints must survive the loss of any machine")
        d = tempfile.mkdtemp(prefix="ladle-ckpt-")  # local mode only (tests)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
