"""Streaming rollups: each micro-batch adds its partial rollup to the table.

A micro-batch writes the rollup of its own rows only, to a folder of its own
(``_stream=<stream>/_batch_id=<id>``, overwritten if it is replayed), so the cost
of a micro-batch follows the micro-batch and not the table, and the result is
exactly once. Readers merge the partials: every rollup function keeps what it needs
to merge again (see :mod:`ladle.operators.rollup`). Several streams may feed one
table, one after another or together.

``compact_in_place`` merges what came since the last snapshot into it: a new folder, and a
manifest that says which partials it covers (of each stream, those up to a micro-batch).
Readers take the newest snapshot and the partials it doesn't cover, or an older snapshot by
its number; streams go on meanwhile, and a covered micro-batch that is replayed stays covered.
``expire_snapshots`` deletes what no kept snapshot needs. ``compact_rollup`` writes the merged table elsewhere.
"""

from __future__ import annotations

import json
import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from ladle.operators.rollup import remerge, rollup
from ladle.streaming.stream import BATCH_COL, STREAM_COL, batch_folder, stream_id

SNAPSHOT, MANIFEST = "_snapshot", "_covers.json"
SPEC_FILE = "_ladle_rollup.json"


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, SPEC_FILE))
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def rollup_spec(spark: SparkSession, path: str) -> tuple[list[str], list[tuple[str, str, str | None]]] | None:
    """Key and functions of a rollup table, None if there is none."""
    p, fs = _file(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    try:
        found = json.loads(source.readLine())
    finally:
        source.close()
    return found["key"], [tuple(s) for s in found["specs"]]


def _keep_spec(spark: SparkSession, path: str, key: Sequence[str], specs: Sequence[tuple[str, str, str | None]]) -> None:
    own = list(key), [tuple(s) for s in specs]
    there = rollup_spec(spark, path)
    if there is not None and there != own:
        raise ValueError(f"The rollup table {path} has another key or other functions: {there}")
    if there is None:
        p, fs = _file(spark, path)
        out = fs.create(p, False)
        out.writeBytes(json.dumps({"key": own[0], "specs": own[1]}) + "\n")
        out.close()


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _partials(spark: SparkSession, path: str) -> dict[tuple[str, int], str]:
    """The folder of each stream's micro-batch that was written whole."""
    out = {}
    for stream in _listed(spark, path):
        if stream.startswith(f"{STREAM_COL}="):
            for batch in _listed(spark, os.path.join(path, stream)):
                folder = os.path.join(path, stream, batch)
                if batch.startswith(f"{BATCH_COL}=") and _exists(spark, os.path.join(folder, "_SUCCESS")):
                    out[stream.partition("=")[2], int(batch.partition("=")[2])] = folder
    return out


def snapshots(spark: SparkSession, path: str) -> dict[int, dict[str, int]]:
    """The snapshots that are kept: what each covers, as the last micro-batch of every stream."""
    out = {}
    for name in _listed(spark, path):
        if name.startswith(f"{SNAPSHOT}="):
            p = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, name, MANIFEST))
            fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
            if fs.exists(p):
                source = fs.open(p)
                try:
                    out[int(name.partition("=")[2])] = json.loads(source.readLine())
                finally:
                    source.close()
    return out


def _snapshot_folder(path: str, number: int) -> str:
    return os.path.join(path, f"{SNAPSHOT}={number}")


def _current(spark: SparkSession, path: str) -> tuple[int, dict[str, int], dict[tuple[str, int], str]]:
    """The newest snapshot's number (0: none), what it covers, and the partials beyond it."""
    kept = snapshots(spark, path)
    number = max(kept, default=0)
    covers = kept.get(number, {})
    return number, covers, {k: f for k, f in _partials(spark, path).items() if k[1] > covers.get(k[0], -1)}


def read_rollup(spark: SparkSession, path: str, snapshot: int | None = None) -> DataFrame | None:
    """The rollup of everything delivered so far, or up to a snapshot; None before the first row."""
    spec = rollup_spec(spark, path)
    if spec is None:
        return None
    if snapshot is None:
        number, _, beyond = _current(spark, path)
        folders = [_snapshot_folder(path, number)] * (number > 0) + list(beyond.values())
    elif snapshot in snapshots(spark, path):
        folders = [_snapshot_folder(path, snapshot)]
    else:
        raise ValueError(f"The rollup table {path} keeps no snapshot {snapshot}")
    if not folders:
        return None
    return remerge([spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(*folders)], *spec)


def compact_in_place(spark: SparkSession, path: str) -> int:
    """Merges the newest snapshot and the partials beyond it into a new snapshot, unless there are none; gives the newest one's number.

    One compaction of a table at a time; streams may go on.
    """
    key, specs = rollup_spec(spark, path)
    number, covers, beyond = _current(spark, path)
    if not beyond:
        return number
    folders = [_snapshot_folder(path, number)] * (number > 0) + list(beyond.values())
    merged = remerge([spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(*folders)], key, specs)
    target = _snapshot_folder(path, number + 1)
    merged.write.mode("overwrite").parquet(target)  # over what an interrupted one left
    covered = dict(covers)
    for stream, batch in beyond:
        covered[stream] = max(batch, covered.get(stream, -1))
    p = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(target, MANIFEST))
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, False)
    out.writeBytes(json.dumps(covered) + "\n")
    out.close()
    return number + 1


def expire_snapshots(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Deletes all but the ``keep`` newest snapshots, and partials that the oldest one kept covers. No reader may be on them."""
    if keep < 1:
        raise ValueError("a snapshot is kept at least")
    kept = snapshots(spark, path)
    numbers = sorted(kept)[-keep:]
    old = [_snapshot_folder(path, n) for n in kept if n not in numbers]
    if numbers:
        covers = kept[numbers[0]]
        old += [f for (stream, batch), f in _partials(spark, path).items() if batch <= covers.get(stream, -1)]
    for folder in old:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def compact_rollup(spark: SparkSession, path: str, target: str) -> None:
    """Writes the merged table to ``target``, a new rollup table of one partial that streams can go on with."""
    key, specs = rollup_spec(spark, path)
    _keep_spec(spark, target, key, specs)
    read_rollup(spark, path).write.parquet(batch_folder(target, "compacted", 0))


def stream_rollup(stream: DataFrame, key: Sequence[str], specs: Sequence[tuple[str, str, str | None]], path: str,
                  checkpoint: str, available_now: bool = True, processing_time: str | None = None):
    """Keep ``path`` the rollup of everything the stream delivered."""
    spark = stream.sparkSession
    _keep_spec(spark, path, key, specs)
    name = stream_id(spark, checkpoint)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        rollup(batch_df, key, specs).write.mode("overwrite").parquet(batch_folder(path, name, batch_id))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
