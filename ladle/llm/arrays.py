"""Sorted arrays of 64-bit keys: built by shuffling arrays that tasks have added up, kept as files that workers map."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of 64-bit hashes; grows with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def pack(keys: np.ndarray, columns: list[np.ndarray]) -> bytes:
    """Ascending keys and their counts, compressed by byte planes."""
    planes = [np.diff(keys, prepend=np.uint64(0)), *columns]
    raw = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in planes)
    return len(keys).to_bytes(8, "little") + zstandard.compress(raw, 1)


def unpack(packed: bytes, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys and ``width`` columns of 8-byte counts."""
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(zstandard.decompress(packed[8:]), np.uint8).reshape(1 + width, 8, n)
    keys, *columns = (np.ascontiguousarray(x.T).reshape(-1).view(np.uint64) for x in planes)
    return np.cumsum(keys, dtype=np.uint64), columns


def add_up(keys: np.ndarray, columns: list[np.ndarray], reducers: tuple[np.ufunc, ...] = ()) -> tuple[np.ndarray, list[np.ndarray]]:
    """Equal keys as one, ascending, their counts added (or by column reduced otherwise)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[starts], [f.reduceat(c[order], starts) if len(keys) else c for c, f in zip(columns, reducers or [np.add] * len(columns))]


def packed_rows(shard: np.ndarray, keys: np.ndarray, columns: list[np.ndarray]) -> tuple[list[int], list[bytes]]:
    """The shards that occur, and the packed keys and columns of each; keys ascend."""
    order = np.argsort(shard, kind="stable")
    shard, keys, columns = shard[order], keys[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(shard)).astype(np.int64)
    rows = [pack(keys[a:b], [c[a:b] for c in columns]) for a, b in zip(cuts, ends)]
    return shard[cuts].tolist(), rows


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Writes under a name of its own, then moves: a task that runs again replaces the file by the same bytes."""
    files, base = _file_system(folder)
    files.create_dir(base, recursive=True)
    attempt = f"{base}/_attempt-{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as out:
        out.write(np.ascontiguousarray(array))
    files.move(attempt, f"{base}/{name}")


def load(folder: str, name: str, dtype: str) -> np.ndarray:
    """The array of a file: mapped where the folder is mounted, else read."""
    files, base = _file_system(folder)
    path = f"{base}/{name}"
    size = files.get_file_info(path).size or 0
    if not size:
        return np.empty(0, dtype)
    if isinstance(files, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype)


def remove(folder: str) -> None:
    """Deletes a folder with what ``save`` put there."""
    files, base = _file_system(folder)
    files.delete_dir(base)


#: Counts from here on stand in a list of their own.
LARGE = 255


def save_counts(folder: str, name: str, counts: np.ndarray) -> None:
    """A byte for each count, and the place and value of every count that a byte can't hold."""
    counts = np.asarray(counts, np.uint64)
    large = np.flatnonzero(counts >= LARGE)
    head = np.concatenate((np.array([len(large)], np.uint64), large.astype(np.uint64), counts[large])).astype("<u8")
    save(folder, name, np.concatenate((head.view(np.uint8), np.minimum(counts, np.uint64(LARGE)).astype(np.uint8))))


class Counts:
    """What ``save_counts`` wrote."""

    def __init__(self, folder: str, name: str) -> None:
        raw = load(folder, name, "u1")
        n = int(raw[:8].view("<u8")[0]) if len(raw) else 0
        self.places, self.values, self.small = raw[8:8 + 8 * n].view("<u8"), raw[8 + 8 * n:8 + 16 * n].view("<u8"), raw[8 + 16 * n:]

    def at(self, places: np.ndarray) -> np.ndarray:
        """The counts at ``places``; 0 where nothing was written."""
        if not len(self.small):
            return np.zeros(places.shape, np.int64)
        found = self.small[places].astype(np.int64)
        large = found == LARGE
        found[large] = self.values[np.searchsorted(self.places, places[large].astype(np.uint64))]
        return found


def save_keys(folder: str, name: str, keys: np.ndarray) -> None:
    """Ascending keys: the low half of each, and where each high half begins, unless more high halves than keys would be listed."""
    if not len(keys):
        return save(folder, name, keys)
    above = keys - keys[0]
    high = int(above[-1] >> np.uint64(32)) + 1
    if high > len(keys):
        return save(folder, name, np.concatenate((np.array([0, 0], np.uint64), keys)).astype("<u8"))
    begins = np.searchsorted(above >> np.uint64(32), np.arange(high + 1, dtype=np.uint64)).astype(np.uint64)
    head = np.concatenate((np.array([high, keys[0]], np.uint64), begins)).astype("<u8")
    save(folder, name, np.concatenate((head.view(np.uint8), (above & np.uint64(0xFFFFFFFF)).astype("<u4").view(np.uint8))))


class Keys:
    """What ``save_keys`` wrote."""

    def __init__(self, folder: str, name: str) -> None:
        raw = load(folder, name, "u1")
        self.high, self.first = (int(x) for x in raw[:16].view("<u8")) if len(raw) else (0, 0)
        self.begins = raw[16:16 + 8 * (self.high + 1)].view("<u8") if self.high else None
        self.keys = raw[16 + 8 * (self.high + 1):].view("<u4") if self.high else raw[16:].view("<u8")

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where there is none; ``keys`` ascend."""
        if not len(self) or not len(keys):
            return np.full(len(keys), -1, np.int64)
        if not self.high:
            at = np.minimum(np.searchsorted(self.keys, keys), len(self) - 1)
            return np.where(self.keys[at] == keys, at, -1)
        above = keys - np.uint64(self.first)
        high, low = (above >> np.uint64(32)).astype(np.int64), (above & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        inside = (keys >= np.uint64(self.first)) & (high < self.high)
        high = np.where(inside, high, 0)
        at, end = self.begins[high].astype(np.int64), self.begins[high + 1].astype(np.int64)
        if self.high * 16 < len(keys):
            cuts = np.flatnonzero(np.diff(high, prepend=-1, append=-1))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                at[a:b] += np.searchsorted(self.keys[at[a]:end[a]], low[a:b])
        else:
            last = end.copy()
            for _ in range(int((end - at).max()).bit_length()):
                middle = (at + last) >> 1
                right = (at < last) & (self.keys[np.minimum(middle, len(self) - 1)] < low)
                at, last = np.where(right, middle + 1, at), np.where(right, last, middle)
        there = np.minimum(at, len(self) - 1)
        return np.where(inside & (at < end) & (self.keys[there] == low), there, -1)


def merged(reduced: Callable[[int, np.ndarray, list[np.ndarray]], Iterator[pa.RecordBatch]], width: int,
           reducers: tuple[np.ufunc, ...] = (), add: Callable | None = None) -> Callable:
    """A task over whole shards: adds up the packed rows of each (by ``add`` if given) and hands them to ``reduced``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
        waiting: dict[int, list] = {}

        def settle(shard: int) -> None:
            parts = waiting.pop(shard, []) + ([held[shard]] if shard in held else [])
            keys, columns = np.concatenate([k for k, _ in parts]), [np.concatenate(c) for c in zip(*(c for _, c in parts))]
            held[shard] = add(keys, columns) if add else add_up(keys, columns, reducers)

        for rows in batches:
            for shard, packed in zip(rows.column(0).to_pylist(), rows.column(1)):
                waiting.setdefault(shard, []).append(unpack(packed.as_py(), width))
                if sum(len(k) for k, _ in waiting[shard]) > max(1_000_000, len(held[shard][0]) if shard in held else 0):
                    settle(shard)
        for shard in list(waiting):
            settle(shard)
        for shard in sorted(held):
            yield from reduced(shard, *held.pop(shard))

    return run


def dealt(packed: DataFrame, shards: int) -> DataFrame:
    return packed.select("shard", "packed").repartitionById(shards, F.col("shard"))
