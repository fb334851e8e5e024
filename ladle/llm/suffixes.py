"""Repeated byte strings by grouping suffixes, in place of a depth-limited radix sort.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too.
Of a sort of suffixes by their first ``length`` bytes, what matters is which groups hold two
or more. A most-significant-digit sort sends every suffix through a shuffle for its first
digit at least; here three nested stretches are compared by hashes instead of consecutive
digits, and neighbouring suffixes share a record. A suffix whose stretch occurs once drops out at once:

1. the *gram*: of the ``GRAM``-byte grams inside the suffix's ``length`` bytes the one
   with the least hash, the leftmost of equals. Neighbouring suffixes mostly share it,
   so one record stands for a run of about 70 suffixes. Equal strings have equal grams
   at equal places.
2. the *cell*: the bytes that all suffixes share whose gram lies 12 c to 12 c + 11
   bytes in.
3. the whole string of ``length`` bytes.

A run (or a cell's part of it) whose surrounding bytes, from the first byte of its
first string to the last of its last, occur as the same run elsewhere is settled
without looking deeper: all of its strings repeat. Only groups that hold two or more
different surroundings go on to the next digit.

Each digit is one pass over the texts. A task adds up equal (digit, surroundings)
before the shuffle, so a passage in every document costs each task one record; the
groups end as sorted arrays in a shared folder, and the next pass looks its digits up
there by memory map. Nothing is sent back per position, and no group is gathered.

Stretches are compared by 64 bits mixed from two polynomial hashes, one modulo 2^64 over
random byte values and one modulo the prime 2^61 - 1; n strings that are compared whole take
n * n / 2^65 false matches, which at a hundred million strings is 3 in ten thousand.

Edge cases: a null text has no bytes; texts shorter than ``length`` bytes keep all;
null keys and repeated rows are handled row by row (equal rows repeat each other); an
empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.llm.arrays import dealt, load, merged, packed_rows, save, shard_of
from ladle.llm.shingles import GOLDEN, mix

LENGTH = 200
GRAM = 64
CELL = 12
#: Suffixes handled at a time; a longer text is taken in parts that overlap by ``length``.
PART = 1 << 20
#: Records that a task adds up before it sends them on.
RECORDS = 1_500_000
POSITION_BITS = np.uint64(22)
PACKED = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("packed", T.BinaryType())])


#: A prime: residues are of numbers below 2^61, so that products are put together from 64-bit halves.
PRIME = np.uint64((1 << 61) - 1)
LOW, HALF = np.uint64((1 << 31) - 1), np.uint64(31)


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``PRIME``."""
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _half_up(x: np.ndarray) -> np.ndarray:
    """``x`` * 2^31, less multiples of ``PRIME``; ``x`` is below 2^62."""
    return (x >> np.uint64(30)) + ((x & np.uint64((1 << 30) - 1)) << HALF)


def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x`` * ``y`` modulo ``PRIME``."""
    x_high, x_low, y_high, y_low = x >> HALF, x & LOW, y >> HALF, y & LOW
    return _reduced(np.uint64(2) * x_high * y_high + _half_up(x_high * y_low + x_low * y_high) + _reduced(x_low * y_low))


def _residue_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        some = min(done, n - done)
        out[done:done + some] = _times(out[:some], np.uint64(pow(base, done, int(PRIME))))
        done += some
    return out


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, ...]:
    """A random value for each byte, and random bases' powers and inverse powers: modulo 2^64 and modulo ``PRIME``
    (those in halves). Fixed seeds: all tasks agree."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
    base, other = (int(x) for x in mix(np.array([0x5EED, 0x0DD5EED], np.uint64)))
    base, other = base | 1, other % int(PRIME)
    n = 2 * PART + 2 * LENGTH + 1
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    powers = _residue_powers(other, n)
    return (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64), values, (powers >> HALF).astype(np.uint32), (powers & LOW).astype(np.uint32),
            _residue_powers(pow(other, -1, int(PRIME)), n))


class Part:
    """Bytes of several texts (or a part of one) and hashes of any stretch of them."""

    def __init__(self, flat: np.ndarray) -> None:
        up, self.down, values, high, low, self.residue_down = _powers()
        n = len(flat)
        self.sums, self.high, self.low = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(values[flat] * up[:n], out=self.sums[1:])
        # Sums of at most 2^21 and some products below 2^40.
        byte = flat.astype(np.uint64) + np.uint64(1)
        np.cumsum(byte * high[:n], out=self.high[1:])
        np.cumsum(byte * low[:n], out=self.low[1:])

    def rank(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A number for the bytes from ``start`` up to ``end``: equal for equal bytes, mostly another for others."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def hash(self, start: np.ndarray, end: np.ndarray, tag: np.ndarray | int = 0) -> np.ndarray:
        """Of the bytes from ``start`` up to ``end``; stretches with different tags never agree.

        A sum modulo 2^64 alone is equal for some words of doubled-up patterns, so a residue
        modulo a prime goes with it.
        """
        residue = _times(_reduced(_half_up(_reduced(self.high[end] - self.high[start])) + _reduced(self.low[end] - self.low[start])), self.residue_down[start])
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + mix(residue + mix(np.atleast_1d(np.asarray(tag + 1, np.uint64)) * GOLDEN)))


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by minima from both ends of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    front = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], front[width - 1:n])


class Runs:
    """The runs of suffixes in a part: place of the gram, first and last suffix, and the digit's hashes."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> None:
        """``starts`` and ``sizes``: where texts begin in ``flat``, and how many suffixes of each count (those with ``length`` bytes)."""
        self.part = part = Part(flat)
        self.length = length
        all_grams = np.arange(len(flat) - gram + 1)
        ranked = part.rank(all_grams, all_grams + gram) >> POSITION_BITS << POSITION_BITS | all_grams.astype(np.uint64)
        least = _least_in_windows(ranked, length - gram + 1) & (np.uint64(1) << POSITION_BITS) - np.uint64(1)
        suffix = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        at = least[suffix].astype(np.int64)
        new = np.append(True, (at[1:] != at[:-1]) | (suffix[1:] != suffix[:-1] + 1)) if len(at) else np.empty(0, bool)
        first = np.flatnonzero(new)
        self.gram, self.first = at[first], suffix[first]
        self.last = suffix[np.append(first[1:], len(at)) - 1] if len(at) else suffix
        self.near, self.far = self.gram - self.last, self.gram - self.first
        # Not the hash that ranks grams: that of a least one is small, and would put most digits into a few shards.
        self.digit = part.hash(self.gram, self.gram + gram, 1 << 23)
        self.around = part.hash(self.first, self.last + length, 1 + self.near + 1024 * self.far)

    def cells(self, of: np.ndarray) -> Cells:
        """The cells of the runs ``of`` (indices)."""
        low, high = self.near[of] // CELL, self.far[of] // CELL
        count = high - low + 1
        run = np.repeat(of, count)
        cell = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        return Cells(self, run, cell)


class Cells:
    """Parts of runs: the suffixes whose gram lies ``near`` to ``far`` bytes in."""

    def __init__(self, runs: Runs, run: np.ndarray, cell: np.ndarray) -> None:
        self.run = run
        near, far = np.maximum(cell * CELL, runs.near[run]), np.minimum(cell * CELL + CELL - 1, runs.far[run])
        gram, length = runs.gram[run], runs.length
        self.first, self.last = gram - far, gram - near
        self.digit = runs.part.hash(gram - cell * CELL, gram - cell * CELL - CELL + 1 + length, (1 << 21) + cell)
        self.around = runs.part.hash(self.first, self.last + length, (1 << 22) + near + 1024 * far)

    def suffixes(self, of: np.ndarray) -> np.ndarray:
        count = self.last[of] - self.first[of] + 1
        return np.repeat(self.first[of] - np.cumsum(count) + count, count) + np.arange(count.sum())


class Found:
    """The sorted arrays of earlier passes, as seen by one worker."""

    def __init__(self, folder: str, shards: int) -> None:
        self.folder, self.shards, self.arrays = folder, shards, {}

    def has(self, kind: str, keys: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(keys, return_inverse=True)
        found = np.zeros(len(distinct), bool)
        cuts = np.searchsorted(shard_of(distinct, self.shards), np.arange(self.shards + 1))
        for shard in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            name = f"{kind}-{shard}"
            if name not in self.arrays:
                self.arrays[name] = load(self.folder, name, "<u8")
            there = self.arrays[name]
            if len(there):
                own = distinct[cuts[shard]:cuts[shard + 1]]
                found[cuts[shard]:cuts[shard + 1]] = there[np.minimum(np.searchsorted(there, own), len(there) - 1)] == own
        return found[back]


def _parts(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of about ``PART`` suffixes: bytes, where each piece starts in them, its suffixes, its text, and its place in the text."""
    held: list[tuple[bytes, int, int, int]] = []
    total = 0

    def part():
        raw, sizes, text, place = zip(*held)
        ends = np.cumsum([len(x) for x in raw])
        return (np.frombuffer(b"".join(raw), np.uint8), ends - [len(x) for x in raw], np.array(sizes), np.array(text), np.array(place))

    for i, raw in enumerate(texts):
        for place in range(0, len(raw) - length + 1, PART):
            piece = raw[place:place + PART + length - 1]
            if held and total + len(piece) > PART + length:
                yield part()
                held, total = [], 0
            held.append((piece, len(piece) - length + 1, i, place))
            total += len(piece)
    if held:
        yield part()


def remove_repeats(docs: DataFrame, work: str, *, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM,
                   shards: int | None = None) -> DataFrame:
    """(key, n_bytes, removed array of (start, end), kept binary) of each row.

    ``work`` is a new folder that all workers share; it gets the sorted arrays.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"))

    def records(level: int) -> Callable:
        """Adds up (surroundings, digit) for a pass, as packed rows by surroundings."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, held, n = Found(work, shards), [], 0

            def settled() -> pa.RecordBatch:
                around, digit = (np.concatenate(x) for x in zip(*held))
                distinct, first, counts = np.unique(around, return_index=True, return_counts=True)
                columns = [digit[first], np.minimum(counts, 2).astype(np.uint64)]
                rows = packed_rows(shard_of(distinct, shards), distinct, columns)
                return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary())], names=PACKED.fieldNames())

            for rows in batches:
                for flat, starts, sizes, _, _ in _parts(rows.column(0).to_pylist(), length):
                    runs = Runs(flat, starts, sizes, length, gram)
                    if level == 1:
                        own = runs.around, runs.digit
                    else:
                        cells = runs.cells(np.flatnonzero(found.has("mixed-1", runs.digit)))
                        own = cells.around, cells.digit
                        if level == 3:
                            at = cells.suffixes(np.flatnonzero(found.has("mixed-2", cells.digit)))
                            whole = runs.part.hash(at, at + length)
                            own = whole, whole
                    held.append(own)
                    n += len(own[0])
                    if n >= RECORDS:
                        yield settled()
                        held, n = [], 0
            if n:
                yield settled()

        return run

    def save_repeated(level: int) -> Callable:
        """Keeps the surroundings that occur twice; hands on how many of them each digit has, up to two."""

        def run(shard: int, around: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            digit, counts = columns[0], columns[1]
            save(work, f"repeated-{level}-{shard}", around[counts > 1].astype("<u8"))
            digits, n = np.unique(digit, return_counts=True)
            rows = packed_rows(shard_of(digits, shards), digits, [np.minimum(n, 2).astype(np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary())], names=PACKED.fieldNames())

        return run

    def save_mixed(level: int) -> Callable:
        def run(shard: int, digits: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            save(work, f"mixed-{level}-{shard}", digits[columns[0] > 1].astype("<u8"))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([None], pa.binary())], names=PACKED.fieldNames())

        return run

    for level in (1, 2, 3):
        counted = dealt(texts.select("text").mapInArrow(records(level), PACKED), shards).mapInArrow(
            merged(save_repeated(level), 2, reducers=(np.minimum, np.add)), PACKED)
        if level < 3:
            counted = dealt(counted, shards).mapInArrow(merged(save_mixed(level), 1), PACKED)
        counted.write.parquet(f"{work}/pass-{level}")

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("kept", T.BinaryType())])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(work, shards)
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                rows = whole.slice(begin, 500)
                raw = rows.column(1).to_pylist()
                first, last, text_of = [], [], []
                for flat, starts, sizes, text, place in _parts(raw, length):
                    runs = Runs(flat, starts, sizes, length, gram)
                    again = found.has("repeated-1", runs.around)
                    mixed = found.has("mixed-1", runs.digit) & ~again
                    cells = runs.cells(np.flatnonzero(mixed))
                    cells_again = found.has("repeated-2", cells.around)
                    at = cells.suffixes(np.flatnonzero(found.has("mixed-2", cells.digit) & ~cells_again))
                    at = at[found.has("repeated-3", runs.part.hash(at, at + length))]
                    a = np.concatenate((runs.first[again], cells.first[cells_again], at))
                    b = np.concatenate((runs.last[again], cells.last[cells_again], at)) + length
                    piece = np.searchsorted(starts, a, side="right") - 1
                    shift = place[piece] - starts[piece]
                    first.append(a + shift)
                    last.append(b + shift)
                    text_of.append(text[piece])
                first, last, text_of = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (first, last, text_of))
                order = np.argsort(text_of, kind="stable")
                cuts = np.searchsorted(text_of[order], np.arange(len(raw) + 1))
                removed, kept = [], []
                for i, own in enumerate(raw):
                    pick = order[cuts[i]:cuts[i + 1]]
                    cut = np.zeros(len(own) + 1, np.int32)
                    np.add.at(cut, first[pick], 1)
                    np.add.at(cut, last[pick], -1)
                    gone = np.cumsum(cut[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).tolist()
                    removed.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                    kept.append(np.frombuffer(own, np.uint8)[~gone].tobytes() if edges else own)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(map(len, raw), pa.int64()), pa.array(removed, spans), pa.array(kept, pa.binary())],
                                                 names=schema.fieldNames())

    return texts.mapInArrow(remove, schema)
