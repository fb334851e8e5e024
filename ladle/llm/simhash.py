r"""Near-duplicate documents by SimHash, found by deletion-variant signatures of half fingerprints.

A document's fingerprint has a bit set where over half of its word shingles' hashes
have it. Fingerprints link at ``MOST_BITS`` differing bits or fewer, and classes
are the connected components of the links.

1. Each text gives a 64-bit fingerprint; equal ones are one node.
2. Of three differing bits, one half of the fingerprint has one at most. So each node
   is filed under both halves with every one of their 32 bits left out in turn (64 one-wildcard
   variants); linked nodes meet under one of them at least, and an equality of 31
   bits and the place tells who meets.
3. Those who meet are compared in full, in the one variant that is first for the pair:
   that of the bit that differs, or of bit 0 where the halves are equal. What is handed
   on is a spanning forest of the links found in a task, not all pairs.
4. Halves that ``CROWD`` nodes or more share are known beforehand from their counts.
   Such groups are not read by one task: their members are filed once more, by the other half cut in
   two parts of 16 bits with one left out, under keys as exact. What then meets has 18
   free bits left, so no group can exceed 2^18 nodes; large ones are searched by
   looking up every mask of three bits in a table of that size.

Edge cases: a null text, and one without words, has fingerprint 0, linked like any
other; a null key takes its class from other rows, if any has a key, else null; rows that share a
key each have their fingerprint; an empty table gives an empty result; other columns are
dropped. Shingles count as often as they occur, and texts of any length are read piece
by piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.llm.components import components

WIDTH = 3
MOST_BITS = 3
SEED = 42
#: Nodes that share a half from which on they are filed by the other half too.
CROWD = 8192
#: Nodes of a group from which on it is looked up by masks where it has few free bits.
LARGE = 4096
PIECE_BYTES = 1 << 20
CHUNK_HASHES = 1 << 16
#: Filed nodes that a task searches together.
TOGETHER = 1 << 18
SPACE = re.compile(rb"[ \t-\r]")
BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _shingles(raw: bytes, width: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, of some words at a time."""
    carried, at, short = b"", 0, True
    digest = xxhash.xxh64_intdigest
    while at < len(raw) or short:
        end = len(raw)
        if at + PIECE_BYTES < end:
            space = SPACE.search(raw, at + PIECE_BYTES)
            end = space.start() if space else end
        words = (carried + b" " + raw[at:end].lower()).split()
        at = end
        whole = len(words) >= width
        if not whole and at < len(raw):
            carried = b" ".join(words)
            continue
        if not whole and not (short and words):
            return
        size = min(width, len(words))
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:len(words) - size] + 1)).tolist()
        yield np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist())], np.uint64, len(starts))
        short = False
        carried = b" ".join(words[len(words) - size + 1:]) if size > 1 else b""


def fingerprint(raw: bytes, width: int = WIDTH) -> int:
    """The fingerprint of a text in UTF-8."""
    bits, n = np.zeros(64, np.int64), 0
    for hashes in _shingles(raw, width):
        n += len(hashes)
        for at in range(0, len(hashes), CHUNK_HASHES):
            planes = hashes[at:at + CHUNK_HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
            for byte in range(8):
                bits[8 * byte:8 * byte + 8] += np.bincount(planes[:, byte], minlength=256) @ BIT_OF_BYTE
    return int.from_bytes(np.packbits(2 * bits > n, bitorder="little").tobytes(), "little") if n else 0


def fingerprints(docs: DataFrame, *, text: str = "text", key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """(key, print) of each row; ``print`` is the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = np.array([fingerprint(x.as_py() or b"", width) for x in rows.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found.view(np.int64))], names=["key", "print"])

    return docs.select(docs[key].cast("long").alias("key"), docs[text].cast("binary").alias("text")).mapInArrow(run, "key long, print long")


def _half(side: int, name: str = "print") -> Column:
    return (F.shiftrightunsigned(name, 32) if side else F.col(name)).bitwiseAND(F.lit(0xFFFFFFFF))


def _left_out(value: Column, bit: Column, bits: int) -> Column:
    """``value`` of ``bits`` bits without the one at place ``bit``."""
    above = F.call_function("shiftleft", F.call_function("shiftrightunsigned", value, bit + 1), bit)
    below = value.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bit) - 1)
    return above.bitwiseOR(below).bitwiseAND(F.lit((1 << bits - 1) - 1))


def filed(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(variant, print): where each node is filed.

    A variant is (side * 32 + bit) * 3, or in crowds that + 1 + part of the other half; then 4 bits with the
    place left out of the part, 31 bits of the half and 15 of the part.
    """
    long = F.lit(0).cast("long")
    halves = nodes.select("print", F.explode(F.array(*(F.struct(F.lit(side).alias("side"), _half(side).alias("half")) for side in (0, 1)))).alias("x")).select(
        "print", F.col("x.side").alias("side"), F.col("x.half").alias("half"))
    crowds = halves.groupBy("side", "half").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= crowd).select("side", "half")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    # Of a crowd all variants are crowded; of its neighbours, the one that leads to it.
    around = crowds.select("side", "half", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
    marks = around.select("side", "half", one.alias("crowded")).union(
        around.select("side", F.col("half").bitwiseXOR(one).alias("half"), one.alias("crowded"))).groupBy("side", "half").agg(F.bit_or("crowded").alias("crowded"))
    every = halves.join(marks, ["side", "half"], "left").select("print", "side", "half", F.coalesce("crowded", long).alias("crowded"),
                                                                F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
    group, rest = (F.col("side") * 32 + F.col("bit")) * 3, _left_out(F.col("half"), F.col("bit"), 32)
    spots = F.when(F.col("crowded").bitwiseAND(one) != 0, F.sequence(F.lit(0), F.lit(31))).otherwise(F.array(F.lit(-1)))
    spread = every.select("print", "side", group.cast("long").alias("group"), rest.alias("rest"), F.explode(spots).alias("spot"))
    part, place = F.floor(F.col("spot") / 16).cast("int"), F.pmod("spot", F.lit(16)).cast("int")
    other = F.when(F.col("side") == 0, _half(1)).otherwise(_half(0))
    more = _left_out(F.call_function("shiftrightunsigned", other, part * 16).bitwiseAND(F.lit(0xFFFF)), place, 16)
    head = F.when(F.col("spot") < 0, F.col("group") * 16).otherwise((F.col("group") + 1 + part) * 16 + place)
    variant = (head * (1 << 31) + F.col("rest")) * (1 << 15) + F.when(F.col("spot") < 0, long).otherwise(more)
    return spread.select(variant.alias("variant"), "print")


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= MOST_BITS


def _in_group(nodes: np.ndarray, free: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The places of all linked pairs' two nodes, or (with ``free`` bits) of those a mask leads to."""
    if free is not None and len(nodes) >= LARGE:
        # The bits that nodes may differ in, as one number each.
        packed = np.zeros(len(nodes), np.int64)
        for i, bit in enumerate(free.tolist()):
            packed |= (nodes >> np.uint64(bit) & np.uint64(1)).astype(np.int64) << i
        own, at = np.arange(len(nodes)), np.full(1 << len(free), -1, np.int64)
        at[packed] = own
        links, held = [(own[:0], own[:0])], 0
        for places in (x for k in range(1, MOST_BITS + 1) for x in combinations(range(len(free)), k)):
            there = at[packed ^ sum(1 << p for p in places)]
            found = np.flatnonzero(there > own)
            links.append((found, there[found]))
            held += len(found)
            if held > TOGETHER * 8:
                links, held = [spanning(*map(np.concatenate, zip(*links)))], 0
        return spanning(*map(np.concatenate, zip(*links)))
    one, other = [], []
    rows = max(1, 4_000_000 // len(nodes))
    for at in range(0, len(nodes), rows):
        a, b = np.nonzero(_near(nodes[at:at + rows, None], nodes[None, at:]))
        later = a < b
        a, b = spanning(a[later] + at, b[later] + at)
        one.append(a)
        other.append(b)
    return np.concatenate(one), np.concatenate(other)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its component) that join what the links (a, b) of numbers join."""
    if not len(a):
        return a, b
    ids, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = places[:len(a)], places[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        # Both ends, and what they followed so far, follow the lower label.
        for end in (label[a], label[b], a, b):
            np.minimum.at(label, end, low)
        label = label[label]
        if (label == before).all():
            break
    own = np.flatnonzero(label != np.arange(len(ids)))
    return ids[own], ids[label[own]]


def _groups(variants: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what is linked in the groups of equal variants, which lie one behind the other."""
    starts = np.flatnonzero(np.append(True, variants[1:] != variants[:-1]))
    sizes = np.diff(np.append(starts, len(nodes)))
    head = variants[starts] >> 46
    side, bit, part, place = head // 16 // 96, head // 16 // 3 % 32, head // 16 % 3 - 1, head % 16
    one, other = [nodes[:0]], [nodes[:0]]
    small = (sizes > 1) & (sizes <= 64)
    rows, group = np.flatnonzero(np.repeat(small, sizes)), np.repeat(np.arange(len(sizes)), sizes)
    for shift in range(1, int(sizes[small].max(initial=0))):
        rows = rows[rows + shift < len(nodes)]
        rows = rows[group[rows] == group[rows + shift]]
        x, y, g = nodes[rows], nodes[rows + shift], group[rows]
        # Equal halves meet under every bit; bit 0 is enough.
        equal = np.where(side[g] == 1, (x ^ y) >> np.uint64(32), (x ^ y) & np.uint64(0xFFFFFFFF)) == 0
        near = _near(x, y) & (~equal | (bit[g] == 0))
        one.append(x[near])
        other.append(y[near])
    for g in np.flatnonzero(sizes > 64).tolist():
        members = nodes[starts[g]:starts[g] + sizes[g]]
        left_out = int(32 * side[g] + bit[g])
        if bit[g] and len(np.unique(members >> np.uint64(left_out) & np.uint64(1))) < 2:
            continue  # equal halves
        far = int(32 - 32 * side[g])
        free = np.array([left_out, far + 16 * part[g] + place[g], *range(far + 16 - 16 * part[g], far + 32 - 16 * part[g])]) if part[g] >= 0 else None
        a, b = _in_group(members, free)
        one.append(members[a])
        other.append(members[b])
    return spanning(np.concatenate(one), np.concatenate(other))


def _search(filed_nodes: DataFrame) -> DataFrame:
    """(a, b): links that span what lies linked in each task's groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def found(last: bool) -> Iterator[pa.RecordBatch]:
            variants, nodes = (np.concatenate(x) for x in zip(*held))
            # The last group may go on in the next batch.
            upto = len(variants) if last else int(np.searchsorted(variants, variants[-1]))
            held[:] = [(variants[upto:], nodes[upto:])]
            if upto:
                a, b = _groups(variants[:upto], nodes[:upto].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

        for rows in batches:
            if rows.num_rows:
                held.append(tuple(c.to_numpy(zero_copy_only=False) for c in rows.columns))
                if sum(len(x) for x, _ in held) >= TOGETHER:
                    yield from found(False)
        if held:
            yield from found(True)

    dealt = filed_nodes.repartition("variant").sortWithinPartitions("variant", "print")
    return dealt.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, work: str, *, text: str = "text", key: str = "doc_id", width: int = WIDTH, crowd: int = CROWD) -> DataFrame:
    """(key, print, class_id) of each row: its fingerprint as a signed number, and the least key of its class.

    ``work`` is a new folder that all workers share; what each step finds is written
    there, so that nothing is computed twice and a lost executor costs a step at most.
    """
    spark = docs.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    prints = kept(fingerprints(docs, text=text, key=key, width=width), "prints")
    nodes = kept(prints.groupBy("print").agg(F.min("key").alias("least")), "nodes")
    links = kept(_search(filed(nodes, crowd)), "links")
    labels = components(links, f"{work}/classes")
    labelled = nodes.join(labels, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("label", "print").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least").alias("class_id"))
    known = labelled.select("print", "label").join(least, "label").select(F.col("print").alias("of"), "class_id")
    return prints.join(known, F.col("print") == F.col("of")).select(F.col("key").alias(key), F.col("print").alias("print"), "class_id")
