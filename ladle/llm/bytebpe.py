"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The bytes of many pre-tokens form one linked list, cut between pre-tokens. Every
adjacent pair that has a merge rank sits in the bucket of that rank; a two-level
bitmap over the ranks finds the lowest bucket in use by find-first-set. The whole
bucket is then merged at once: entries whose pair has changed since are stale and
skipped, overlapping ones are taken alternately from the left, and the changed
neighbour pairs are pushed anew. Where a merge opens a pair of lower rank, the later
entries of that pre-token are put back, so that every pre-token sees its merges in
exact order. The cost per byte doesn't depend on the length of
a pre-token.

Edge cases: a null text encodes as the empty text (no ids, empty bytes); null
keys, ties and repeated rows pass through row by row; an empty table gives an
empty result; columns that are not asked for are dropped, so none can clash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAF_BITS = 8
LEAF_MASK = (1 << LEAF_BITS) - 1
#: Pre-tokens kept encoded per Python worker, and the longest kept; beyond, the merge runs again.
CACHE_ENTRIES = 250_000
CACHE_PIECE_CHARS = 64
#: Characters of text encoded together; a longer document goes alone.
CHUNK_CHARS = 3_000_000


class Merges:
    """The merge table of a vocabulary: which two token ids join into which."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        found: dict[int, int] = {}
        self.none = max(ranks.values(), default=0) + 1
        self.width = self.none + 1
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * self.width + right] = rank
        order = np.array(sorted(found), np.int64)
        self.pairs = np.append(order, np.iinfo(np.int64).max)
        self.ranks = np.array([found[int(x)] for x in order] + [-1], np.int32)
        self.of_byte = np.array([ranks[bytes([x])] for x in range(256)], np.int32)
        #: Ranks whose token takes part in a pair of lower rank.
        lowest = np.full(self.width, np.iinfo(np.int32).max, np.int32)
        for part in (order // self.width, order % self.width):
            np.minimum.at(lowest, part, self.ranks[:-1])
        self.opens_lower = lowest < np.arange(self.width)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 without one."""
        pair = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.ranks[at], np.int32(-1))


class RankQueue:
    """Positions by merge rank, with a bitmap of ranks in use by block and one of blocks."""

    def __init__(self) -> None:
        self.root = 0
        self.leaves: dict[int, int] = {}
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if len(ranks) > 1:
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()]
        else:
            cuts = [0] * len(ranks)
        ends = [*cuts[1:], len(ranks)]
        for rank, first, end in zip(ranks[cuts].tolist(), cuts, ends):
            bucket = self.buckets.get(rank)
            if bucket is None:
                self.buckets[rank] = [positions[first:end]]
                block = rank >> LEAF_BITS
                self.leaves[block] = self.leaves.get(block, 0) | 1 << (rank & LEAF_MASK)
                self.root |= 1 << block
            else:
                bucket.append(positions[first:end])

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest rank and its positions, ascending."""
        block = (self.root & -self.root).bit_length() - 1
        leaf = self.leaves[block]
        low = leaf & -leaf
        rank = block << LEAF_BITS | low.bit_length() - 1
        self.leaves[block] = leaf ^ low
        if leaf == low:
            self.root ^= 1 << block
        bucket = self.buckets.pop(rank)
        return rank, np.unique(bucket[0] if len(bucket) == 1 else np.concatenate(bucket))


def merge(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pre-tokens, and how many each has."""
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(flat)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    # Position n stands for "none": it links to itself and pairs with nothing.
    ids = np.append(merges.of_byte[flat], np.int32(merges.none))
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    after[n] = n
    after[ends[sizes > 0] - 1] = n
    before[(ends - sizes)[sizes > 0]] = n
    pair_rank = merges.rank(ids, ids[after])
    queue = RankQueue()
    at = np.flatnonzero(pair_rank >= 0)
    queue.push(pair_rank[at], at)
    alive = np.ones(n, bool)
    while queue.root:
        rank, at = queue.pop()
        at = at[pair_rank[at] == rank]  # the others are stale
        over = at[:0]
        if len(at) > 1:
            runs_on = np.append(False, after[at[:-1]] == at[1:])
            if runs_on.any():
                index = np.arange(len(at))
                take = (index - np.maximum.accumulate(np.where(runs_on, 0, index))) % 2 == 0
                over, at = at[~take], at[take]
        elif not len(at):
            continue
        while True:
            gone = after[at]
            right, former = after[gone], ids[at]
            ids[at] = rank
            after[at] = right
            before[right] = at
            changed = np.concatenate((at, before[at]))
            ranks = merges.rank(ids[changed], ids[np.concatenate((right, at))])
            has = ranks >= 0
            if not merges.opens_lower[rank] or len(at) == 1 or not (lower := has & (ranks < rank)).any():
                break
            first = np.append(True, piece[at[1:]] != piece[at[:-1]])
            wait = ~first & np.isin(piece[at], piece[changed[lower]])
            if not wait.any():
                break
            # A lower rank has opened in a pre-token with later entries: take those back.
            ids[at], after[at] = former, gone
            before[right] = gone
            back = np.concatenate((at[wait], over))
            queue.push(np.full(len(back), rank), back)
            at, over = at[~wait], over[:0]
        alive[gone] = False
        pair_rank[gone] = -1
        pair_rank[changed] = ranks
        pair_rank[n] = -1
        queue.push(ranks[has], changed[has])
    return ids[:n][alive], np.bincount(piece[alive], minlength=len(pieces))


class Numbers(dict):
    """A number for each pre-token, in the order they are first asked for."""

    def __init__(self) -> None:
        self.fresh, self.asked = [], 0

    def __missing__(self, piece: str) -> int:
        self[piece] = number = self.asked
        self.asked += 1
        self.fresh.append(piece)
        return number


class Codec:
    """Encoder and decoder of one rank file, with a bounded store of pre-tokens.

    A pre-token is kept as a number, and the ids of all of them as one array: that
    takes far less memory than an object for each id.
    """

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.merges = Merges(self.ranks)
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.flat, self.sizes = Numbers(), np.empty(0, np.int32), np.empty(0, np.int64)

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's end. The pre-tokens that aren't kept yet merge together."""
        if self.numbers.asked > CACHE_ENTRIES:
            self._forget()
        numbers = self.numbers
        split = []
        for text in texts:
            pieces = self.pieces(text)
            split.append(np.fromiter(map(numbers.__getitem__, pieces), np.int32, len(pieces)))
        fresh, numbers.fresh = numbers.fresh, []
        found, of_each = merge([x.encode() for x in fresh], self.merges)
        flat, sizes = np.concatenate((self.flat, found)), np.concatenate((self.sizes, of_each))
        long = [k for k, x in enumerate(fresh) if len(x) > CACHE_PIECE_CHARS]
        if long:
            found = np.delete(found, np.flatnonzero(np.isin(np.repeat(np.arange(len(fresh)), of_each), long)))
            of_each[long] = 0
            for k in long:
                del numbers[fresh[k]]
        self.flat, self.sizes = np.concatenate((self.flat, found)), np.concatenate((self.sizes, of_each))
        begins = np.cumsum(sizes) - sizes
        asked = np.concatenate(split) if split else np.empty(0, np.int32)
        upto = np.append(0, np.cumsum(sizes[asked]))
        source = np.repeat(begins[asked] - upto[:-1], sizes[asked])
        source += np.arange(len(source))
        return flat[source], upto[np.cumsum([len(x) for x in split], dtype=np.int64)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        flat, ends = self.encode_flat(texts)
        return [flat[a:b].tolist() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process, rank file and pattern."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, *, text: str = "text", key: str = "doc_id", decoded: bool = False) -> DataFrame:
    """(key, ids array<int>) of each document, and with ``decoded`` the bytes that the ids decode to.

    One pass without a shuffle. ``path`` names the rank file on every worker.
    """
    schema = T.StructType([docs.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
    if decoded:
        schema = schema.add("decoded", T.BinaryType(), False)

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)

        def batch(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
            flat, ends = own.encode_flat(texts)
            columns = [keys, pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))]
            if decoded:
                raw = map(own.decode, (flat[a:b].tolist() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())))
                columns.append(pa.array(raw, pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

        keys, chunk, held = [], [], 0
        for rows in batches:
            first = 0
            for at, value in enumerate(rows.column(1)):
                value = value.as_py() or ""
                if chunk and held + len(value) > CHUNK_CHARS:
                    yield batch(pa.concat_arrays([*keys, rows.column(0).slice(first, at - first)]), chunk)
                    keys, chunk, held, first = [], [], 0, at
                chunk.append(value)
                held += len(value)
            keys.append(rows.column(0).slice(first))
        if chunk:
            yield batch(pa.concat_arrays(keys), chunk)

    return docs.select(docs[key], docs[text]).mapInArrow(encode_batches, schema)


def decode(encoded: DataFrame, path: str, pattern: str, *, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, decoded binary) of each row's ids; null ids decode to no bytes."""
    schema = T.StructType([encoded.schema[key], T.StructField("decoded", T.BinaryType(), False)])

    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for rows in batches:
            raw = [own.decode(x.as_py() or []) for x in rows.column(1)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(raw, pa.binary())], names=[f.name for f in schema])

    return encoded.select(encoded[key], encoded[ids]).mapInArrow(decode_batches, schema)
