r"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes, and how often in the corpus.

Both tokenizers cut the same bytes (a space and the text). Where both cut, groups end;
every pair of tokens whose bytes overlap is a link. A link's count is the number of links
of the same two ids in the whole corpus, and it is a best one where no other id of
the first tokenizer has a higher count with its id of the second (the side).

1. Tasks tokenize some documents at a time (a run's worth) and sort their links as records of side, other id,
   document and times. The low byte of the side's id is the radix: the records of each
   radix are kept as one zstd run, the pairs with their totals apart from the postings (which documents, how
   often).
2. The pairs are added up in the tasks that read them, dealt by radix, and merged there:
   a k-way heap merge in side-major order, so all counts of a side are at hand when it is passed,
   and with them their maximum. A radix holds 256th parts of the product of the vocabularies
   at most, however large the corpus.
3. Counts stream back over the postings: each task takes the counts of some radices and
   then those radices' runs, one after another, and adds up what each document gets. A frequent id
   is no hot spot: its runs are dealt over as many tasks as its radices' share allows (a salt of the run's
   number), each with a copy of the bounded counts.
4. What a run's documents got comes together by run, beside the documents' own figures.

Edge cases: a null or empty text, and one that a tokenizer doesn't give back byte by
byte, has no tokens; rows that share a key or have none each keep their own row; an empty table
gives an empty result; other columns are dropped. A text is tokenized as a whole, by
pieces that the tokenizers never merge across.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of text, and documents, of one run; a longer document has a run of its own.
RUN_CHARS, RUN_DOCS = 4_000_000, 4096
RADICES = 256
#: Into so many parts the radices are dealt, besides the salt, when counts stream back.
PARTS = 16
#: Stems that each tokenizer keeps with their ids, and the longest of them.
CACHED_STEMS, CACHED_CHARS = 500_000, 64
#: Stems tokenized in one call.
JOINED = 256
#: Pairs, and documents, that a task holds before it hands on what it has added up.
HELD = 2_000_000
#: Characters whose classes all versions of the splitting pattern agree on, and white space among them that isn't
#: a space or line feed by itself between others.
SETTLED = re.compile("[\t-\r -~\xa0-ɏͰ-ԯ]*").fullmatch
ODD_SPACE = ("\t", "\x0b", "\f", "\r", "\xa0", "  ", "\n\n", " \n", "\n ")
PLAIN = re.compile("[ \n][A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: A word, and marks behind it.
MARKED = "^(?P<stem>\n?[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?]*)$"


class Side:
    """One tokenizer behind a cache of the chunks it never merges across.

    ``chunks`` cuts a text (null: it can't be cut), ``encode`` gives the ids of each of some
    chunks, ``whole`` those of whole texts, ``pieces`` each id's bytes; ``marks_apart`` if it
    never merges a letter with a mark behind it.
    """

    def __init__(self, chunks: Callable[[str], list[str]] | None, encode: Callable, whole: Callable, pieces: list[bytes], marks_apart: bool) -> None:
        self.chunks, self.encode, self.whole, self.pieces, self.marks_apart = chunks, encode, whole, pieces, marks_apart
        self.lengths = np.array(list(map(len, pieces)), np.int64)
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.stems: dict[str, bytes] = {}
        self.odd: set[str] = set()

    def _same(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.pieces.__getitem__, ids)) == raw

    def _learn(self, stems: list[str]) -> None:
        plain, alone = [], []
        for stem in stems:
            (plain if PLAIN(stem) else alone).append(stem)
        for at in range(0, len(plain), JOINED):
            some = plain[at:at + JOINED]
            joined = "".join(some)
            ids = np.array(self.encode([joined])[0], np.int64)
            ends = np.cumsum(self.lengths[ids])
            want = np.cumsum([len(x.encode()) for x in some])
            cuts = np.searchsorted(ends, want)
            if len(ids) and cuts[-1] == len(ids) - 1 and (ends[cuts] == want).all() and self._same(ids.tolist(), joined.encode()):
                raw, cuts = ids.astype(self.dtype).tobytes(), [0, *((cuts + 1) * self.dtype.itemsize).tolist()]
                self.stems.update(zip(some, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))
            else:
                alone += some
        for stem, ids in zip(alone, self.encode(alone) if alone else []):
            self.stems[stem] = np.array(ids, self.dtype).tobytes()
            if not self._same(ids, stem.encode()):
                self.odd.add(stem)

    def ids_of(self, stems: list[str]) -> tuple[list[bytes], np.ndarray]:
        """The ids of distinct stems, as ``dtype``, and whether their bytes are the stem's."""
        if len(self.stems) > CACHED_STEMS:
            self.stems.clear()
            self.odd.clear()
        found = list(map(self.stems.get, stems))
        new = [x for x, ids in zip(stems, found) if ids is None]
        if new:
            self._learn(new)
            found = list(map(self.stems.__getitem__, stems))
        same = np.ones(len(stems), bool)
        if self.odd:
            same[[i for i, x in enumerate(stems) if x in self.odd]] = False
        for x in [x for x in new if len(x) > CACHED_CHARS]:
            del self.stems[x]
        return found, same

    def ids(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text, as ``dtype``; none where their bytes aren't the text's. Texts begin with their space."""
        out: list[bytes | None] = [None] * len(texts)
        fast = [i for i, x in enumerate(texts) if self.chunks and SETTLED(x)]
        split = [self.chunks(texts[i]) for i in fast]
        words = list({w for x in split for w in x})
        found, same = self.ids_of(words)
        known, odd = dict(zip(words, found)), {w for w, ok in zip(words, same) if not ok}
        rest = sorted(set(range(len(texts))) - {i for i, x in zip(fast, split) if odd.isdisjoint(x)})
        for i, x in zip(fast, split):
            if odd.isdisjoint(x):
                out[i] = b"".join(map(known.__getitem__, x))
        for i, ids in zip(rest, self.whole([texts[i] for i in rest]) if rest else []):
            if self._same(ids, texts[i].encode()):
                out[i] = np.array(ids, self.dtype).tobytes()
        return out


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def byte_level(path: str, pattern: str) -> Side:
    """A byte-level BPE of the tokenizers library; ``pattern`` is the one it splits by."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    vocabulary, byte_of = tokenizer.get_vocab(with_added_tokens=True), _byte_of()
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        pieces[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()

    def encode(texts: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    split = regex.compile(pattern).findall
    return Side(split, encode, encode, pieces, split(" ab.") == [" ab", "."])


@lru_cache(maxsize=4)
def sentence_pieces(path: str) -> Side:
    """A model of the sentencepiece library, which adds the space itself.

    If none of its pieces has a space behind another character, or a line feed
    beside anything, texts are cut there. A line feed in front keeps the added space off a chunk.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [bytes([int(x[3:-1], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
    head = model.encode("\n")
    cuts = len(head) == 2 and pieces[head[0]] == b" " and pieces[head[1]] == b"\n" and not any(
        len(x) > 1 and ("▁" in x.lstrip("▁") or "\n" in x) for x in names)

    def encode(chunks: list[str]) -> list[list[int]]:
        return [x[2:] for x in model.encode([f"\n{x}" for x in chunks], num_threads=1)]

    def whole(texts: list[str]) -> list[list[int]]:
        return model.encode([x[1:] for x in texts], num_threads=1)

    joined = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]").search
    apart = cuts and not any(joined(x) for i, x in enumerate(names) if not model.is_byte(i))
    return Side(re.compile("\n| *[^ \n]+| +").findall if cuts else None, encode, whole, pieces, apart)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, compressed by byte planes."""
    head = np.array([x for a in arrays for x in (len(a), a.itemsize)], "<u8").tobytes()
    planes = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays)
    return bytes([len(arrays)]) + head + zstandard.compress(planes, 1)


def unpack(packed: bytes) -> list[np.ndarray]:
    head = np.frombuffer(packed, "<u8", 2 * packed[0], 1).tolist()
    planes, out, at = np.frombuffer(zstandard.decompress(packed[1 + 16 * packed[0]:]), np.uint8), [], 0
    for n, width in zip(head[::2], head[1::2]):
        out.append(np.ascontiguousarray(planes[at:at + n * width].reshape(width, n).T).reshape(-1).view(f"<u{width}"))
        at += n * width
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


DOC = T.StructType([T.StructField("key", T.LongType()), *(T.StructField(x, T.LongType()) for x in ("n_a", "n_b", "n_groups", "n_links")),
                    T.StructField("groups_sha256", T.StringType())])
RUNS = T.StructType([T.StructField("run", T.LongType()), T.StructField("radix", T.IntegerType()), T.StructField("pairs", T.BinaryType()),
                     T.StructField("postings", T.BinaryType()), T.StructField("docs", T.ArrayType(DOC))])
ARROW_DOC = pa.struct([("key", pa.int64()), *((x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string())])
ARROW_RUNS = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary()), ("postings", pa.binary()), ("docs", pa.list_(ARROW_DOC))])


def gathered(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The entries ``at`` of a list of arrays of some ``sizes``, which lie one behind the other in ``flat``, the same way."""
    begins, own = np.cumsum(sizes) - sizes, sizes[at]
    ends = np.cumsum(own)
    return flat[np.arange(own.sum()) + np.repeat(begins[at] - ends + own, own)]


class Aligner:
    """Groups and links of some documents at a time."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        if len(a.pieces) > 1 << 20 or len(b.pieces) > 1 << 20:
            raise ValueError("Ids of more than 20 bits")
        shown = [f"{i}{end}".encode() for i in range(len(a.pieces)) for end in ",|"] + [f"{i}{end}".encode() for i in range(len(b.pieces)) for end in ",;"]
        self.sizes = np.array(list(map(len, shown)))
        self.shown = np.array(shown).view(np.uint8).reshape(len(shown), -1)

    def tokens(self, texts: list[str]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """The numbers of the texts that both tokenizers give back, their ids by each (one behind the other), and how many those are.

        Where white space is single spaces and line feeds, Arrow splits texts into words and tells
        equal ones apart; each distinct word is looked up once for both tokenizers, and ids are gathered by their places.
        """
        plain = [i for i, x in enumerate(texts) if self.a.chunks and self.b.chunks and SETTLED(x) and x[0] not in " \n" and x[-1] not in " \n" and not any(
            y in x for y in ODD_SPACE)]
        places, ids, counts = [], [[], []], [[], []]
        if plain:
            split = pc.split_pattern(pc.replace_substring(pa.array([texts[i] for i in plain]), "\n", " \n"), " ")
            coded = split.flatten().dictionary_encode()
            word, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
            stem, marks = coded.dictionary, pa.array([""] * len(coded.dictionary), pa.string())
            if self.a.marks_apart and self.b.marks_apart:
                cut = pc.extract_regex(stem, MARKED)
                stem, marks = (pc.coalesce(pc.struct_field(cut, i), x) for i, x in enumerate((stem, marks)))
            stem, marks = stem.dictionary_encode(), marks.dictionary_encode()
            known = [w if w[0] == "\n" else " " + w for w in stem.dictionary.to_pylist()]
            # Each distinct word is a stem and marks, each of those a number.
            parts = np.stack((stem.indices.to_numpy(), len(known) + marks.indices.to_numpy()), 1)
            known += marks.dictionary.to_pylist()
            found = [side.ids_of(known) for side in (self.a, self.b)]
            good = np.logical_and.reduceat((found[0][1] & found[1][1])[parts].all(1)[word], ends[:-1])
            words_of = np.diff(ends)
            word, words_of = word[np.repeat(good, words_of)], words_of[good]
            places, plain = [i for i, ok in zip(plain, good) if ok], [i for i, ok in zip(plain, good) if ok]
            for k, (side, (raw, _)) in enumerate(zip((self.a, self.b), found)):
                sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // side.dtype.itemsize
                flat = gathered(np.frombuffer(b"".join(raw), side.dtype), sizes, parts.ravel())
                sizes = sizes[parts].sum(1)
                ids[k].append(gathered(flat, sizes, word).astype(np.int64))
                counts[k].append(np.diff(np.concatenate(([0], np.cumsum(sizes[word])))[np.concatenate(([0], np.cumsum(words_of)))]))
        rest = sorted(set(range(len(texts))) - set(plain))
        raw = [f" {texts[i]}" for i in rest]
        for i, *own in zip(rest, self.a.ids(raw), self.b.ids(raw)):
            if own[0] is not None and own[1] is not None:
                places.append(i)
                for k, side in enumerate((self.a, self.b)):
                    ids[k].append(np.frombuffer(own[k], side.dtype).astype(np.int64))
                    counts[k].append(np.array([len(ids[k][-1])]))
        return places, [np.concatenate(x) if x else np.empty(0, np.int64) for x in ids], [np.concatenate(x) if x else np.empty(0, np.int64) for x in counts]

    def run(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray]:
        """(n_a, n_b, n_groups, n_links, digest) of each text, and all links as one number each."""
        rows: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        some = [i for i, x in enumerate(texts) if x]
        found, (a, b), (of_a, of_b) = self.tokens([texts[i] for i in some])
        if not found:
            return rows, np.empty(0, np.uint64)
        places = [some[i] for i in found]
        last_a, last_b = np.cumsum(of_a), np.cumsum(of_b)
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        # The b token that holds a token's last byte, and so on; equal ends close a group.
        b_of_a = np.searchsorted(ends_b, ends_a)
        shared_a = ends_b[b_of_a] == ends_a
        shared_b = np.zeros(len(b), bool)
        shared_b[b_of_a[shared_a]] = True
        inner = np.flatnonzero(~shared_b)
        linked_a = np.concatenate((np.arange(len(a)), np.searchsorted(ends_a, ends_b[inner])))
        linked_b = np.concatenate((b_of_a, inner))
        # Groups one behind the other, in each its a tokens and then its b tokens.
        upto_a, upto_b = np.flatnonzero(shared_a) + 1, np.flatnonzero(shared_b) + 1
        group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
        written = np.empty(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + np.concatenate(([0], upto_b))[group_a]] = 2 * a + shared_a
        written[np.arange(len(b)) + upto_a[group_b]] = 2 * (len(self.a.pieces) + b) + shared_b
        n_groups = np.diff(np.cumsum(shared_a)[last_a - 1], prepend=0).tolist()
        sizes = self.sizes[written]
        text = self.shown[written][np.arange(self.shown.shape[1]) < sizes[:, None]].tobytes()
        ends = np.cumsum(sizes)[last_a + last_b - 1].tolist()
        for place, n_a, n_b, n, low, high in zip(places, of_a.tolist(), of_b.tolist(), n_groups, [0, *ends], ends):
            rows[place] = (n_a, n_b, n, n_a + n_b - n, hashlib.sha256(text[low:high - 1]).hexdigest())
        slot = np.repeat(np.array(places), of_a)[linked_a]
        side = b[linked_b]
        links = (side & 255) << 56 | (side >> 8) << 44 | a[linked_a] << 24 | slot
        return rows, np.sort(links.view(np.uint64))


def _runs_of(run: int, links: np.ndarray) -> Iterator[tuple]:
    """(run, radix, pairs, postings) of sorted links, a row per radix."""
    starts = np.flatnonzero(np.append(True, links[1:] != links[:-1]))
    times, links = np.diff(np.append(starts, len(links))), links[starts]
    cuts = np.searchsorted(links >> np.uint64(56), np.arange(RADICES + 1))
    for radix, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if x < y:
            own, often = links[x:y], times[x:y]
            pairs = own >> np.uint64(24) & np.uint64((1 << 32) - 1)
            first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
            slots = (own & np.uint64((1 << 24) - 1)).astype(np.int64)
            ahead = _steps(slots)
            ahead[first] = slots[first]
            docs = np.diff(np.append(first, len(own)))
            yield (run, radix, pack(_steps(pairs[first]), np.add.reduceat(often, first).astype("<u8")),
                   pack(docs.astype("<u4"), ahead.astype("<u4"), often.astype("<u4")))


def _write_runs(docs: DataFrame, first: str, second: str, pattern: str, text: str, key: str) -> DataFrame:

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(byte_level(first, pattern), sentence_pieces(second)), TaskContext.get().partitionId() << 32

        def batch(keys: list, texts: list[str | None]) -> pa.RecordBatch:
            rows, links = aligner.run(texts)
            own = [(number, -1, None, None, [dict(zip(DOC.fieldNames(), (k, *row))) for k, row in zip(keys, rows)])]
            own += [(*row, None) for row in (_runs_of(number, links) if len(links) else ())]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*own), ARROW_RUNS)], schema=ARROW_RUNS)

        keys, texts, held = [], [], 0
        for rows in batches:
            for k, value in zip(rows.column(0).to_pylist(), rows.column(1)):
                value = value.as_py()
                if keys and (held + len(value or "") > RUN_CHARS or len(keys) >= RUN_DOCS):
                    yield batch(keys, texts)
                    keys, texts, held, number = [], [], 0, number + 1
                keys.append(k)
                texts.append(value)
                held += len(value or "")
        if keys:
            yield batch(keys, texts)

    return docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text")).mapInArrow(run, RUNS)


Pairs = tuple[np.ndarray, np.ndarray]


def merge(runs: list[Pairs]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of ascending runs and their summed totals, side by side in side order: a k-way merge by a heap of the runs' next sides."""
    cuts = []
    for pairs, _ in runs:
        side = pairs >> np.uint64(20)
        cuts.append(np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1], [True]))).tolist())
    heap = [(int(pairs[0] >> np.uint64(20)), i, 0) for i, (pairs, _) in enumerate(runs) if len(pairs)]
    heapq.heapify(heap)
    while heap:
        side, parts = heap[0][0], []
        while heap and heap[0][0] == side:
            _, i, at = heap[0]
            x, y = cuts[i][at], cuts[i][at + 1]
            parts.append((runs[i][0][x:y], runs[i][1][x:y]))
            if y < len(runs[i][0]):
                heapq.heapreplace(heap, (int(runs[i][0][y] >> np.uint64(20)), i, at + 1))
            else:
                heapq.heappop(heap)
        if len(parts) == 1:
            yield parts[0]
        else:
            pairs, totals = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(pairs, kind="stable")
            pairs, totals = pairs[order], totals[order]
            starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
            yield pairs[starts], np.add.reduceat(totals, starts)


def _one(runs: list[Pairs]) -> Pairs:
    return runs[0] if len(runs) == 1 else tuple(np.concatenate(x) for x in zip(*merge(runs)))


COUNTED = "radix int, counts binary"


def _counts(runs: DataFrame) -> DataFrame:
    """(radix, counts) of (radix, pairs): each radix's pairs, their counts and whether each is its side's highest."""

    def adding(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        held: dict[int, Pairs] = {}
        waiting: dict[int, list[Pairs]] = {}
        sizes: dict[int, int] = {}

        def settle(radix: int) -> None:
            held[radix] = _one(([held[radix]] if radix in held else []) + waiting.pop(radix))
            sizes[radix] = 0

        def out(radix: int) -> pa.RecordBatch:
            if radix in waiting:
                settle(radix)
            pairs, totals = held.pop(radix)
            if whole:
                side = pairs >> np.uint64(20)
                starts = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
                most = np.repeat(np.maximum.reduceat(totals, starts), np.diff(np.append(starts, len(pairs))))
                packed = pack(_steps(pairs), totals, (totals == most).astype(np.uint8))
            else:
                packed = pack(_steps(pairs), totals)
            return pa.RecordBatch.from_arrays([pa.array([radix], pa.int32()), pa.array([packed], pa.binary())], names=["radix", "counts"])

        total = 0
        for rows in batches:
            for radix, packed in zip(rows.column(0).to_pylist(), rows.column(1)):
                steps, totals = unpack(packed.as_py())
                waiting.setdefault(radix, []).append((np.cumsum(steps, dtype=np.uint64), totals))
                sizes[radix] = sizes.get(radix, 0) + len(totals)
                total += len(totals)
                if sizes[radix] > max(100_000, len(held[radix][0]) if radix in held else 0):
                    settle(radix)
                if not whole and total > 4 * HELD:
                    for x in list(waiting.keys() | held.keys()):
                        yield out(x)
                    total = 0
        for x in sorted(waiting.keys() | held.keys()):
            yield out(x)

    some = runs.mapInArrow(lambda batches: adding(batches, False), COUNTED)
    return some.repartitionById(RADICES, F.col("radix")).mapInArrow(lambda batches: adding(batches, True), COUNTED)


def _stream_back(runs: DataFrame, counts: DataFrame, partitions: int) -> DataFrame:
    """(run, sums) of (radix, run, pairs, postings) and (radix, counts): for some radices, what each of the run's documents gets."""
    salts = max(1, -(-partitions // PARTS))
    part = F.floor(F.col("radix") / (RADICES // PARTS)).cast("int")
    none = F.lit(None).cast("binary")
    own = runs.select("radix", F.pmod(F.col("run") + F.shiftright("run", 32), F.lit(salts)).cast("int").alias("salt"), "run", "pairs", "postings")
    copied = counts.select("radix", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(-1).cast("long").alias("run"),
                           F.col("counts").alias("pairs"), none.alias("postings"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        held, pairs, counts, best = 0, None, None, None

        def out() -> pa.RecordBatch:
            rows = [(k, pack(*x)) for k, x in sums.items()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.binary()))], names=["run", "sums"])

        for rows in batches:
            for number, packed, postings in zip(rows.column(0).to_pylist(), rows.column(1), rows.column(2)):
                if number < 0:
                    steps, counts, best = unpack(packed.as_py())
                    pairs = np.cumsum(steps, dtype=np.uint64)
                    continue
                steps, _ = unpack(packed.as_py())
                docs, ahead, times = (x.astype(np.int64) for x in unpack(postings.as_py()))
                at = np.searchsorted(pairs, np.cumsum(steps, dtype=np.uint64))
                # Slots ascend anew in each pair.
                slots, first = np.cumsum(ahead), np.cumsum(docs) - docs
                slots -= np.repeat(np.concatenate(([0], slots))[first], docs)
                size = int(slots.max()) + 1
                if number not in sums:
                    sums[number] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
                if len(sums[number][0]) < size:
                    held += size - len(sums[number][0])
                    sums[number] = tuple(np.concatenate((x, np.zeros(size - len(x), np.uint64))) for x in sums[number])
                times = times.astype(np.uint64)
                np.add.at(sums[number][0], slots, times * np.repeat(counts[at], docs))
                np.add.at(sums[number][1], slots, times * np.repeat(best[at], docs).astype(np.uint64))
                if held > HELD:
                    yield out()
                    held = 0
        if sums:
            yield out()

    dealt = own.union(copied).select("*", (F.col("salt") * PARTS + part).alias("task")).repartitionById(salts * PARTS, F.col("task"))
    return dealt.sortWithinPartitions("radix", "salt", "run").select("run", "pairs", "postings").mapInArrow(run, "run long, sums binary")


RESULT = T.StructType([T.StructField("key", T.LongType()), *(T.StructField(x, T.LongType()) for x in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                       T.StructField("groups_sha256", T.StringType())])


def _gather(docs: DataFrame, back: DataFrame) -> DataFrame:
    """Each run's documents with what they got."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own, sums = None, None, None

        def out() -> pa.RecordBatch:
            columns = {name: own.field(name) for name in DOC.fieldNames()}
            columns["count_sum"], columns["n_best"] = (pa.array(x.view(np.int64)) for x in sums)
            return pa.RecordBatch.from_arrays([columns[x] for x in RESULT.fieldNames()], names=RESULT.fieldNames())

        for rows in batches:
            for number, packed, some in zip(rows.column(0).to_pylist(), rows.column(1), rows.column(2)):
                if number != current:
                    if current is not None:
                        yield out()
                    current, own = number, some.values
                    sums = [np.zeros(len(own), np.uint64) for _ in range(2)]
                else:
                    for total, more in zip(sums, unpack(packed.as_py())):
                        total[:len(more)] += more
        if current is not None:
            yield out()

    both = docs.select("run", F.lit(None).cast("binary").alias("sums"), "docs").unionByName(back.select("run", "sums", F.lit(None).cast(docs.schema["docs"].dataType).alias("docs")))
    return both.repartition("run").sortWithinPartitions("run", F.col("docs").isNull()).mapInArrow(run, RESULT)


def align(docs: DataFrame, first: str, second: str, work: str, *, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row.

    ``first`` is a byte-level tokenizer that splits by ``pattern``, ``second`` a
    sentencepiece model. ``work`` is a new folder that all workers share: the runs and the counts
    are written there, so a lost executor costs a step at most.
    """
    spark = docs.sparkSession
    _write_runs(docs, first, second, pattern, text, key).write.parquet(f"{work}/runs")
    runs = spark.read.schema(RUNS).parquet(f"{work}/runs")
    records = runs.where("radix >= 0")
    _counts(records.select("radix", "pairs")).write.parquet(f"{work}/counts")
    counts = spark.read.schema(COUNTED).parquet(f"{work}/counts")
    back = _stream_back(records, counts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _gather(runs.where("radix < 0").select("run", "docs"), back).withColumnRenamed("key", key)


def pair_counts(spark: SparkSession, work: str) -> DataFrame:
    """(a, b, links, best) that ``align`` counted in ``work``: every linked pair of ids, its links, and whether no a has more with this b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for radix, packed in zip(rows.column(0).to_pylist(), rows.column(1)):
                steps, counts, best = unpack(packed.as_py())
                pairs = np.cumsum(steps, dtype=np.uint64).astype(np.int64)
                columns = [pairs & (1 << 20) - 1, pairs >> 20 << 8 | radix, counts.view(np.int64), best.astype(bool)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["a", "b", "links", "best"])

    return spark.read.schema(COUNTED).parquet(f"{work}/counts").mapInArrow(run, "a long, b long, links long, best boolean")
