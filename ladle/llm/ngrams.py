"""Interpolated modified Kneser-Ney language model over sorted, memory-mapped arrays.

Words are runs of bytes other than ASCII white space, with A-Z lowered; each text
ends with one end token, which counts. The model has order 2 or 3: p(w | h) discounts
the count of the n-gram and gives the freed mass to the next lower order, which counts
in how many words' company to the left an n-gram is seen, down to single words; these
are discounted in favour of a uniform share for V + 1 words, the last one standing for
every unknown word. One mark stands before each text: nothing is to the left of a pair
with the mark, so in order 3 that pair keeps its plain count, and a text's first word
is scored as a pair.

Counting takes three shuffles, each of arrays that tasks have added up before: words
by ranges of their hash, n-grams by a bijection of their last two words, and what the
n-grams say of words and pairs (contexts before a word; tokens and once, twice, and
more often seen words after a word or pair). Each shard ends as sorted NumPy arrays in
a folder that all workers share. A word's id is its rank among all hashes, a pair is
two ids put through a bijection that spreads pairs evenly, a triple the pair's place
in its shard and the id before it; ids have as many bits as the vocabulary needs.
Scoring maps those files into memory: a worker touches the pages that its texts need.
Only sums over the corpus (a few numbers per shard) reach the driver.

Words are told apart by 64-bit hashes.

Edge cases: a null text is empty, so its one token is the end; a null key counts as
the empty text when the training rows are chosen; repeated rows count and score each;
without training rows all tokens are unknown; an empty table gives an empty result;
other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.llm.arrays import Counts, Keys, add_up, dealt, load, merged, packed_rows, save, save_counts, save_keys, shard_of
from ladle.llm.shingles import mix

#: White space can't be part of a word.
END = xxhash.xxh64_intdigest(b"\n")
#: Bits of a word's id, at most; the id of all ones marks what is before a text's first word.
MOST_BITS = 32
ROUNDS = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
#: Bytes of text counted and scored together.
CHUNK_BYTES = 10_000_000
SCORE_BYTES = 5_000_000
PACKED = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("packed", T.BinaryType()), T.StructField("total", T.LongType()),
                       T.StructField("distinct", T.LongType()), T.StructField("seen", T.ArrayType(T.LongType()))])
PAIR_STATS = ("after", "after1", "after2", "after3")
WORD_STATS = ("before", *PAIR_STATS)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct tokens' hashes, ascending; the place of every token among them; how many tokens each text has.

    Arrow lowers, cuts at ASCII white space and tells words apart, so each distinct word is hashed once.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded = split.flatten().dictionary_encode()
    code, ends = coded.indices.to_numpy(), split.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    data, upto = coded.dictionary.buffers()[2], np.append(0, np.cumsum(pc.binary_length(coded.dictionary).to_numpy(), dtype=np.int64))
    raw, upto = data.to_pybytes() if data else b"", upto.tolist()
    words = list(map(raw.__getitem__, map(slice, upto, upto[1:])))
    used = np.arange(len(words))
    if b"" in words:  # what Arrow sees before, after and instead of words
        blank = words.index(b"")
        there = code != blank
        code, ends, used = code[there], np.append(0, np.cumsum(there))[ends], np.delete(used, blank)
    of_code = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    hashes, place = np.unique(np.append(of_code[used], np.array([END] if len(texts) else [], np.uint64)), return_inverse=True)
    of_all = np.zeros(len(words) + 1, np.int64)
    of_all[used] = place[:len(used)]
    if len(texts):
        of_all[-1] = place[-1]
    return hashes, of_all[np.insert(code, ends[1:], len(words))], np.diff(ends) + 1


def _cuts(texts: pa.Array, size: int) -> list[int]:
    """Where to cut texts into runs of about ``size`` bytes; a longer text stands alone."""
    upto, cuts = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64), [0]
    while cuts[-1] < len(texts):
        before = upto[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(upto, before + size, side="right"))))
    return cuts


def _batch(shards: list[int], packed: list[bytes | None], total: list[int] | None = None, distinct: list[int] | None = None,
           seen: list[list[int]] | None = None) -> pa.RecordBatch:
    none = [None] * len(shards)
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(packed, pa.binary()), pa.array(total or none, pa.int64()),
                                       pa.array(distinct or none, pa.int64()), pa.array(seen or none, pa.list_(pa.int64()))], names=PACKED.fieldNames())


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``tokens`` of whole texts, about ``size`` bytes at a time."""
    held, n = [], 0
    for rows in batches:
        texts = rows.column(0)
        cuts = _cuts(texts, size)
        for first, end in zip(cuts, cuts[1:]):
            some = texts.slice(first, end - first)
            more = pc.sum(pc.binary_length(some)).as_py() or 0
            if held and n + more > size:
                yield tokens(pa.concat_arrays(held))
                held, n = [], 0
            held.append(some)
            n += more
    if held:
        yield tokens(pa.concat_arrays(held))


@dataclass(frozen=True)
class Model:
    """What scoring needs besides the files: ids before each shard of words, and sums over the corpus."""

    folder: str
    shards: int
    order: int
    bits: int
    before: tuple[int, ...]
    tokens: int
    words: int
    pairs: int
    pair_discounts: tuple[float, float, float]
    triple_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_freed: float


class Store:
    """The model's files as seen by one worker."""

    def __init__(self, folder: str, shards: int, before: tuple[int, ...]) -> None:
        self.folder, self.shards, self.before, self.arrays = folder, shards, np.array(before, np.int64), {}

    def array(self, name: str, kind: Callable = Counts) -> Counts | Keys | np.ndarray:
        if name not in self.arrays:
            self.arrays[name] = kind(self.folder, name)
        return self.arrays[name]

    def words(self, hashes: np.ndarray, stats: bool) -> tuple[np.ndarray, np.ndarray]:
        """For ascending hashes: ids (-1: unknown) and a row each of the count and, with ``stats``, what pairs say of it."""
        ids, rows = np.full(len(hashes), -1, np.int64), np.zeros((len(hashes), 1 + len(WORD_STATS)), np.int64)
        cuts = np.searchsorted(shard_of(hashes, self.shards), np.arange(self.shards + 1))
        for shard in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            own = slice(cuts[shard], cuts[shard + 1])
            there = self.array(f"words-{shard}", _hashes)
            if not len(there):
                continue
            at = np.minimum(np.searchsorted(there, hashes[own]), len(there) - 1)
            known = there[at] == hashes[own]
            ids[own] = np.where(known, self.before[shard] + at, -1)
            rows[own, 0] = np.where(known, self.array(f"counts-{shard}").at(at), 0)
            if stats:
                rows[own, 1:] = np.where(known[:, None], self.array(f"stats-{shard}").at(_cells(at, len(WORD_STATS))), 0)
        return ids, rows

    def pairs(self, keys: np.ndarray, bits: int, stats: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For ascending pairs: shards, places there (-1: not seen), counts and, with ``stats``, what triples say of them."""
        shard, places, counts = _pair_shard(keys, bits, self.shards), np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        rows = np.zeros((len(keys), len(PAIR_STATS) if stats else 0), np.int64)
        cuts = np.searchsorted(shard, np.arange(self.shards + 1))
        for own in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            part = slice(cuts[own], cuts[own + 1])
            places[part] = at = self.array(f"pairs-{own}", Keys).find(keys[part])
            seen = np.flatnonzero(at >= 0)
            counts[cuts[own] + seen] = self.array(f"pair-counts-{own}").at(at[seen])
            if stats:
                rows[cuts[own] + seen] = self.array(f"pair-stats-{own}").at(_cells(at[seen], len(PAIR_STATS)))
        return shard, places, counts, rows

    def triples(self, shard: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """How often each triple occurs; shards ascend, and keys in each."""
        counts, cuts = np.zeros(len(keys), np.int64), np.searchsorted(shard, np.arange(self.shards + 1))
        for own in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            at = self.array(f"triples-{own}", Keys).find(keys[cuts[own]:cuts[own + 1]])
            seen = np.flatnonzero(at >= 0)
            counts[cuts[own] + seen] = self.array(f"triple-counts-{own}").at(at[seen])
        return counts


@lru_cache(maxsize=2)
def store(folder: str, shards: int, before: tuple[int, ...]) -> Store:
    return Store(folder, shards, before)


def _hashes(folder: str, name: str) -> np.ndarray:
    return load(folder, name, "<u8")


def _cells(rows: np.ndarray, width: int) -> np.ndarray:
    """The places of whole rows in an array of rows one after the other."""
    return rows[:, None] * width + np.arange(width)


def _bits(words: int) -> int:
    """Bits for the ids of so many words and the mark."""
    bits = max(1, words.bit_length())
    if bits > MOST_BITS:
        raise OverflowError(f"{words} words do not fit ids of {MOST_BITS} bits")
    return bits


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _pair(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Two ids as one key of twice the bits, evenly spread: a Feistel network, so no two pairs share a key."""
    for c in ROUNDS:
        left, right = right, left ^ (mix(right + c) & _mask(bits))
    return left << np.uint64(bits) | right


def _ids(pairs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two ids of each key."""
    left, right = pairs >> np.uint64(bits), pairs & _mask(bits)
    for c in reversed(ROUNDS):
        left, right = right ^ (mix(left + c) & _mask(bits)), left
    return left, right


def _pair_shard(pairs: np.ndarray, bits: int, shards: int) -> np.ndarray:
    return shard_of(pairs << np.uint64(64 - 2 * bits), shards)


def _previous(ids: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """The id before each token of a text, the mark before the first."""
    found = np.empty(len(ids), np.uint64)
    found[1:] = ids[:-1].astype(np.uint64)
    found[np.cumsum(sizes) - sizes] = _mask(bits)
    return found


def _add_triples(pairs: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Equal triples (a pair, the id before it) as one, ascending, their counts added."""
    earlier, counts = columns
    distinct, place = np.unique(pairs, return_inverse=True)
    keys, (counts,) = add_up(place.astype(np.uint64) << np.uint64(MOST_BITS) | earlier, [counts])
    return distinct[(keys >> np.uint64(MOST_BITS)).astype(np.int64)], [keys & _mask(MOST_BITS), counts]


def _after(counts: np.ndarray) -> list[np.ndarray]:
    """What n-grams of these counts add to their contexts, as in PAIR_STATS."""
    return [counts, *((counts == k).astype(np.uint64) for k in (1, 2)), (counts > 2).astype(np.uint64)]


def _seen(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def discounts(seen: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts; where those are too few to tell, 0.5, 0.75 and 0.9."""
    n1, n2, n3, n4 = seen
    if not min(n1, n2, n3, n4):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


def train(docs: DataFrame, folder: str, *, text: str = "text", shards: int | None = None, order: int = 2) -> Model:
    """Counts all of ``docs`` and writes the model's files to ``folder``, a new one that all workers share."""
    if order not in (2, 3):
        raise ValueError(f"order {order} is neither 2 nor 3")
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(docs[text].alias("text"))

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(PACKED).parquet(f"{folder}/{name}")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, at, _ in _chunks(batches, CHUNK_BYTES):
            yield _batch(*packed_rows(shard_of(words, shards), words, [np.bincount(at, minlength=len(words)).astype(np.uint64)]))

    def save_words(shard: int, words: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        save(folder, f"words-{shard}", words.astype("<u8"))
        save_counts(folder, f"counts-{shard}", columns[0])
        yield _batch([shard], [None], [int(columns[0].sum())], [len(words)])

    # A row per shard: this is what the driver gets to see of the vocabulary.
    sums = {r.shard: r for r in kept(dealt(texts.mapInArrow(count_words, PACKED), shards).mapInArrow(merged(save_words, 1), PACKED), "_words").collect()}
    sizes = [sums[i].distinct if i in sums else 0 for i in range(shards)]
    before = tuple(np.cumsum([0, *sizes[:-1]]).tolist())
    bits = _bits(sum(sizes))
    # Shards of the last shuffle: words, the mark, pairs, sums over the corpus.
    mark, pairs_from, of_all = shards, shards + 1, 2 * shards + 1

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = store(folder, shards, before)
        for words, at, sizes in _chunks(batches, CHUNK_BYTES):
            ids = own.words(words, False)[0][at].astype(np.uint64)
            left = _previous(ids, sizes, bits)
            pairs, place, counts = np.unique(_pair(left, ids, bits), return_inverse=True, return_counts=True)
            columns = [counts.astype(np.uint64)]
            if order == 3:
                triples, counts = np.unique(place.astype(np.uint64) << np.uint64(bits) | _previous(left, sizes, bits), return_counts=True)
                pairs, columns = pairs[(triples >> np.uint64(bits)).astype(np.int64)], [triples & _mask(bits), counts.astype(np.uint64)]
            yield _batch(*packed_rows(_pair_shard(pairs, bits, shards), pairs, columns))

    def save_grams(shard: int, pairs: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        counts, seen = columns[-1], [0] * 4
        if order == 3:
            earlier, begins = columns[0], np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
            kinds = np.diff(begins, append=len(pairs))
            place, pairs = np.repeat(np.arange(len(begins), dtype=np.uint64), kinds), pairs[begins]
            left, word = _ids(pairs, bits)
            first = left == _mask(bits)
            inside = np.flatnonzero(~np.repeat(first, kinds))
            earlier, place, of_triples = earlier[inside], place[inside], counts[inside]
            counts = np.where(first, counts[begins], kinds.astype(np.uint64))
            save_keys(folder, f"triples-{shard}", place << np.uint64(bits) | earlier)
            save_counts(folder, f"triple-counts-{shard}", of_triples)
            seen = _seen(of_triples)
            contexts, stats = add_up(_pair(earlier, left[place.astype(np.int64)], bits), _after(of_triples))
            yield _batch(*packed_rows(pairs_from + _pair_shard(contexts, bits, shards), contexts, [np.zeros(len(contexts), np.uint64), *stats]))
        else:
            left, word = _ids(pairs, bits)
        save_keys(folder, f"pairs-{shard}", pairs)
        save_counts(folder, f"pair-counts-{shard}", counts)
        told = np.array([len(pairs), *_seen(counts), *seen], np.uint64)
        yield _batch(*packed_rows(np.full(len(told), of_all), np.arange(len(told), dtype=np.uint64), [told] + [np.zeros(len(told), np.uint64)] * len(PAIR_STATS)))
        one, nothing = np.ones(len(pairs), np.uint64), np.zeros(len(pairs), np.uint64)
        ids, stats = add_up(np.concatenate((word, left)), [np.concatenate((a, b)) for a, b in zip([one, *[nothing] * 4], [nothing, *_after(counts)])])
        of = np.searchsorted(np.array(before), ids.astype(np.int64), side="right") - 1
        yield _batch(*packed_rows(np.where(ids == _mask(bits), mark, of), ids, stats))

    def save_stats(shard: int, ids: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if shard == of_all:
            yield _batch([shard], [None], [None], [None], [columns[0].tolist()])
            return
        if shard >= pairs_from:
            there = Keys(folder, f"pairs-{shard - pairs_from}")
            rows = np.zeros((len(there), len(PAIR_STATS)), np.uint64)
            rows[there.find(ids)] = np.stack(columns[1:], 1)
            save_counts(folder, f"pair-stats-{shard - pairs_from}", rows.reshape(-1))
            return
        rows = np.zeros((1 if shard == mark else sizes[shard], len(WORD_STATS)), np.uint64)
        rows[np.zeros(1, np.int64) if shard == mark else ids.astype(np.int64) - before[shard]] = np.stack(columns, 1)
        save_counts(folder, f"stats-{shard}", rows.reshape(-1))
        contexts = rows[:, 0][rows[:, 0] > 0]
        over = [int((contexts == 1).sum()), int((contexts == 2).sum()), int((contexts > 2).sum())]
        yield _batch([shard], [None], [None], [None], [_seen(contexts) + over])

    grams = dealt(texts.mapInArrow(count_grams, PACKED), shards)
    grams = grams.mapInArrow(merged(save_grams, 1) if order == 2 else merged(save_grams, 2, add=_add_triples), PACKED)
    stats = kept(dealt(grams, of_all + 1).mapInArrow(merged(save_stats, len(WORD_STATS)), PACKED), "_stats")
    of_words = stats.where(F.col("shard") < mark).agg(*[F.coalesce(F.sum(F.get("seen", F.lit(i))), F.lit(0)).alias(f"s{i}") for i in range(7)]).first()
    pairs, *seen = next((r.seen for r in stats.where(F.col("shard") == of_all).collect()), [0] * 9)
    word_discounts = discounts(list(of_words[:4]))
    freed = sum(d * n for d, n in zip(word_discounts, of_words[4:])) / max(1, pairs)
    return Model(folder, shards, order, bits, before, sum(r.total for r in sums.values()), sum(sizes), pairs, discounts(seen[:4]), discounts(seen[4:]),
                 word_discounts, freed)


def _discount(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    """The discount of each count."""
    return np.array((0.0, *by))[np.minimum(counts, 3)]


def _log_shares(model: Model, own: Store, words: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: whether it is known, the base log10 share, the model's log10 probability."""
    ids, rows = own.words(words, True)
    count, before = rows[:, 0], rows[:, 1]
    base = np.log10((count + 1) / (model.tokens + model.words + 1))
    if not model.tokens:
        return np.zeros(len(at), bool), base[at], base[at]
    low = (before - _discount(before, model.word_discounts)) / model.pairs + model.word_freed / (model.words + 1)
    starts = np.cumsum(sizes) - sizes
    known = ids[at] >= 0
    keys = np.where(known, ids[at], 0).astype(np.int64)
    left = _previous(keys, sizes, model.bits)
    context_known = np.append(True, known[:-1])
    context_known[starts] = True
    usable = known & context_known
    distinct, back = np.unique(_pair(left[usable], keys[usable].astype(np.uint64), model.bits), return_inverse=True)
    shard, places, pair_counts, pair_stats = own.pairs(distinct, model.bits, model.order == 3)
    counts = np.zeros(len(at), np.int64)
    counts[usable] = pair_counts[back]
    after = rows[:, 2:][np.append(at[:1], at[:-1])]
    after[starts] = own.array(f"stats-{model.shards}").at(np.arange(len(WORD_STATS)))[1:]
    share = _share(counts, after, model.pair_discounts, low[at])
    if model.order == 3:
        pair = np.full(len(at), -1, np.int64)
        pair[usable] = np.where(places >= 0, np.arange(len(places)), -1)[back]
        context = np.append(-1, pair[:-1])
        context[starts] = -1
        seen = np.flatnonzero(context >= 0)
        there = seen[pair[seen] >= 0]
        triples, back = np.unique(pair[there].astype(np.uint64) << np.uint64(model.bits) | left[there - 1], return_inverse=True)
        ends = (triples >> np.uint64(model.bits)).astype(np.int64)
        counts = np.zeros(len(at), np.int64)
        counts[there] = own.triples(shard[ends], places[ends].astype(np.uint64) << np.uint64(model.bits) | triples & _mask(model.bits))[back]
        share[seen] = _share(counts[seen], pair_stats[context[seen]], model.triple_discounts, share[seen])
    return known, base[at], np.log10(share)


def _share(counts: np.ndarray, after: np.ndarray, by: tuple[float, float, float], lower: np.ndarray) -> np.ndarray:
    """An order's probabilities from its counts, its contexts' rows and the lower order's probabilities."""
    total = after[:, 0]
    return np.where(total > 0, (counts - _discount(counts, by) + after[:, 1:] @ np.array(by) * lower) / np.maximum(total, 1), lower)


def score(docs: DataFrame, model: Model, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) of each row: sums of log10 shares over its tokens."""
    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = store(model.folder, model.shards, model.before)
        for rows in batches:
            cuts = _cuts(rows.column(1), SCORE_BYTES)
            for first, end in zip(cuts, cuts[1:]):
                words, at, n = tokens(rows.column(1).slice(first, end - first))
                starts = np.cumsum(n) - n
                known, base, share = _log_shares(model, own, words, at, n)
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(first, len(n)), pa.array(n), pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                                                  pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(share, starts))], names=schema.fieldNames())

    return docs.select(docs[key], docs[text]).mapInArrow(score_batches, schema)


def held_out(key: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether a row is kept from training, by the CRC-32 of its key as text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold
