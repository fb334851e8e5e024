import math
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ladle.llm import arrays, ngrams, queries
from ladle.plans.registry import table

SF = "/root/testdata/sf0.001"


def brute(rows, train):
    split = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    words, pairs = Counter(), Counter()
    for i, w in split:
        if train(i):
            words.update(w)
            pairs.update(zip([None] + w[:-1], w))
    n, v = sum(words.values()), len(words)
    before, total, kinds = Counter(y for _, y in pairs), Counter(), defaultdict(lambda: [0, 0, 0])
    for (x, _), c in pairs.items():
        total[x] += c
        kinds[x][min(c, 3) - 1] += 1
    seen = lambda counts: [Counter(counts)[k] for k in (1, 2, 3, 4)]
    d2, d1 = ngrams.discounts(seen(pairs.values())), ngrams.discounts(seen(before.values()))
    off = lambda c, d: (0, *d)[min(c, 3)]
    freed = sum(off(c, d1) for c in before.values()) / max(1, len(pairs))
    low = lambda w: (before[w] - off(before[w], d1)) / len(pairs) + freed / (v + 1)

    def share(h, w):
        if not total[h]:
            return low(w)
        c = pairs[h, w]
        return (c - off(c, d2) + sum(a * b for a, b in zip(d2, kinds[h])) * low(w)) / total[h]

    out = []
    for i, w in split:
        base = sum(math.log10((words[x] + 1) / (n + v + 1)) for x in w)
        out.append((str(i), len(w), sum(x in words for x in w), base, sum(math.log10(share(h, x)) for h, x in zip([None] + w[:-1], w)) if n else base))
    return sorted(out), n, (share, list(words), total)


def same(got, expected):
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3:] for g in got], [e[3:] for e in expected], rtol=1e-9)


def test_against_plain_counting(spark, docs, empty, work):
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    rows = [(d.doc_id, d.text) for d in docs.collect()]
    model = ngrams.train(docs.where(~ngrams.held_out(F.col("doc_id"))), work())
    expected, n, (share, words, total) = brute(rows, lambda i: not held(i))
    assert model.tokens == n and model.words == len(words)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ngrams.score(docs, model).collect())
    same(got, expected)
    for context in list(total) + [b"never seen"]:  # probabilities add up to 1 with one unknown word
        assert abs(sum(share(context, w) for w in words) + share(context, b"no such word") - 1) < 1e-9
    assert ngrams.score(empty, model).collect() == []
    none = ngrams.train(empty, work())
    same(sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ngrams.score(docs, none).collect()), brute(rows, lambda i: False)[0])


def test_packing():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    counts = rng.integers(1, 9, len(keys)).astype(np.uint64)
    back, (same_counts,) = arrays.unpack(arrays.pack(keys, [counts]), 1)
    assert (back == keys).all() and (same_counts == counts).all()
    twice, (double,) = arrays.add_up(np.concatenate((keys, keys)), [np.concatenate((counts, counts))])
    assert (twice == keys).all() and (double == 2 * counts).all()


def test_better_than_single_words_on_held_out_text(spark, work):
    rows = [(i, " ".join(f"w{(i + k * 7) % 40}" for k in range(60))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = docs.where(ngrams.held_out(F.col("doc_id")))
    model = ngrams.train(docs.where(~ngrams.held_out(F.col("doc_id"))), work())
    sums = ngrams.score(held, model).agg(F.sum("base_score"), F.sum("score")).first()
    assert sums[1] > 0.8 * sums[0]


def brute_of_order_3(rows, train):
    """Plain counting; a pair with the mark before a text keeps its count, other lower orders count what is to their left."""
    split = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    words, triples, firsts = Counter(), Counter(), Counter()
    for i, w in split:
        if train(i):
            words.update(w)
            firsts[None, w[0]] += 1
            triples.update(zip([None] + w, w, w[1:]))
    n, v = sum(words.values()), len(words)
    pairs = Counter((y, z) for _, y, z in triples) + firsts
    before = Counter(z for _, z in pairs)
    seen = lambda counts: [Counter(counts)[k] for k in (1, 2, 3, 4)]
    by = [ngrams.discounts(seen(c.values())) for c in (before, pairs, triples)]
    off = lambda c, d: (0, *d)[min(c, 3)]

    def contexts(grams):
        total, kinds = Counter(), defaultdict(lambda: [0, 0, 0])
        for (*h, _), c in grams.items():
            total[tuple(h)] += c
            kinds[tuple(h)][min(c, 3) - 1] += 1
        return total, kinds

    after, freed = {2: contexts(pairs), 3: contexts(triples)}, sum(off(c, by[0]) for c in before.values()) / len(pairs)

    def share(h, w):
        """The probability of ``w`` after the words ``h``, two at most."""
        if not h:
            return (before[w] - off(before[w], by[0])) / len(pairs) + freed / (v + 1)
        lower, (total, kinds), grams = share(h[1:], w), after[len(h) + 1], (pairs, triples)[len(h) - 1]
        c, d = grams[(*h, w)], by[len(h)]
        return (c - off(c, d) + sum(a * b for a, b in zip(d, kinds[h])) * lower) / total[h] if total[h] else lower

    out = []
    for i, w in split:
        score = sum(math.log10(share(tuple(([None] + w)[max(0, k - 1):k + 1]), x)) for k, x in enumerate(w))
        out.append((str(i), len(w), sum(x in words for x in w), sum(math.log10((words[x] + 1) / (n + v + 1)) for x in w), score))
    return sorted(out), (share, list(words), list(after[3][0]))


def test_order_3_against_plain_counting(spark, docs, empty, work):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"v{min(x, 30)}" for x in rng.zipf(1.4, rng.integers(0, 40))) for _ in range(200)]
    texts[50:55] = ["v1 v2 " * 400] * 5  # counts that a byte can't hold
    many = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    for frame in (many, docs):
        expected, (share, words, contexts) = brute_of_order_3([(d.doc_id, d.text) for d in frame.collect()], lambda i: not held(i))
        for shards in (1, 5):
            model = ngrams.train(frame.where(~ngrams.held_out(F.col("doc_id"))), work(), shards=shards, order=3)
            same(sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ngrams.score(frame, model).collect()), expected)
        for context in contexts[:50]:
            assert abs(sum(share(context, w) for w in words) + share(context, b"no such word") - 1) < 1e-9
    none = ngrams.train(empty, work(), order=3)
    same(sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ngrams.score(docs, none).collect()),
         brute([(d.doc_id, d.text) for d in docs.collect()], lambda i: False)[0])


def test_a_longer_context_tells_more(spark, work):
    """What follows ``b`` depends on the word before it, which a model of pairs can't see."""
    docs = spark.createDataFrame([(i, "a b c " * 20 if i % 2 else "d b e " * 20) for i in range(60)], "doc_id long, text string")
    two, three = (ngrams.score(docs, ngrams.train(docs, work(), order=n)).agg(F.sum("score")).first()[0] for n in (2, 3))
    assert three > 0.6 * two


def test_keys_are_found():
    rng = np.random.default_rng(1)
    for top, n in ((1 << 36, 4000), (1 << 63, 3000), (1 << 20, 900), (1 << 45, 1)):
        keys = np.unique(rng.integers(0, top, n).astype(np.uint64))
        with tempfile.TemporaryDirectory() as folder:
            arrays.save_keys(folder, "keys", keys)
            found = arrays.Keys(folder, "keys")
            for asked in (keys, np.unique(np.concatenate((keys[::7], keys[::5] + np.uint64(1), rng.integers(0, top, 50).astype(np.uint64)))), keys[:3]):
                place = dict(zip(keys.tolist(), range(len(keys))))
                assert found.find(asked).tolist() == [place.get(k, -1) for k in asked.tolist()]
    for bits in (1, 5, 21, 32):
        left, right = (rng.integers(0, 1 << bits, 500).astype(np.uint64) for _ in range(2))
        back = ngrams._ids(ngrams._pair(left, right, bits), bits)
        assert (back[0] == left).all() and (back[1] == right).all()


def test_large_counts_are_kept_whole():
    counts = [3, 254, 255, 2 ** 32 - 1, 2 ** 32, 2 ** 40 + 7]
    hashes = np.arange(10, 10 + len(counts)).astype(np.uint64)
    stats = np.array(counts * 5, np.uint64).reshape(-1, 5)
    with tempfile.TemporaryDirectory() as folder:
        arrays.save(folder, "words-0", hashes)
        arrays.save_counts(folder, "counts-0", np.array(counts, np.uint64))
        arrays.save_counts(folder, "stats-0", stats.reshape(-1))
        arrays.save_keys(folder, "pairs-0", hashes)
        arrays.save_counts(folder, "pair-counts-0", np.array(counts, np.uint64))
        own = ngrams.Store(folder, 1, (0,))
        rows = own.words(hashes, True)[1]
        assert rows[:, 0].tolist() == counts and (rows[:, 1:] == stats).all()
        assert own.pairs(hashes, 32, False)[2].tolist() == counts


def test_too_many_words_raise():
    assert ngrams._bits(2 ** 32 - 1) == 32 and ngrams._mask(32) == 2 ** 32 - 1  # ids up to 2 ** 32 - 2, then the mark
    with pytest.raises(OverflowError):
        ngrams._bits(2 ** 32)


def test_whole_rows_of_the_query(spark):
    """The registered query, with its own parameters, against plain counting."""
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    rows = [(d.doc_id, d.text) for d in table(spark, SF, "documents").select("doc_id", "text").collect()]
    expected, _ = brute_of_order_3(rows, lambda i: not held(i))
    got = queries.QUERIES["op10_kneser_ney"](spark, SF).collect()
    same(sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in got), expected)
    assert all(r.held_out == held(r.doc_id) for r in got)
    assert {r.train_tokens for r in got} == {sum(e[1] for e in expected if not held(e[0]))}


def test_each_distinct_word_is_hashed_once(monkeypatch):
    """Splitting, lowering and hashing go by distinct words, and white space counts as ``bytes.split`` has it."""
    texts = [" A b\t", "", None, "\x0b \n", "b\x1cc B É é a" + " a" * 500, "x\r\ny\x85z w\x0c"]
    split = [(x or "").encode().lower().split() + [b"\n"] for x in texts]
    asked = []
    monkeypatch.setattr(ngrams, "xxhash", type("X", (), {"xxh64_intdigest": staticmethod(lambda w: asked.append(w) or xxhash.xxh64_intdigest(w))}))
    for column in (pa.array(texts), pa.array(["skipped", *texts]).slice(1)):
        asked.clear()
        hashes, at, sizes = ngrams.tokens(column)
        assert len(asked) == len(set(asked))
        assert sizes.tolist() == [len(x) for x in split]
        assert hashes[at].tolist() == [xxhash.xxh64_intdigest(w) for x in split for w in x]
        assert hashes.tolist() == sorted(set(hashes[at].tolist()))
    assert [len(x) for x in ngrams.tokens(pa.array([], pa.string()))] == [0, 0, 0]
