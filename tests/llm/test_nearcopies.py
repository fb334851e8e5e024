import itertools
import math
import random

import numpy as np

from ladle.llm import nearcopies, queries
from ladle.llm.components import components
from ladle.llm.shingles import WordHashes, shingles
from ladle.plans.registry import table


def plain_similarity(x, y):
    """The probability Jaccard index by its definition; x and y map items to weights."""
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())


def weighted(text, hashes):
    items, weights = shingles(text, 5, hashes)
    return dict(zip(items.tolist(), weights.tolist()))


def brute_classes(rows):
    hashes = WordHashes()
    sets = [weighted(t or "", hashes) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (rows[a][1] or "") == (rows[b][1] or "") or rows[a][0] is not None and rows[a][0] == rows[b][0] or (
                sets[a].keys() & sets[b].keys() and plain_similarity(sets[a], sets[b]) >= 0.8 - 1e-9):
            parent[find(b)] = find(a)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((k for k in keys if k is not None), default=None) for g, keys in groups.items()}
    return [(rows[i][0], least[find(i)]) for i in range(len(rows))]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def corpus():
    """Groups of copies with few to many edits, so that links chain and buckets hold several classes."""
    rng = random.Random(4)
    rows = []
    for group, size in enumerate((60, 8, 3, 2, 1, 1)):
        words = [f"g{group}x{rng.randrange(400)}" for _ in range(150)]
        rows += [edited(rng, words, rng.randrange(9)) for _ in range(size)]
    rows += [rows[0], rows[0], rows[61]]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_similarity():
    rng = random.Random(0)
    for _ in range(100):
        x, y = ({rng.randrange(12): rng.randint(1, 4) for _ in range(rng.randint(1, 9))} for _ in range(2))
        args = [np.array(v) for m in (x, y) for v in (sorted(m), [m[k] for k in sorted(m)])]
        assert abs(nearcopies.similarity(*args) - plain_similarity(x, y)) < 1e-9


def test_registers_estimate_the_similarity():
    rng = random.Random(8)
    for _ in range(4):
        x = {rng.getrandbits(63): rng.randint(1, 3) for _ in range(200)}
        y = {k: v for k, v in x.items() if rng.random() < 0.8} | {rng.getrandbits(63): 1 for _ in range(30)}
        sets = [(np.array(sorted(m), np.uint64), np.array([m[k] for k in sorted(m)])) for m in (x, y)]
        one, other = nearcopies.registers([*sets, (np.empty(0, np.uint64), np.empty(0, int))], 4000)[:2]
        assert abs((one == other).mean() - plain_similarity(x, y)) < 0.04


def test_components(spark, work):
    rng = random.Random(9)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)] + [(5, 5)]
    parent = {x: x for p in links for x in p}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long"), work()).collect()}
    alone = {x for x in parent if all(a == b or x not in (a, b) for a, b in links)}
    assert got == {x: find(x) for x in parent if x not in alone}


def test_classes(spark, docs, empty, work, monkeypatch):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_classes(rows)
    assert sorted(map(tuple, nearcopies.classes(frame, work()).collect())) == sorted(expected)
    monkeypatch.setattr(nearcopies, "BLOCK", 7)  # many blocks in a bucket
    assert sorted(map(tuple, nearcopies.classes(frame, work()).collect())) == sorted(expected)
    kept = nearcopies.keep_one(frame, work()).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c in expected})
    odd = [(d.doc_id, d.text) for d in docs.collect()]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(tuple, nearcopies.classes(docs, work()).collect()), key=key) == sorted(brute_classes(odd), key=key)
    assert nearcopies.keep_one(docs, work()).columns == docs.columns
    assert nearcopies.classes(empty, work()).collect() == []


def test_pairs_at_the_threshold_are_compared_exactly(spark, work):
    """Similarity 0.8025, but fewer than 0.7 of the registers agree."""
    texts = []
    for seed in (6812, 21238):
        rng = random.Random(seed)
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
        other = list(words)
        for i in range(16):
            other[-1 - i] = f"x{rng.randrange(10 ** 6)}"
        texts += [" ".join(words), " ".join(other)]
    hashes = WordHashes()
    signed = nearcopies.registers([shingles(t, 5, hashes) for t in texts], nearcopies.BANDS * nearcopies.ROWS) & np.uint64(255)
    for k in (0, 2):
        assert (signed[k] == signed[k + 1]).mean() < 0.7
        assert plain_similarity(*(weighted(t, hashes) for t in texts[k:k + 2])) >= 0.8
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, nearcopies.classes(frame, work()).collect())) == [(0, 0), (1, 0), (2, 2), (3, 2)]


def test_few_pairs_fail_the_register_test():
    """The share of pairs of similarity 0.8 that are never compared, against what the bands lose."""
    n, x = nearcopies.BANDS * nearcopies.ROWS, nearcopies.SIMILARITY
    lost = sum(math.comb(n, k) * x ** k * (1 - x) ** (n - k) for k in range(n) if k / n < nearcopies.LEAST_AGREEMENT)
    assert lost < 1e-6 < (1 - x ** nearcopies.ROWS) ** nearcopies.BANDS


def test_whole_rows_of_the_query(spark):
    """The registered query, with its own parameters, against all pairs."""
    rows = [(d.doc_id, d.text) for d in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    got = queries.QUERIES["op2_near_copies"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted((i, c, i == c) for i, c in brute_classes(rows))
