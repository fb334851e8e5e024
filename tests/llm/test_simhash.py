import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from ladle.llm import simhash

SIGN = 1 << 63


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    """(key, print, least key reachable) of rows (key, print)."""
    prints = sorted({p for _, p in rows})
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            parent[find(a)] = find(b)
    least = {}
    for key, p in rows:
        if key is not None:
            least[find(p)] = min(key, least.get(find(p), key))
    return sorted(((key, p, least.get(find(p))) for key, p in rows), key=str)


def signed(x):
    return x - (SIGN << 1) if x >= SIGN else x


def classes_of(found):
    return sorted(((r[0], r[1] % (SIGN << 1), r[2]) for r in found.collect()), key=str)


@pytest.mark.parametrize("piece", [1 << 20, 7, 40])
def test_fingerprints(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE_BYTES", piece)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices(["a ", "B", "É", "\n", "\x1c", "xyz ", " ", "\t", "Q. "], k=rng.randrange(120)))
        assert simhash.fingerprint(text.encode()) == brute_print(text)


def test_classes_of_texts(spark, docs, empty, work):
    found = simhash.classes(docs, work())
    assert classes_of(found) == brute_classes([(r.doc_id, brute_print(r.text)) for r in docs.select("doc_id", "text").collect()])
    assert simhash.classes(empty, work()).collect() == []


def planted(rng):
    """Chains and clusters of fingerprints, some of many that share a half, beside strangers."""
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(12):
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                at ^= 1 << bit
            prints.append(at)
    for shift in (0, 32):  # one half in common, the other near, far or one bit off
        half, other = rng.getrandbits(32), rng.getrandbits(32)
        for _ in range(120):
            own = other
            for bit in rng.sample(range(32), rng.randint(0, 7)):
                own ^= 1 << bit
            prints.append((half ^ rng.choice([0, 0, 1 << 5, 1 << 31, 3])) << shift | own << (32 - shift))
    return prints + [0, 1, 7, 15, SIGN, SIGN | 1]


@pytest.mark.parametrize("crowd, large", [(8192, 4096), (1, 4096), (3, 2), (40, 8)])
def test_classes_of_fingerprints(spark, work, monkeypatch, crowd, large):
    """All links are found, in crowded halves too."""
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = random.Random(crowd)
    rows = [(rng.choice([i, i, i, None]), p) for i, p in enumerate(planted(rng) * 2)]
    prints = spark.createDataFrame([(k, signed(p)) for k, p in rows], "key long, print long").repartition(3)
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, **_: docs)
    assert classes_of(simhash.classes(prints, work(), crowd=crowd)) == brute_classes(rows)


def test_filed_nodes_meet(spark):
    """Any two fingerprints of three differing bits or fewer share a variant, crowded or not; a stranger rarely."""
    rng = random.Random(9)
    pairs = []
    for _ in range(150):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            b ^= 1 << bit
        pairs.append((a, b))
    nodes = spark.createDataFrame([(signed(x),) for p in pairs for x in p], "print long").distinct()
    for crowd in (8192, 1):
        variants = {}
        for r in simhash.filed(nodes, crowd).collect():
            variants.setdefault(r.print % (SIGN << 1), set()).add(r.variant)
        assert all(variants[a] & variants[b] for a, b in pairs)
        assert sum(bool(variants[a] & variants[d]) for (a, _), (_, d) in itertools.combinations(pairs, 2)) == 0
        assert {len(x) for x in variants.values()} == ({64} if crowd > 1 else {2048})


@pytest.mark.parametrize("n", [10, 100, 700])
def test_large_groups_by_masks(monkeypatch, n):
    rng = np.random.default_rng(n)
    base = int(rng.integers(0, 1 << 63))
    nodes = np.unique(np.array([base ^ sum(1 << int(x) for x in rng.choice(20, rng.integers(0, 6), replace=False)) for _ in range(n)], np.uint64))

    def joined(a, b):
        return {frozenset(map(int, x)) for x in zip(nodes[a], nodes[b])}

    plain = simhash._in_group(nodes, None)
    monkeypatch.setattr(simhash, "LARGE", 1)
    assert joined(*plain) == joined(*simhash._in_group(nodes, np.arange(20)))
