import random
from collections import Counter

import numpy as np

from ladle.llm import suffixes


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = set()
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone.update(range(i, i + length))
        edges = [i for i in range(len(r) + 1) if (i in gone) != (i - 1 in gone)]
        out.append((len(r), list(zip(edges[::2], edges[1::2])), bytes(b for i, b in enumerate(r) if i not in gone)))
    return out


def check(frame, work, **options):
    rows = frame.select("doc_id", "text").collect()
    expected = sorted(((str(r.doc_id), *b) for r, b in zip(rows, brute([r.text for r in rows], options.get("length", 200)))))
    got = sorted((str(r.doc_id), r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in suffixes.remove_repeats(frame, work(), **options).collect())
    assert got == expected
    return got


def test_odd_documents(docs, empty, work):
    check(docs, work)
    assert suffixes.remove_repeats(empty, work()).collect() == []


def test_passages_of_many_lengths(spark, work):
    """Pieces of a few passages, cut and joined at random: repeats of every length, adjacent, nested and overlapping."""
    rng = random.Random(6)
    passages = ["".join(rng.choices("abcdefgé ", k=600)) for _ in range(4)] + ["ab" * 300]
    texts = []
    for _ in range(80):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.append(p[a:a + rng.randint(1, 420)] if rng.random() < 0.7 else "".join(rng.choices("xyz", k=rng.randint(1, 300))))
        texts.append("".join(parts))
    frame = spark.createDataFrame(list(enumerate(texts + texts[:2])), "doc_id long, text string").repartition(4)
    got = check(frame, work)
    assert any(r[2] for r in got) and any(not r[2] for r in got)
    check(frame, work, length=90, gram=24)


def test_long_texts_are_taken_in_parts(spark, work, monkeypatch):
    monkeypatch.setattr(suffixes, "PART", 500)
    rng = random.Random(7)
    long = "".join(rng.choices("abcd", k=2600))
    texts = [long, long[300:1900] + "zz" + long[2000:], "".join(rng.choices("abcd", k=900)), "q" * 1700]
    flat = [(t or "").encode() for t in texts]
    parts = list(suffixes._parts(flat, 200))
    assert sum(int(sizes.sum()) for _, _, sizes, _, _ in parts) == sum(max(0, len(t) - 199) for t in flat)
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2), work)


def test_doubled_up_words_are_told_apart(spark, work):
    """Texts of words w, u doubled into wu, uw some times: a sum modulo 2^64 is equal for such pairs of 128 bytes, yet nothing repeats."""
    rng = random.Random(8)
    texts = []
    for a in "abcdefgh":
        for b in "mnop":
            w, u = a, b
            for _ in range(7):
                w, u = w + u, u + w
            frame = "".join(rng.choices("qrstuvwxyz", k=72))
            texts += [f"{frame[:30]}{w}{frame[30:]}", f"{frame[:30]}{u}{frame[30:]}"]
    assert {len(t) for t in texts} == {200} and len(set(texts)) == len(texts)
    got = check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), work)
    assert all(not spans for _, _, spans, _ in got)


def test_residues():
    rng = random.Random(9)
    prime = int(suffixes.PRIME)
    x, y = ([rng.randrange(prime) for _ in range(500)] + [0, 1, prime - 1, prime - 1] for _ in range(2))
    assert suffixes._times(np.array(x, np.uint64), np.array(y, np.uint64)).tolist() == [a * b % prime for a, b in zip(x, y)]
    _, _, _, high, low, down = suffixes._powers()
    base = int(high[1]) << 31 | int(low[1])
    for i in (0, 1, 2, 77, 100_000, len(down) - 1):
        assert int(high[i]) << 31 | int(low[i]) == pow(base, i, prime) and int(down[i]) == pow(base, -i, prime)
