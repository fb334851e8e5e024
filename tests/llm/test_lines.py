import itertools
import random
import re

import numpy as np

from ladle.llm import lines


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    earlier, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in earlier
            earlier.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_base_counts(docs, empty):
    rng = random.Random(3)
    texts = [" ".join(rng.choices("ab", k=rng.randint(0, 40))) for _ in range(200)]
    for text in texts:
        assert lines.repeated_words(text.split()) == brute(text)[4]
    rows = lines.judge(docs, lines.ALL_CONTENT).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in rows)
    assert got == sorted((str(d.doc_id), *(b := brute(d.text or "")), not b[-1]) for d in docs.collect())
    assert lines.judge(empty, lines.ALL_CONTENT).collect() == []


def test_viterbi_is_the_best_path():
    rng = random.Random(5)
    for n in range(1, 8):
        field = lines.Field((0.0,) * lines.FEATURES, tuple(tuple(rng.uniform(-2, 2) for _ in range(2)) for _ in range(2)))
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        value = lambda path: sum(s for s, y in zip(scores, path) if y) + sum(field.transition[a][b] for a, b in zip(path, path[1:]))
        assert abs(value(field.decode(scores)) - max(map(value, itertools.product((0, 1), repeat=n)))) < 1e-9
    assert lines.Field((0.0,) * lines.FEATURES, ((0.0, 0.0), (0.0, 0.0))).decode([]) == []


def test_held_out_accuracy(spark):
    """Two kinds of documents; every other one is held out."""
    rng = random.Random(1)
    good = [" ".join(rng.choices("the of a river stone walks slowly home again".split(), k=12)).capitalize() + "." for _ in range(600)]
    poor = ["BUY NOW!! $$$ " + " ".join(rng.choices("CLICK HERE FREE *** 100% |".split(), k=6)) for _ in range(600)]
    text = {i: "\n".join(rng.sample(good if i % 2 else poor, 8)) for i in range(400)}
    docs = spark.createDataFrame([(i, t) for i, t in text.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in text if i % 4 < 2] + [(None, 1), (7000, 0)], "doc_id long, quality int")
    field = lines.fit(docs, labels)
    rows = [r for r in lines.judge(docs, field).collect() if r.doc_id % 4 >= 2]
    assert np.mean([(r.content_share > 0.5) == (r.doc_id % 2 == 1) for r in rows]) > 0.97
    assert {r.doc_id for r in lines.keep(docs, field).collect()} == {r.doc_id for r in lines.judge(docs, field).collect() if r.kept}
    assert lines.fit(docs, labels.where("quality = 1")) == lines.ALL_CONTENT
