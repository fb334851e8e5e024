"""The registered queries and the pipeline, whole rows on a small folder of odd rows and clashing names, against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from ladle.llm import lines, mixing, queries, secrets
from tests.llm.conftest import TEXTS
from tests.llm.test_alignment import brute as brute_alignment
from tests.llm.test_nearcopies import brute_classes
from tests.llm.test_neighbours import brute as brute_neighbours
from tests.llm.test_secrets import brute as brute_secrets
from tests.llm.test_simhash import brute_classes as brute_print_classes
from tests.llm.test_simhash import brute_print
from tests.llm.test_suffixes import brute as brute_repeats

#: Names that operators use for themselves, and some that need quoting.
CLASHING = "domain string, __key long, __of long, __times int, __kept boolean, __spans string, of long, at string, times int, copy int, blob_id string, " \
           "spans string, kept boolean, key long, address string, rate double, `a.b` string, `DOMAIN_` string"


def corpus():
    rng = random.Random(12)
    words = {1: "stone river walks slowly home again quiet evening light".split(), 0: "click buy free now offer deal cheap best price".split()}
    rows = [(i, t) for i, t in TEXTS if i is not None]
    for i in range(100, 220):
        text = " ".join(rng.choices(words[i % 2], k=rng.randint(12, 90))) + "."
        rows.append((i, text.replace(". ", ".\n") if i % 3 else text))
    rows += [(300 + i, rows[40 + i][1]) for i in range(6)] + [(320 + i, rows[50 + i][1] + " more") for i in range(6)]
    passage = "".join(rng.choices("abcdefgh ", k=260))
    rows += [(400, f"{rows[60][1]} {passage}"), (401, f"{passage} {rows[61][1]}"), (402, f'{rows[62][1]} password="hunter2hunter2" and {rows[63][1]}')]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    docs = spark.createDataFrame([(*r, "en", "web", len(r[1] or ""), *["x", 1, 2, 3, True, "y", 4, "z", 5, 6, "b", "s", False, 7, "w", 0.5, "q", "D"]) for r in corpus()],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, None if i % 10 == 3 else 0) for i in range(100, 190)] + [(None, 1, 0), (9999, 0, 1), (105, None, None), (5, 1, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def texts():
    return corpus()


def rows_of(spark, folder, name):
    return queries.QUERIES[name](spark, folder)


def digest(raw):
    return hashlib.sha256(raw).hexdigest()


def library_ids(text):
    ranks = {__import__("base64").b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text)


def test_op1(spark, folder, texts):
    want = []
    for i, t in texts:
        ids = library_ids(t or "")
        want.append((i, len(ids), digest(" ".join(map(str, ids)).encode()), digest((t or "").encode())))
    assert collections.Counter(map(tuple, rows_of(spark, folder, "op1_byte_bpe").collect())) == collections.Counter(want)


def plain_posteriors(texts, labels):
    """Naive Bayes over hashed words as the module says, word by word: (tokens, posterior) of each text."""
    domains = ["good", "poor", "toxic"]

    def words(t):
        return [w for w in re.split(r"[ \t\n\x0b\f\r!-/:-@\[-`{-~]+", (t or "").lower()) if w]

    def bucket(w):
        return xxhash.xxh64_intdigest(w.encode(), 42) % (1 << 16)

    counts, docs_of, total = {d: collections.Counter() for d in domains}, collections.Counter(labels.values()), collections.Counter()
    for i, t in texts:
        if i in labels:
            for w in words(t):
                counts[labels[i]][bucket(w)] += 1
                total[labels[i]] += 1
    share = {d: docs_of[d] / sum(docs_of.values()) for d in domains}
    out = []
    for _, t in texts:
        sums = dict.fromkeys(domains, 0.0)
        for w in words(t):
            logs = {d: math.log((counts[d][bucket(w)] + 0.5) / (total[d] + 0.5 * (1 << 16))) for d in domains}
            for d in domains:
                sums[d] += logs[d] - sum(logs.values()) / 3
        score = {d: sums[d] / 2 + (math.log(share[d]) if share[d] else -1e9) for d in domains}
        top = max(score.values())
        weight = {d: math.exp(score[d] - top) for d in domains}
        n = len(words(t))
        out.append((n, [weight[d] / sum(weight.values()) for d in domains] if n else [share[d] for d in domains]))
    return out


def label_of(quality, toxic):
    return "toxic" if toxic == 1 else "poor" if quality == 0 else "good" if quality == 1 else None


def test_op3(spark, folder, texts):
    known = {i: label_of(i % 2, None if i % 10 == 3 else 0) for i in range(100, 190)} | {5: "good"}
    known = {i: d for i, d in known.items() if d}
    found = {r.doc_id: r for r in rows_of(spark, folder, "op3_soft_mixture").collect()}
    assert sorted(found) == sorted({i for i, _ in texts})
    plain = {i: (n, p) for (i, _), (n, p) in zip(texts, plain_posteriors([x for x in texts], known))}
    assert all(found[i].n_tokens == n for i, (n, _) in plain.items())
    for i, (_, p) in plain.items():
        assert np.allclose([found[i].p_good, found[i].p_poor, found[i].p_toxic], p, atol=1e-9), i
    assert all(0 <= r.rate <= mixing.MOST_RATE and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in found.values())
    # The best that rates within the bounds can do, by plain projected gradient from the posteriors above.
    own = [(n, p) for n, p in plain.values() if n]
    n, p = np.array([x for x, _ in own], float), np.array([x for _, x in own])
    wanted = np.array([queries.TARGETS[d] for d in sorted(queries.TARGETS)]) / sum(queries.TARGETS.values()) * n.sum()
    metric = np.linalg.pinv((p * n[:, None]).T @ p, rcond=1e-9)
    rate = np.ones(len(n))
    for _ in range(20_000):
        rate = np.clip(rate - p @ (metric @ ((rate * n) @ p - wanted)), 0, mixing.MOST_RATE)
    gap = (rate * n) @ p - wanted
    got = np.array([found[i].rate for i, (m, _) in plain.items() if m])
    own_gap = (got * n) @ p - wanted
    assert own_gap @ metric @ own_gap <= gap @ metric @ gap + 1e-6 * n.sum()


def test_op5(spark, folder, texts):
    want = [(i, size, sum(b - a for a, b in spans), len(spans), digest(kept)) for (i, _), (size, spans, kept) in zip(texts, brute_repeats([t for _, t in texts], 200))]
    assert collections.Counter(map(tuple, rows_of(spark, folder, "op5_repeated_bytes").collect())) == collections.Counter(want)
    assert any(w[0] == 400 and w[2] >= 260 for w in want)


def test_op6(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(400)] + [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (None, [1.0] * 16), (503, [1.0, None] + [0.0] * 14)]
    rows += [(600, (np.array(rows[50][1]) * 1e200).tolist()), (601, (np.array(rows[50][1]) * 1e-200).tolist()), (650, (np.array(rows[100][1]) * 1e-160).tolist())]
    spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, part int, id string").repartition(2).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in rows_of(spark, str(tmp_path), "op6_learned_partitions").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    clean = [(i, (np.array(v) / np.abs(v).max()).tolist() if v and None not in v and np.isfinite(v).all() and any(v) else v) for i, v in rows]
    want = brute_neighbours(clean, lambda i: i % 50 == 0, 5)
    assert got.keys() == want.keys() and 600 in got and 650 in got
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in got]) >= 0.9
    scores = {q: dict(x) for q, x in brute_neighbours(clean, lambda i: i % 50 == 0, 1000).items()}
    assert all(abs(s - scores[q][i]) < 1e-9 for q, found in got.items() for i, s in found)


def test_op7(spark, folder, texts):
    kinds = [r.kind for r in secrets.RULES]
    for r in rows_of(spark, folder, "op7_secret_ledger").collect():
        spans = [brute_secrets(t or "") for i, t in texts if i == r.doc_id]
        base = [",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in s) for s in spans]
        assert r.base_sha256 in [digest(b.encode()) for b in base]
        own = spans[[digest(b.encode()) for b in base].index(r.base_sha256)]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in own) for kind in range(3))
        assert set(base[0].split(",")) - {""} <= set(r.spans.split(","))


def test_op8(spark, folder, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, before = [], 0
    ids = [(i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in texts]
    for i, own in sorted(ids, key=lambda x: (x[0], np.array(x[1], "<u2").tobytes())):
        want.append((i, before, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        before += len(own)
    assert sorted(map(tuple, rows_of(spark, folder, "op8_arrow_sequences").collect())) == sorted(want)


def test_op9(spark, folder, texts):
    base = {}
    for i, t in texts:
        own, split = re.findall(r"[^\x20\x09-\x0D]+", t or ""), [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen = collections.Counter(tuple(own[k:k + 5]) for k in range(len(own) - 4))
        repeated = {j for k in range(len(own) - 4) if seen[tuple(own[k:k + 5])] > 1 for j in range(k, k + 5)}
        failed = len(own) < 10 or 100 * len(repeated) > 20 * len(own)
        base.setdefault(i, []).append((len(own), sum(map(len, own)), sum(map((t or "").count, "#*$%&|<>")), len(split) - len(set(split)), len(repeated), failed))
    found = rows_of(spark, folder, "op9_line_quality").collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in texts)
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) in base[r.doc_id] and not (r.base_failed and r.kept) for r in found)
    assert any(r.kept for r in found) and any(r.base_failed for r in found)


def test_op11(spark, folder, texts):
    some = [(i, t) for i, t in texts]
    want, _, _ = brute_alignment([t for _, t in some])
    assert collections.Counter(map(tuple, rows_of(spark, folder, "op11_token_alignment").collect())) == collections.Counter((i, *w) for (i, _), w in zip(some, want))


def test_op12(spark, folder, texts):
    want = brute_print_classes([(i, brute_print(t)) for i, t in texts])
    got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows_of(spark, folder, "op12_simhash_classes").collect()), key=str)
    assert got == want


def test_pipeline(spark, folder, texts):
    """Whole rows of run(): what quality rules keep, one of each class, its redacted text's ids, as often as the rates say."""
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    kept_ids = {(r.doc_id, r.n_words) for r in lines.judge(docs, lines.fit(docs, labels)).where("kept").collect()}
    kept = [(i, t) for i, t in texts if (i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) in kept_ids]
    firsts = {i: least for i, least in brute_classes(kept)}
    left = {}
    for i, t in kept:
        if firsts[i] == i:
            spans, out, at = sorted(brute_secrets(t)), "", 0
            for a, _, b in spans:
                if a >= at:
                    out, at = out + t[at:a] + secrets.MARK, b
                at = max(at, b)
            left[i] = out + t[at:]
    ids = {i: library_ids(t) for i, t in left.items()}
    assert 402 in left and secrets.MARK in left[402]
    assert {(r.doc_id, r.n_tokens, tuple(r.ids)) for r in found} <= {(i, len(x), tuple(x)) for i, x in ids.items()}
    mixed = spark.createDataFrame(list(left.items()), "doc_id long, text string")
    rated = mixing.rates(mixed, mixing.label_domains(labels), queries.TARGETS, queries.scratch_path(spark, "test-rates"))
    want = {r.doc_id: r.n for r in rated.where("n_tokens > 0").select("doc_id", mixing.copies(rated.rate, rated.doc_id).alias("n")).collect()}
    assert collections.Counter(r.doc_id for r in found) == collections.Counter({i: n for i, n in want.items() if n})


def test_stages_keep_clashing_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns, name
        rows = {r.doc_id: (r["a.b"], r.domain, r["DOMAIN_"], r["__kept"], r["__spans"], r["of"], r["rate"]) for r in after.collect()}
        assert set(rows.values()) == {("q", "x", "D", True, "y", 4, 0.5)}, name
