import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ladle.llm import alignment

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  x ", "\n", "a\nb\n\n c", "é東🙂 \n\tx<|endoftext|> <s> </s> <unk>", "▁x", "a b", "x" * 3000, "a\x1cb \x85c", "ﬁ Å", "  word x",
       "it's we'll 12345 $%^ \t\t end  ", "\r\n \r\n", "word " * 50, "one two one two one"]


def brute(texts):
    """The contract's columns of each text, token by token."""
    first, second = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
    first.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    own, links = [], []
    for text in texts:
        own.append((0, 0, 0, 0, ""))
        links.append([])
        if not text:
            continue
        a, b = first.encode(" " + text, add_special_tokens=False), second.encode(text)
        of_a = [bytes(byte_of[c] for c in t) for t in a.tokens]
        of_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
            continue
        spans_a, spans_b = ([(e - len(x), e) for x, e in zip(of, np.cumsum([len(x) for x in of]).tolist())] for of in (of_a, of_b))
        ends = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups = [",".join(str(i) for i, (_, e) in zip(a.ids, spans_a) if low < e <= high) + "|" + ",".join(str(i) for i, (_, e) in zip(b, spans_b) if low < e <= high)
                  for low, high in zip([0, *ends], ends)]
        links[-1] = [(i, j) for i, x in zip(a.ids, spans_a) for j, y in zip(b, spans_b) if x[0] < y[1] and y[0] < x[1]]
        own[-1] = (len(a.ids), len(b), len(groups), len(links[-1]), hashlib.sha256(";".join(groups).encode()).hexdigest())
    counts = collections.Counter(x for one in links for x in one)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(n, most.get(j, 0))
    return [(*x[:4], sum(counts[p] == most[p[1]] for p in one), sum(counts[p] for p in one), x[4]) for x, one in zip(own, links)], counts, most


@pytest.mark.parametrize("chars, radix_pairs", [(4_000_000, 2_000_000), (30, 1)])
def test_alignment(spark, docs, work, monkeypatch, chars, radix_pairs):
    """Whole rows against the token-by-token version: in one run or many, added up at once or handed on at every pair."""
    monkeypatch.setattr(alignment, "RUN_CHARS", chars)
    monkeypatch.setattr(alignment, "HELD", radix_pairs)
    rows = [(i % 5 if i % 7 else None, x) for i, x in enumerate(ODD * 2)] + [(r.doc_id, r.text if len(r.text or "") < 5000 else r.text[:900]) for r in docs.select("doc_id", "text").collect()]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, run long, key string, radix int").repartition(3)
    folder = work()
    found = alignment.align(table, FIRST, SECOND, folder, pattern=public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, counts, most = brute([x for _, x in rows])
    assert collections.Counter(map(tuple, found.collect())) == collections.Counter((k, *x) for (k, _), x in zip(rows, want))
    pairs = alignment.pair_counts(spark, folder).collect()
    assert {(r.a, r.b): r.links for r in pairs} == dict(counts) and all(r.best == (r.links == most[r.b]) for r in pairs)


def test_empty(spark, empty, work):
    assert alignment.align(empty, FIRST, SECOND, work(), pattern=public_tokenizers.PATTERN).collect() == []


def test_packing():
    arrays = [np.array([1, 2, 1 << 40], np.uint64), np.array([], np.uint32), np.arange(300, dtype=np.uint16)]
    assert [x.tolist() for x in alignment.unpack(alignment.pack(*arrays))] == [x.tolist() for x in arrays]


def test_merge():
    rng = np.random.default_rng(3)
    runs, total = [], collections.Counter()
    for _ in range(9):
        pairs, n = np.unique((rng.integers(0, 6, 40) << 20 | rng.integers(0, 9, 40)).astype(np.uint64), return_counts=True)
        runs.append((pairs, n.astype(np.uint64)))
        total.update(dict(zip(pairs.tolist(), n.tolist())))
    runs.append((np.empty(0, np.uint64), np.empty(0, np.uint64)))
    parts = list(alignment.merge(runs))
    assert [len(set((p >> np.uint64(20)).tolist())) for p, _ in parts] == [1] * 6
    assert list(zip(*(np.concatenate(x).tolist() for x in zip(*parts)))) == sorted(total.items())
