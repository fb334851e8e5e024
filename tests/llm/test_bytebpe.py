import random
import tracemalloc

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ladle.llm import bytebpe

PATH = P.path("byte_bpe_50k.tiktoken")
own = bytebpe.codec(PATH, P.PATTERN)
library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_same_as_the_library(texts):
    texts = [x.encode(errors="ignore").decode() for x in texts]
    assert own.encode(texts) == [library.encode_ordinary(x) for x in texts]


@pytest.mark.parametrize("letters", ["ab", "aab ", "etaoin", "abcdefghijklmnopqrstuvwxyz", "aé́ß "])
def test_long_pre_tokens_and_overlapping_pairs(letters):
    rng = random.Random(letters)
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 400))) for _ in range(200)] + ["a" * 3001, "ab" * 20_000]
    assert own.encode(texts) == [library.encode_ordinary(x) for x in texts]


def test_documents(spark, docs, empty):
    rows = bytebpe.encode(docs, PATH, P.PATTERN, decoded=True).collect()
    assert len(rows) == docs.count()
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in rows) == sorted(
        (str(d.doc_id), library.encode_ordinary(d.text or ""), (d.text or "").encode()) for d in docs.collect())
    again = bytebpe.decode(bytebpe.encode(docs, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in again) == sorted((d.text or "").encode() for d in docs.collect())
    assert bytebpe.encode(empty, PATH, P.PATTERN).collect() == []


def test_kept_pre_tokens_take_little_memory():
    """Beside two Spark tasks and a full heap there is little room: under 200 bytes for each pre-token kept."""
    codec, rng = bytebpe.Codec(PATH, P.PATTERN), random.Random(3)
    words = list({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(40_000)})
    codec.encode(words[:100])
    tracemalloc.start()
    for first in range(0, len(words), 10_000):
        codec.encode([" ".join(words[first:first + 10_000])])
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 200 * len(words)


def test_long_pre_tokens_are_not_kept():
    codec = bytebpe.Codec(PATH, P.PATTERN)
    texts = [x * 40 + " and then" for x in ("abc", "xyz")] * 2 + ["", "abc"]
    for _ in range(2):
        assert codec.encode(texts) == [library.encode_ordinary(x) for x in texts]
    assert max(map(len, codec.numbers)) <= bytebpe.CACHE_PIECE_CHARS and len(codec.flat) == codec.sizes.sum()


def test_chunks_go_on_over_batches(spark, docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "2")
        rows = bytebpe.encode(docs.coalesce(1), PATH, P.PATTERN).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(d.doc_id), library.encode_ordinary(d.text or "")) for d in docs.collect())
