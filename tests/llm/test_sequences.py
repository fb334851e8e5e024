import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from ladle.llm import sequences

PATH = P.path("word_bpe_49k.json")
library = Tokenizer.from_file(PATH)


def ids(text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


def test_same_as_the_library():
    own = sequences.word_tokenizer(PATH)
    texts = ["", "The the THE, the.", "don't it's we'll 'sam x's.", "été Été, ÀÉÎ! ß. ÿ", "a\x1cb\x1d c", "é naivé. x́", "a b c\u0085d",
             "<|endoftext|> a<|startoftext|>b", "foo-bar (baz). 12.5, x2; ...!? hello?!", "İstanbul ΑΣ. ΣΑΣ", "東京 タワー。 🙂🙂", "x" * 3000, "a.b,c;d"] * 2
    end = np.array([2], own.dtype).tobytes()
    assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts, end)] == [ids(x) for x in texts]


def test_written_and_read_back(spark, docs, empty, work):
    folder = work()
    manifest = sequences.write_documents(docs, PATH, 2, folder, shards=3, length=16)
    rows = sequences.read(manifest, folder).collect()
    expected = sorted(((d.doc_id if d.doc_id is not None else -1), ids(d.text)) for d in docs.collect())
    got = sorted(((r.doc_id if r.doc_id is not None else -1), np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert got == expected
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
    for r in manifest.collect():
        shard = sequences.Sequences(f"{folder}/{r.file}.arrow")
        batches = [shard.file.get_batch(i) for i in range(shard.file.num_record_batches)]
        n = sum(len(b) for b in batches)
        assert all(len(shard.tokens(i)) == 16 for i in range(n))
        assert sum(shard.mask(i).true_count for i in range(n)) == r.n_tokens
    folder = work()
    assert sequences.read(sequences.write_documents(empty, PATH, 2, folder), folder).collect() == []


def test_crc(spark, docs, work):
    from pyspark.sql import functions as F

    folder = work()
    manifest = sequences.write_documents(docs.where("doc_id = 9"), PATH, 2, folder)
    row = sequences.read(manifest, folder).select(F.crc32("ids").alias("c")).first()
    assert row.c == zlib.crc32(np.array(ids(docs.where("doc_id = 9").first().text), "<u4").tobytes())
