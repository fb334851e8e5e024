import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from ladle.llm import bytebpe, lines, mixing, nearcopies, secrets
from ladle.plans.registry import table

SF = "/root/testdata/sf0.001"


def test_registered(spark):
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(x.startswith(f"op{n}_") for x in names)] == []
    assert "pipeline" in names and "op4_chat_format" in entry.oracle_sql()


def test_stages(spark, work):
    """Each stage against its operator's own decisions."""
    docs, folder, seen = table(spark, SF, "documents"), work(), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        after = spark.read.parquet(f"{folder}/{i}")
        if i + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == docs.columns
        seen.append((docs, after))
        docs = after
    labels = table(spark, SF, "labels")
    before, after = seen[0]
    judged = lines.judge(before, lines.fit(before, labels)).where("kept")
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in judged.collect())
    before, after = seen[1]
    classes = nearcopies.classes(before, work()).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.class_id for r in classes})
    before, after = seen[2]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.n_chars == len(r.text) for r in after.collect())
    spans = {r.doc_id: r.spans for r in secrets.scan(before, work(), work=work()).collect()}
    assert all((r.text == texts[r.doc_id]) == (not spans[r.doc_id]) for r in after.collect())
    before, after = seen[3]
    rated = mixing.rates(before, mixing.label_domains(labels), corpus_pipeline.TARGETS, work())
    assert after.count() == rated.select(mixing.copies(rated.rate, rated.doc_id).alias("n")).agg({"n": "sum"}).first()[0]
    before, after = seen[4]
    own = bytebpe.codec(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken"), corpus_pipeline.public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=corpus_pipeline.public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    assert sorted((r.doc_id, r.ids) for r in after.collect()) == sorted((r.doc_id, library.encode_ordinary(r.text)) for r in before.collect())
