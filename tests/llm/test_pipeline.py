"""The pipeline against the plain versions of its stages, one after the other."""

import brute
import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_points


def test_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run


def test_pipeline_keeps_what_the_plain_stages_keep(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    good = [(d, t) for (d, t, _, _), keep in zip(docs, brute.quality_kept(docs)) if keep]
    lines = brute.drop_lines(good)
    first = [(d, t) for (d, t), (_, _, component) in zip(lines, brute.simhash(lines)) if d == component]
    clean = [(d, t) for (d, t), row in zip(first, brute.contamination(first, bench)) if not row[5]]
    assert 0 < len(clean) < len(first) < len(lines) < len(docs)
    rows = [tuple(r) for r in corpus_pipeline.run(spark, small).collect()]
    brute.check_packing(clean, rows, Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))


def test_stages_return_the_columns_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
