"""The corpus pipeline against brute force, stage by stage."""

import numpy as np
import pyarrow.parquet as pq
import public_tokenizers

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_contamination, brute_lines
from tidemark.llm import quality
from tidemark.session import shared_dir


def test_stages(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    columns, texts = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        path = shared_dir(spark, "t-stage")
        stage(spark, docs, smoke_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == columns
            texts = {r.doc_id: r.text for r in docs.collect()}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if k == 0:
            judged = quality.quality(spark.read.parquet(f"{smoke_dir}/documents.parquet")).collect()
            assert set(texts) == {r.doc_id for r in judged if r.kept}
        elif k == 1:
            lines = brute_lines(sorted(before.items()))
            assert texts == {i: t for i, _, n, t in lines if not n or t.strip()}
        elif k == 2:
            component = brute_components(sorted(before.items()), 5)
            assert set(texts) == {i for i in before if component[i] == i}
        elif k == 3:
            bench = pq.read_table(f"{smoke_dir}/benchmark.parquet").to_pydict()
            found = brute_contamination(before.values(), list(zip(bench["item_id"], bench["text"])))
            assert set(texts) == {i for i, (_, hit, _) in zip(before, found) if not hit}
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(texts) and all(r.lossless for r in rows)
    assert all(library.decode(list(map(int, np.array(r.ids)))) == texts[r.doc_id] for r in rows)


def test_run_returns_the_last_stage(spark, smoke_dir):
    out = corpus_pipeline.run(spark, smoke_dir)
    assert "ids" in out.columns and out.count() > 0
