from __future__ import annotations

import corpus_pipeline
from wattspan.llm import registry


def test_stages(spark, tmp_path, small):
    docs = small
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        if name != "best-fit packing":
            assert out.dtypes == docs.dtypes and 0 < out.count() <= docs.count()
            docs = out
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}
    same = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, out.collect()))


def test_odd_rows_and_nothing(spark, nasty, nothing):
    for docs in (nasty, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.staged(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
            if name != "best-fit packing":
                assert out.dtypes == docs.dtypes
                docs = out


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES} == set(range(1, 14))
    assert set(registry.SQL) <= set(registry.QUERIES)
