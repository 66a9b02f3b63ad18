import re

import corpus_pipeline
from riskgrid.llm import decontaminate, quality_rules
from tests.llm.fixture import SMALL, corpus, empty, frame, rows_of
from tests.llm.test_jaccard import brute


def test_stages_one_by_one(spark):
    rows = corpus()
    docs = frame(spark, rows).cache()
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "best-fit packing"]
    kept = by_name["quality rules"](spark, docs, SMALL)
    want = sorted([(i, t) for i, t in rows if quality_rules.passes(quality_rules.Measures((t or "").encode()), range(len(quality_rules.RULES)))], key=repr)
    assert rows_of(kept, "doc_id", "text") == want and kept.columns == docs.columns
    distinct = by_name["n-gram Jaccard join"](spark, kept, SMALL)
    smallest = {c for _, _, c in brute(want)} | {None}
    assert {r.doc_id for r in distinct.collect()} == {i for i, _ in want} & smallest
    clean = by_name["benchmark decontamination"](spark, distinct, SMALL)
    items = [decontaminate.normalised(r.text.encode()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for r in clean.collect():
        assert not any(x in decontaminate.normalised(r.text.encode()) for x in items)
    private = by_name["PII"](spark, clean, SMALL)
    assert private.columns == docs.columns and private.count() == clean.count()
    assert not any(re.search(r"[a-z0-9]@mail\d", r.text) for r in private.collect())
    packed = by_name["best-fit packing"](spark, private, SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in private.collect()}


def test_run_and_empty_stages(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 100
    docs = empty(spark)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, SMALL).count() == 0
