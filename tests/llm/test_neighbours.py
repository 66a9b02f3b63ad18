import numpy as np

from riskgrid.llm import neighbours as nn
from tests.llm.fixture import corpus, empty, frame, remainder

DATA = "/root/testdata/sf0.01"


def test_votes_against_plain_loops():
    rng = np.random.default_rng(2)
    model = nn.Model(np.zeros((0, 0)), nn.unit(rng.normal(size=(200, 8)).astype(np.float32)), rng.integers(0, 2, 200).astype(np.float32), 0.4)
    rows = nn.unit(rng.normal(size=(30, 8)).astype(np.float32))
    got = nn.vote(rows, model)
    for row, value in zip(rows, got):
        near = sorted(range(200), key=lambda k: -float(model.vectors[k] @ row))[: nn.NEIGHBOURS]
        weight = [max(float(model.vectors[k] @ row), 0) ** nn.SHARPNESS for k in near]
        assert abs(value - sum(w * model.labels[k] for w, k in zip(weight, near)) / sum(weight)) < 1e-4


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = nn.score(docs, nn.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 100
    right = sum(r.predicted == r.quality for r in got) / len(got)
    clean = [r.predicted for r in got if r.quality == 1]
    assert right >= 0.95 and np.mean(clean) >= 0.97
    ranked = sorted(got, key=lambda r: r.score)
    pairs = [(a.score < b.score) + (a.score == b.score) / 2 for a in ranked if not a.quality for b in ranked if b.quality]
    assert np.mean(pairs) >= 0.97


def test_held_out_labels_are_not_used(spark):
    rows = [(i, t) for i, t in corpus() if i is not None]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    other = spark.createDataFrame([(i, i % 2 if remainder(i, 3) != 1 else 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    result = lambda x: sorted((r.doc_id, r.score) for r in nn.score(df, nn.train(df, x)).collect())
    assert result(labels) == result(other)
    model = nn.train(df, labels, 10)
    assert len(model.labels) <= 10


def test_odd_rows(spark):
    rows = corpus()
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, k % 2 if k % 5 else None) for k, (i, _) in enumerate(rows)], "doc_id long, quality int")
    got = nn.score(df, nn.train(df, labels)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (remainder(r.doc_id, 3) == 1) for r in got)
    none = nn.train(df, labels.where("false"))
    assert {r.score for r in nn.score(df, none).collect()} == {0.5}
    assert nn.score(empty(spark), none).count() == 0
