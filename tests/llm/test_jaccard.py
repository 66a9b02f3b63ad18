import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgrid.llm import jaccard as j
from riskgrid.llm.components import components
from tests.llm.fixture import corpus, empty, frame, words


def shingles(text):
    w = [x.lower() for x in words(text)]
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for b, (k, t) in enumerate(sets[:a]):
            if i is not None and k is not None and s and t:
                inter = len(s & t)
                if 100 * inter >= 80 * (len(s) + len(t) - inter):
                    parent[find(a)] = find(b)
    low = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return sorted(((i, len(s), low.get(find(a)) if i is not None else None) for a, (i, s) in enumerate(sets)), key=repr)


def near_copies(n, seed=9):
    """Chains of texts that differ by few words, so links reach further than one step, and sizes near the bound."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for group in range(n):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(5, 90))]
        for k in range(rng.randint(1, 9)):
            out.append((100_000 + 100 * group + k, " ".join(text)))
            for _ in range(rng.randint(0, 2)):
                text = text[:]
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text + [rng.choice(vocabulary) for _ in range(rng.randint(1, 6))]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    out += [(200_000 + k, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 20)))) for k in range(40)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("part", "sample", "sets"), [(j.PART, j.ORDER_SAMPLE, j.BROADCAST_SETS), (3, 5, 0), (8, 0, 10)])
def test_classes_against_all_pairs(spark, part, sample, sets):
    rows = corpus() + near_copies(40)
    got = j.classes(frame(spark, rows), sample, part, sets)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr) == brute(rows)


def test_walk_with_many_levels():
    rng = np.random.default_rng(4)
    base = [np.unique(rng.integers(0, 2**63, 100).astype(np.uint64)) for _ in range(300)]
    sets = []
    for s in base:
        sets.append(s)
        if rng.random() < 0.6:
            sets.append(np.unique(np.r_[rng.choice(s, int(rng.integers(80, 101)), replace=False), rng.integers(0, 2**63, int(rng.integers(0, 15))).astype(np.uint64)]))
    sizes = np.array([len(s) for s in sets])
    exact = lambda a, b: len(np.intersect1d(sets[a], sets[b])) >= j.share_needed(len(sets[a]), len(sets[b]))
    order = rng.permutation(len(sets))
    found = j.linked([j.bitmap(s) for s in sets], sizes, order, exact)
    loose = j.linked([j.bitmap(s) for s in sets], sizes, order)
    want = j.Classes(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            if exact(a, b):
                want.join(a, b)
                assert loose.find(a) == loose.find(b)
    assert [found.find(k) for k in range(len(sets))] == [want.find(k) for k in range(len(sets))]


def test_share_needed_and_prefix():
    for a in range(1, 60):
        for b in range(1, 60):
            need = j.share_needed(a, b)
            assert 100 * need >= 80 * (a + b - need) and not 100 * (need - 1) >= 80 * (a + b - need + 1)
        s = np.arange(a, dtype=np.uint64)
        assert len(j.prefix(s, np.array([0, 3], np.uint64))) == a - -(-4 * a // 5) + 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(1800)] + [(k, k + 1) for k in range(5000, 5400)] + [(6000, k) for k in range(6001, 6500)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        u, v = find(u), find(v)
        parent[max(u, v)] = min(u, v)
    touched = {x for u, v in edges if u != v for x in (u, v)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in touched}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_document_of_each_class_stays(spark):
    rows = corpus()
    df = frame(spark, rows)
    kept = j.distinct_documents(df)
    assert kept.columns == df.columns
    label = {}
    for i, _, c in brute(rows):
        label.setdefault(i, set()).add(c)
    want = [i for i, t in rows if i is None or label[i] == {i}]
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=repr) == sorted(want, key=repr)


def test_without_rows(spark):
    assert j.classes(empty(spark)).count() == 0
    got = j.classes(frame(spark, [(1, None), (2, ""), (3, " "), (4, "a"), (5, "A")])).withColumn("x", F.lit(1)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4)]
