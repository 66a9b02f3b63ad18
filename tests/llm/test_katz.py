import math
from collections import Counter

import pytest

from riskgrid.llm import katz
from tests.llm.fixture import corpus, empty, frame, remainder, words


def brute(rows):
    """The model by dictionaries, straight from its definition."""
    train = [r for r in rows if r[0] is not None and remainder(r[0], 7) != 2]
    token = lambda t: [w.lower() for w in words(t)] + ["END"]
    uni, bi, ctx = Counter(), Counter(), Counter()
    for _, t in train:
        before = "START"
        for w in token(t):
            uni[w] += 1
            bi[before, w] += 1
            ctx[before] += 1
            before = w
    n, v = sum(uni.values()), len(uni)

    def discounts(counter):
        seen = Counter(counter.values())
        common = 6 * seen[6] / seen[1]
        out = {}
        for r in range(1, 6):
            d = ((r + 1) * seen[r + 1] / seen[r] / r - common) / (1 - common) if seen[r] and common < 1 else 0
            out[r] = d if 0 < d < 1 else (r - 0.5) / r
        return out

    du, db = discounts(uni), discounts(bi)
    star = lambda c, d: d[c] * c if c <= 5 else c - 0.01
    unknown = 1 - sum(star(c, du) for c in uni.values()) / n
    p1 = lambda w: star(uni[w], du) / n if w in uni else unknown
    after = {}
    for (h, w), c in bi.items():
        after.setdefault(h, {})[w] = c

    def p2(w, h):
        if h not in after:
            return p1(w)
        if w in after[h]:
            return star(after[h][w], db) / ctx[h]
        kept = sum(star(c, db) for c in after[h].values()) / ctx[h]
        return (1 - kept) / (1 - sum(p1(x) for x in after[h])) * p1(w)

    for h in list(after)[:40] + ["START", "never"]:
        assert sum(p2(w, h) for w in uni) + p2("unknown word", h) == pytest.approx(1, abs=1e-9)
    out = []
    for i, t in rows:
        base = score = 0.0
        before = "START"
        tokens = token(t)
        for w in tokens:
            base += math.log10((uni[w] + 1) / (n + v + 1))
            score += math.log10(p2(w, before))
            before = w
        known = sum(w in uni for w in tokens)
        held = remainder(i, 7) == 2
        out.append((i, held, len(tokens), known, n, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(16 << 20, 1_500_000), (40_000, 900)])
def test_against_dictionaries(spark, monkeypatch, sizes):
    monkeypatch.setattr(katz, "BLOCK_BYTES", sizes[0])
    monkeypatch.setattr(katz, "BUCKET_ENTRIES", sizes[1])
    rows = corpus()
    from pyspark.sql import functions as F

    df = frame(spark, rows)
    training = ~(katz.id_remainder(7) == 2)
    got = katz.score(katz.train(df, training)).withColumns({c: F.round(c, 6) for c in ("base_score", "score")})
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    # A null number has a null training flag here: not trained on, and marked as held out.
    want = sorted(((i, True if i is None else h, *rest) for i, h, *rest in brute(rows)), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], abs=2e-5)


def test_without_rows_or_training(spark):
    assert katz.score(katz.train(empty(spark), katz.F.lit(True))).count() == 0
    got = katz.score(katz.train(frame(spark, [(1, "a b"), (2, None)]), katz.F.lit(False))).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.score) for r in got) == [(1, 3, 0, 0.0), (2, 1, 0, 0.0)]


def test_packing():
    import numpy as np

    for values in ([], [0, 0], [5, 300, 2**40], list(range(1000))):
        x = np.array(values, np.uint64)
        assert (katz.unpacked(katz.packed(x)) == x).all()
