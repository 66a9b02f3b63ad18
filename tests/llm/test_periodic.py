import hashlib
import random

import numpy as np
import pytest

from riskgrid.llm import periodic
from tests.llm.fixture import corpus, empty, frame


def brute(words):
    """All runs (start, length, period) by comparing every pair of places."""
    n, runs = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                smaller = any(all(words[k] == words[k + r] for k in range(i, i + length - r)) for r in range(1, q))
                if not smaller:
                    runs.append((i, length, q))
            i = j
    return sorted(runs, key=lambda r: (r[0], r[2]))


def expected(words):
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return runs, best, kept


def random_words(rng):
    out = []
    for _ in range(rng.randint(1, 6)):
        kind = rng.random()
        base = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        if kind < 0.5:
            out += base * rng.randint(1, 9) + base[: rng.randint(0, len(base))]
        elif kind < 0.7:
            out += [rng.choice("abcdefghij") for _ in range(rng.randint(1, 20))]
        elif kind < 0.85:
            out += ["a"] * rng.randint(1, 40)
        else:
            nested = ["a"] * rng.randint(2, 9) + ["b"]
            out += nested * rng.randint(3, 7)
    return out


def test_find_equals_brute_force():
    rng = random.Random(1)
    texts = [random_words(rng) for _ in range(400)] + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 100]
    codes = np.array([ord(w) for words in texts for w in words], np.int64)
    offsets = np.r_[0, np.cumsum([len(w) for w in texts])]
    found = {}
    for low, stop, period in periodic.find(codes, offsets):
        text = int(np.searchsorted(offsets, low, side="right") - 1)
        found.setdefault(text, []).append((low - int(offsets[text]), stop - low, period))
    for i, words in enumerate(texts):
        assert sorted(found.get(i, []), key=lambda r: (r[0], r[2])) == brute(words), words


@pytest.mark.parametrize("widest", [2, 8])
def test_scales_beyond_one_transform(monkeypatch, widest):
    monkeypatch.setattr(periodic, "WIDEST", widest)
    test_find_equals_brute_force()


def test_squared_differences_are_exact():
    rng = np.random.default_rng(2)
    for size in (1, 2, 8, 64):
        blocks = rng.integers(0, 1 << 20, (5, size)).astype(np.uint64)
        windows = rng.integers(0, 1 << 20, (5, 2 * size)).astype(np.uint64)
        for p, g in periodic.PRIMES:
            got = periodic.squared_differences(blocks, windows, p, g)
            for row in range(5):
                for o in range(size):
                    d = blocks[row].astype(object) - windows[row, o : o + size].astype(object)
                    assert got[row, o] == int((d * d).sum()) % p


def test_sum_that_one_prime_divides_is_no_match():
    """A difference whose square sums to a multiple of the first prime is told apart by the second."""
    p = periodic.PRIMES[0][0]
    codes = np.array([0, p, 0, p, 0, p, 0, p], np.int64)
    at, distance = periodic.occurrences(codes, np.array([0]), np.array([8]), 1)
    assert len(at) == 0


def test_rows_of_all_odd_documents(spark):
    rows = corpus()
    rows += [(30_000 + k, " ".join(random_words(random.Random(k)))) for k in range(40)]
    df = periodic.periodic_runs(frame(spark, rows), periodic.made_periodic)
    want = []
    for doc_id, text in rows:
        words = [w.decode() for w in periodic.made_periodic(doc_id, (text or "").encode().split())]
        if len(words) > 700:
            continue
        runs, best, kept = expected(words)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    got = [tuple(r) for r in periodic.digests(df).collect()]
    assert len(got) == len(rows)
    for row in want:
        assert got.count(row) == want.count(row), row
    assert any(row[1] for row in want)


def test_empty_table_and_long_text(spark):
    assert periodic.periodic_runs(empty(spark)).collect() == []
    n = 400_000
    row = periodic.periodic_runs(frame(spark, [(1, "x " * n + "y " + "x " * n)])).first()
    assert [tuple(r) for r in row.runs] == [(0, n, 1), (n + 1, n, 1)]
    text = " ".join(["x"] * n) + " " + " ".join(str(i % 70_000) for i in range(n))
    row = periodic.periodic_runs(frame(spark, [(1, text)])).first()
    assert [tuple(r) for r in row.runs] == [(0, n, 1), (n, n, 70_000)]
    assert row.collapsed == "x " + " ".join(str(i) for i in range(70_000))
