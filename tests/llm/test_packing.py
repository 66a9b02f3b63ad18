import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskgrid.llm import common
from riskgrid.llm import packing as p
from tests.llm.fixture import corpus, empty, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def want_pieces(rows, capacity):
    t = Tokenizer.from_file(PATH)
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((i, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("capacity", [2048, 300])
def test_round_trip_and_gapless(spark, capacity):
    rows = corpus()
    got = [tuple(r) for r in p.pack(frame(spark, rows), PATH, capacity).collect()]
    want = want_pieces(rows, capacity)
    assert sorted((r[:5] for r in got), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r[5], []).append((r[6], r[3]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    histogram = Counter(r[3] for r in want)
    assert len(sequences) <= p.lower_bound(histogram, capacity) + 1


def exact_bins(sizes, capacity):
    """Fewest bins by trying everything."""
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for b in {x: j for j, x in enumerate(bins)}.values():
            if bins[b] >= sizes[k]:
                bins[b] -= sizes[k]
                place(k + 1, bins)
                bins[b] += sizes[k]
        bins.append(capacity - sizes[k])
        place(k + 1, bins)
        bins.pop()

    place(0, [])
    return best


def test_fewest_bins_on_small_cases():
    rng = random.Random(3)
    for _ in range(60):
        capacity = rng.choice([20, 50, 100])
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        patterns = p.solve(dict(Counter(sizes)), capacity)
        used = Counter()
        for filling, times in patterns:
            assert sum(k * m for k, m in filling.items()) <= capacity
            used.update({k: m * times for k, m in filling.items()})
        assert used == Counter(sizes)
        best = exact_bins(sizes, capacity)
        assert p.lower_bound(dict(Counter(sizes)), capacity) <= best
        assert p.bins_of(patterns) == best


def test_large_histograms_reach_the_bound():
    rng = random.Random(4)
    histogram = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(50_000))
    patterns = p.solve(dict(histogram), 2048)
    assert p.bins_of(patterns) == p.lower_bound(dict(histogram), 2048)
    assert p.solve({}) == []
    assert p.bins_of(p.solve({1: 1_000_000_000})) == -(-1_000_000_000 // 2048)


def test_without_rows(spark):
    assert p.pack(empty(spark), PATH).count() == 0
    got = p.pack(frame(spark, [(1, None), (2, ""), (None, "")]), PATH).collect()
    assert {r.sequence_id for r in got} == {0} and sorted(r.offset for r in got) == [0, 1, 2]


def test_ids_of_words_equal_ids_of_texts():
    rng = random.Random(8)
    alphabet = "abzABZ éÉßİıŉǅΣσς'sS.,!<|>-_%0123\u0301\u00a0\x1c\u200b\U0001f600中 \n\t"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["It's <|endoftext|>x y<|startoftext|>.", "ÀÖØöøįıɏ ÷×", "Hello, World... don't!!", "e\u0301cole ΑΣ ΑΣ."]
    t = Tokenizer.from_file(PATH)
    want = [np.array(e.ids + [0], "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert p.WordIds(PATH)([x.encode() for x in texts]) == want


def test_ids_with_a_full_memory(monkeypatch):
    monkeypatch.setattr(p, "CACHE_WORDS", 20)
    monkeypatch.setattr(p, "CACHE_LETTERS", 30)
    made, t = p.WordIds(PATH), Tokenizer.from_file(PATH)
    for _, text in corpus(40):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        assert made([(text or "").encode()]) == [np.array(ids, "<u4").tobytes()]


def test_memories_are_let_go_when_the_worker_reads_for_something_else():
    common._KEPT.clear()
    assert common.kept("a", list) is common.kept("a", list)
    list(common.slices([], keep="a"))
    assert list(common._KEPT) == ["a"]
    list(common.slices([]))
    assert not common._KEPT


def test_memory_keeps_what_is_used_again():
    memory = p.Memory(8)
    for i in range(50):
        wanted = {b"often", b"rare%d" % i, b"rare%d" % (i + 1000)}
        for key in memory.unknown(wanted):
            assert key != b"often" or i == 0
            memory.now[key] = key
        assert all(memory.now[key] == key for key in wanted)
        assert len(memory.now) + len(memory.before) <= 8
