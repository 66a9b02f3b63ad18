import numpy as np

from riskgrid.llm import decontaminate as d
from tests.llm.fixture import corpus, empty, frame

BENCH = "/root/testdata/sf0.001/benchmark.parquet"


def test_qgram_hashes_depend_on_their_bytes_alone():
    data = b"the quick brown fox jumps over the lazy dog, the quick brown fox"
    h = d.qgram_hashes(np.frombuffer(data, np.uint8))
    grams = [data[k : k + d.Q] for k in range(len(data) - d.Q + 1)]
    assert len(h) == len(grams) and len(set(h.tolist())) == len(set(grams))
    again = d.qgram_hashes(np.frombuffer(data[20:], np.uint8))
    assert again.tolist() == h[20:].tolist()
    assert len(d.qgram_hashes(np.frombuffer(b"short", np.uint8))) == 0


def plain_edits(passage, region):
    row = [0] * (len(region) + 1)
    for a in passage:
        new = [row[0] + 1]
        for j, b in enumerate(region, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_banded_alignment_against_the_whole_matrix():
    rng = np.random.default_rng(0)
    for _ in range(60):
        passage = bytes(rng.integers(97, 101, 80, dtype=np.uint8))
        changed = bytearray(passage)
        for _ in range(rng.integers(0, 6)):
            k = int(rng.integers(0, len(changed)))
            kind = rng.integers(0, 3)
            if kind == 0:
                changed[k] = 120
            elif kind == 1:
                del changed[k]
            else:
                changed.insert(k, 121)
        first = int(rng.integers(0, 6))
        region = b"q" * first + bytes(changed) + b"rest"
        want = plain_edits(passage, region)
        assert d.edits(passage, region, first, 5) == min(want, 6)


def planted(rows, items):
    """Whole items, items with edits, and half items, in the middle of documents."""
    texts = [t for _, t in rows if t and len(t) > 400]
    out = {}
    for k, (item, text) in enumerate(items):
        host = texts[k % len(texts)]
        out[50_000 + k] = (item, host[:200] + " " + text + " " + host[200:])
        out[60_000 + k] = (item, host[:150] + "\n" + text.upper().replace(" ", "  ") + host[150:])
        words = text.split()
        if d.budget(len(text)) >= 6 and len(text) <= d.WINDOW:
            words[len(words) // 2] = "zz" + words[len(words) // 2][2:]
            out[70_000 + k] = (item, host[:100] + " " + " ".join(words) + " " + host[100:])
    return out


def test_planted_passages_and_clean_documents(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(BENCH).collect() if len(r.text) >= d.SHORTEST]
    rows = corpus()
    more = planted(rows, items)
    df = frame(spark, rows + [(i, t) for i, (_, t) in more.items()])
    bench = spark.createDataFrame([*items, (None, "x" * 80), (90, None), (91, "short")], "item_id long, text string").selectExpr("*", "'clash' as edits")
    found = {(r.doc_id, r.item_id): r.edits for r in d.contaminated(df, bench).collect()}
    for i, (item, _) in more.items():
        assert (i, item) in found
    # Against the brute force: the edit distance of each passage of each item to each document.
    index = d.Index.of([(i, t.encode()) for i, t in items])
    for i, text in rows[:25]:
        plain = d.normalised((text or "").encode())
        for k, passage in enumerate(index.passages):
            inside = passage in plain
            if inside:
                assert (i, int(index.items[k])) in found
    for i, item in found:
        if i is not None and i < 50_000:
            text = d.normalised(dict((a, b) for a, b in rows if a is not None)[i].encode())
            assert any(plain_edits(p, text) <= d.budget(len(p)) for k, p in enumerate(index.passages) if index.items[k] == item)
    kept = d.without_leaks(df, bench)
    assert kept.columns == df.columns
    leaked = {i for i, _ in found}
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert not leaked & set(ids) and len(ids) == df.where(~df.doc_id.isin(*leaked) | df.doc_id.isNull()).count()


def test_blocks_of_a_large_benchmark(spark, monkeypatch):
    items = [(r.item_id, r.text) for r in spark.read.parquet(BENCH).collect()]
    more = planted(corpus(), items[:8])
    df = frame(spark, [(i, t) for i, (_, t) in more.items()], clashing=False)
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, d.contaminated(df, bench).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 800)
    assert sorted(map(tuple, d.contaminated(df, bench).collect())) == one


def test_without_rows(spark):
    bench = spark.read.parquet(BENCH)
    assert d.contaminated(empty(spark), bench).count() == 0
    assert d.contaminated(frame(spark, corpus(5)), bench.where("false")).count() == 0
    assert d.without_leaks(frame(spark, corpus(5)), bench.where("false")).count() == len(corpus(5))


def parts_of(text, rng):
    """What a leak may keep of an item: verbatim middle parts, and the whole with one word in ten replaced."""
    words = text.split()
    for share in (0.5, 0.75, 0.9):
        skip = int(len(words) * (1 - share) / 2)
        yield " ".join(words[skip : len(words) - skip])
    yield " ".join("".join(map(chr, rng.integers(97, 123, 5))) if k % 10 == 5 else w for k, w in enumerate(words))


def test_parts_of_real_items_against_the_whole_matrix():
    rng = np.random.default_rng(1)
    import pyarrow.parquet as pq

    items = [(r["item_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.1/benchmark.parquet").to_pylist()]
    index = d.Index.of([(i, t.encode()) for i, t in items])
    hosts = [t for _, t in corpus() if t and len(t) > 400]
    data, of = [], []
    for k, (item, text) in enumerate(items):
        for part in parts_of(text, rng):
            host = hosts[k % len(hosts)]
            data.append((host[:200] + " " + part + " " + host[200:400]).encode())
            of.append(item)
    rows = list(d.matches(data, index))
    found = {(k, item) for k, item, *_ in rows}
    missed = [k for k, item in enumerate(of) if (k, item) not in found]
    assert not missed
    passages = index.passages
    for k, item, cost, _, _ in rows[::97]:
        mine = [p for p, i in zip(passages, index.items.tolist()) if i == item]
        assert cost == min(plain_edits(p, d.normalised(data[k])) for p in mine) <= d.budget(len(mine[0]))


def test_bit_vectors_against_the_banded_alignment():
    rng = np.random.default_rng(2)
    text = bytes(rng.integers(97, 101, 500, dtype=np.uint8))
    index = d.Index.of([(1, text)])
    region = np.frombuffer(text[::-1] + text[100:180] + b"x" + text[181:220], np.uint8)
    begin = rng.integers(0, 400, len(index.items))
    stop = begin + rng.integers(1, 200, len(begin))
    got = d.fewest_edits(index, np.arange(len(begin)), region, begin, stop)
    for p, a, b, cost in zip(index.passages, begin.tolist(), stop.tolist(), got.tolist()):
        assert cost == plain_edits(p, region[a:b].tobytes())


def test_items_without_a_number_remove_documents(spark, monkeypatch):
    item = "a passage of a benchmark that nobody has numbered, though it is as long as any other one"
    bench = spark.createDataFrame([(None, item), (None, item[::-1]), (3, "q" * 90)], "item_id long, text string")
    df = frame(spark, [(1, "before " + item + " after"), (2, "nothing of the sort in this one"), (4, item[::-1])], clashing=False)
    for size in (d.BLOCK_BYTES, 60):
        monkeypatch.setattr(d, "BLOCK_BYTES", size)
        assert [r.doc_id for r in d.without_leaks(df, bench).collect()] == [2]
        assert d.contaminated(df, bench).count() == 0


def spread(passage, edits, shift):
    """The passage with so many bytes replaced, evenly spread."""
    out = bytearray(passage)
    for k in range(edits):
        out[(shift + k * len(passage) // edits) % len(passage)] = 126
    return bytes(out)


def test_every_passage_within_the_sure_edits_is_found():
    """Against whole edit matrices, without the filter in the definition: edits anywhere, also evenly spread."""
    import pyarrow.parquet as pq

    items = [(r["item_id"], r["text"].encode()) for r in pq.read_table(BENCH).to_pylist()]
    index = d.Index.of(items)
    rng = np.random.default_rng(1)
    passages = index.passages
    assert {d.sure_edits(64), d.sure_edits(40)} == {4, 2}
    for edits in range(5):
        texts, owners = [], []
        for k, passage in enumerate(passages):
            if d.sure_edits(len(passage)) < edits:
                continue
            changed = bytearray(spread(passage, edits, int(rng.integers(64))) if edits and k % 3 else passage)
            if edits and k % 3 == 0:
                for _ in range(edits):
                    at, kind = int(rng.integers(len(changed))), rng.integers(3)
                    if kind == 0:
                        changed[at] = 126
                    elif kind == 1:
                        del changed[at]
                    else:
                        changed.insert(at, 126)
            texts.append(b"zq xk wv " + bytes(changed) + b" vw kx qz")
            owners.append(k)
        found = {(t, item) for t, item, *_ in d.matches(texts, index)}
        for t, k in enumerate(owners):
            if plain_edits(passages[k], d.normalised(texts[t])) <= edits:
                assert (t, int(index.items[k])) in found, (edits, k)


def test_pieces_find_what_one_look_finds(monkeypatch):
    import pyarrow.parquet as pq

    items = [(r["item_id"], r["text"].encode()) for r in pq.read_table(BENCH).to_pylist()]
    index = d.Index.of(items)
    texts = [b"%s and %s" % (items[k][1], items[k + 1][1]) for k in range(len(items) - 1)] + [items[3][1] * 30]
    want = list(d.matches(texts, index))
    monkeypatch.setattr(d, "ENTRIES", 50)
    assert list(d.matches(texts, index)) == want and len(want) > 2 * (len(items) - 1)


def test_long_text_of_one_letter():
    import resource

    index = d.Index.of([(1, b"-" * 80), (2, b"some words of an item that have nothing to do with a rule of dashes")])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert [r[:3] for r in d.matches([b"-" * 300_000], index)] == [(0, 1, 0)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 700_000
