import numpy as np

from riskgrid.llm import chunks
from tests.llm.fixture import corpus, empty, frame


def plain_cuts(data: bytes):
    h, out = 0, []
    hashes = []
    for b in data:
        h = (h * 2 + int(chunks.GEAR[b])) % 2**32
        hashes.append(h)
    r = chunks.REACH
    for i in range(r, len(data) - r):
        if all(hashes[i] > x for x in hashes[i - r : i]) and all(hashes[i] >= x for x in hashes[i + 1 : i + r + 1]):
            out.append(i + 1)
    if data and (not out or out[-1] != len(data)):
        out.append(len(data))
    full, last = [], 0
    for end in out:
        while end - last > chunks.LONGEST:
            last += chunks.LONGEST
            full.append(last)
        full.append(end)
        last = end
    return full


def test_cuts_against_plain_loop():
    for _, text in corpus(30):
        data = (text or "").encode()
        assert chunks.cuts(np.frombuffer(data, np.uint8)).tolist() == plain_cuts(data)


def test_insertion_changes_nearby_chunks_only():
    text = corpus(5)[0][1].encode() * 2
    cut = lambda x: {x[a:b] for a, b in zip([0, *plain_cuts(x)], plain_cuts(x))}
    changed = text[:900] + b"some inserted words" + text[900:]
    assert len(cut(text) - cut(changed)) <= 4


def brute(rows, shortest=chunks.SHORTEST_REPEAT):
    first, found = {}, {}
    docs = {}
    for i, t in rows:
        if i is not None:
            docs.setdefault(i, set()).add((t or "").encode())
    every = []
    for i, versions in docs.items():
        for data in versions:
            ends = plain_cuts(data)
            every += [(i, a, b, data[a:b]) for a, b in zip([0, *ends], ends)]
    for i, a, b, c in sorted(every):
        first.setdefault(c, (i, a))
    for i, a, b, c in every:
        if first[c] != (i, a):
            found.setdefault(i, {})[a] = (b, first[c][0])
    out = []
    for i, parts in found.items():
        runs = []
        for a in sorted(parts):
            b, source = parts[a]
            if runs and runs[-1][1] == a:
                runs[-1][1] = b
                runs[-1][2].append(source)
            else:
                runs.append([a, b, [source]])
        runs = [r for r in runs if r[1] - r[0] >= shortest]
        if runs:
            out.append((i, sum(len(r[2]) for r in runs), ",".join(f"{a}:{b}" for a, b, _ in runs), sorted({s for r in runs for s in r[2]})))
    return sorted(out)


def test_repeats_against_brute_force(spark):
    rows = corpus()
    got = chunks.repeats(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_repeats, r.spans, r.first_docs) for r in got) == brute(rows)


def test_passages_of_51_words_are_found(spark):
    rows = [(k, t) for k, (i, t) in enumerate(corpus(60)) if t]
    passage = " ".join(f"word{k}er" for k in range(51))
    planted = [(1000 + k, t[: 100 + 7 * k] + " " + passage + " " + t[100 + 7 * k :]) for k, (_, t) in enumerate(rows[:20])]
    got = {r.doc_id: r for r in chunks.repeats(frame(spark, planted, clashing=False)).collect()}
    assert set(got) >= {i for i, _ in planted[1:]}
    assert all(1000 in got[i].first_docs for i, _ in planted[1:])


def test_empty(spark):
    assert chunks.repeats(empty(spark)).count() == 0
    assert chunks.repeats(frame(spark, [(1, None), (2, ""), (3, "")])).count() == 0
