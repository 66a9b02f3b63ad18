import hashlib
import itertools
import re

import numpy as np

from riskgrid.llm import pii
from tests.llm.fixture import corpus, empty, frame

ODD = [
    "mail a.b+c@mail7.example.com, or x@y or @z.com a@b..c", "ips 1.2.3.4 256.1.1.1 1.2.3.4.5 01.002.3.255 1.2.3.1000 000000000000.1.1.1",
    "cards 4111 1111 1111 1111 and 4111-1111-1111-1112 and 49927398716 6011 0009 9013 9424", "call +1 (569) 555-7279 or +12 or +1234567 or +123456789012345678",
    "\U0001f600é +44 20 7946 0958\nnext 4111111111111111", "0" * 16, "+1+2+3 (4) 555 6666 777 8", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
]


def rows():
    return corpus(80) + [(30_000 + k, t) for k, t in enumerate(ODD)]


def luhn(number):
    total = 0
    for k, d in enumerate(reversed(number)):
        d = int(d) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) < 256]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]
    return out


def test_base_against_plain_patterns(spark):
    data = rows()
    df = frame(spark, data)
    got = pii.find_pii(df, pii.train(df)).collect()
    want = []
    for i, t in data:
        spans = base(t or "")
        counts = [sum(k == x for x, _, _ in spans) for k in pii.KINDS]
        want.append((i, *counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        text = next(t for i, t in data if i == r.doc_id) or ""
        if r.doc_id is not None:
            assert {f"{k}:{a}:{b}" for k, a, b in base(text)} <= set(r.spans.split(",")) | {""}


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    t = len(pii.TAGS)
    emit, steps = rng.normal(size=(6, 4, t)), rng.normal(size=(t, t))
    lengths = np.array([4, 1, 2, 3, 4, 4])
    got = pii.viterbi(emit, lengths, steps)
    for k, n in enumerate(lengths):
        value = lambda p: sum(emit[k, j, x] for j, x in enumerate(p)) + sum(steps[a, b] for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(t), repeat=int(n)), key=value)
        assert tuple(got[k, :n]) == best and not got[k, n:].any()


def test_training_learns_shapes_and_tagging_is_independent_of_batches():
    examples = []
    for k in range(60):
        examples.append((["write", "to", f"u{k}@mail{k}.example.com", "now."], [0, 0, 1, 0]))
        examples.append((["only", "plain", "words", f"{k}"], [0, 0, 0, 0]))
        examples.append((["call", "+1", f"({100 + k})", f"555-{1000 + k}"], [0, 4, 4, 4]))
    model = pii.fit(examples)
    tagger = pii.Tagger(model)
    texts = [b"please write to some.one@mail3.example.org soon", b"nothing here at all", b"", b"or call +1 (234) 555-7777 today\n\nplain\n" + b"w " * 500]
    together = tagger.spans(texts)
    assert together == [pii.Tagger(model).spans([t])[0] for t in texts]
    assert together[0] == [("email", 16, 42)] and together[1] == together[2] == []
    assert together[3] == [("phone", 8, 25)]


def test_masking(spark):
    data = [(1, "mail a@b.com now"), (2, None), (3, "clean text"), (4, "é +44 20 7946 0958 or 4111 1111 1111 1111")]
    df = frame(spark, data)
    got = pii.mask_pii(df, pii.fit([]))
    assert got.columns == df.columns
    found = {r.doc_id: (r.text, r.n_chars) for r in got.collect()}
    assert found[1] == ("mail [EMAIL] now", 16) and found[2] == (None, None) and found[3] == ("clean text", 10)
    assert not re.search("[0-9]{4}", found[4][0])
    assert pii.masked("0123456789", [("a", 2, 5), ("b", 4, 7), ("c", 8, 9)]) == "01[A]7[C]9"


def test_without_rows(spark):
    model = pii.train(empty(spark))
    assert pii.find_pii(empty(spark), model).count() == 0
    assert [r.spans for r in pii.find_pii(frame(spark, [(1, None), (2, "")]), model).collect()] == ["", ""]
    many = pii.labelled(frame(spark, rows()), 40, 10).where("tag = 'other'").select("doc_id").distinct().count()
    assert 0 < many <= 10
