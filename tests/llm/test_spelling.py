import random
import re
import zlib
from collections import Counter

import numpy as np

from riskgrid.llm import spelling
from tests.llm.fixture import corpus, empty, frame


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts, shortest=5, rarest=3):
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= rarest}
    rows, forms = {}, {}
    for w, n in words.items():
        around = sorted((x for x in words if near(w, x)), key=lambda x: (-words[x], x))
        form = around[0] if around and words[around[0]] >= 2 * n else None
        forms[w] = form
        rows[w] = (n, len(around), words.get(form))
    out = set()
    for w, (n, n_near, form_n) in rows.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, n_near, form_n))
    return out


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    counts = Counter()
    for _ in range(700):
        counts["".join(rng.choice("abé") for _ in range(rng.randint(4, 8)))] = rng.choice([1, 2, 3, 4, 8, 16, 40, 100, 100])
    counts |= Counter({"aaaaa": 900, "aaaaaa": 400, "aaaaaaa": 100, "×÷ÿÀa": 7, "×÷ÿÀb": 3})
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    got, want = result(spelling.variants(df)), brute(counts)
    assert got == want
    assert any(row[2] not in (row[0], row[1]) for row in want)


def test_queries_words_with_odd_documents(spark):
    rows = corpus(60) + [(40_000 + k, "Überraschung ÜBERRASCHUNG überraschun TESTwort×÷ ") for k in range(30)]
    assert result(spelling.spelling_groups(frame(spark, rows), spelling.misspelt)) == brute(counted(rows))


def test_clashing_node_numbers_are_noticed(spark, monkeypatch):
    counts = {"abcde": 3, "abcdf": 9, "xbcde": 5}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    words = spelling.ranked_words(df)
    assert spelling._all_different(words, 1)
    right = spelling.trie_nodes

    def short(words, salt):
        nodes, starts = right(words, salt)
        return (nodes & 7 if salt < 3 else nodes), starts

    monkeypatch.setattr(spelling, "trie_nodes", short)
    monkeypatch.setattr(spelling, "_all_different", lambda words, salt: salt >= 3)
    assert result(spelling.variants(df)) == brute(counts)


def test_nodes_are_shared_by_prefixes_only():
    words = [np.frombuffer(w, np.uint8) for w in (b"abc", b"abd", b"b", b"")]
    nodes, starts = spelling.trie_nodes(words, 1)
    assert list(starts) == [0, 4, 8, 10, 11]
    assert (nodes[0:3] == nodes[4:7]).all() and nodes[3] != nodes[7]
    assert len(set(nodes.tolist())) == 6


def test_empty_table_and_long_word(spark):
    assert spelling.spelling_groups(empty(spark)).collect() == []
    long = "ab" * 100_000
    rows = [(1, long), (2, long), (3, long), (4, long[:-1]), (5, long[:-1]), (6, f"{long[:-1]} z")] + [(7, long)] * 3
    assert result(spelling.spelling_groups(frame(spark, rows))) == {
        (long, None, long, 6, 1, None),
        (long[:-1], long, long, 3, 1, 6),
    }
