"""Spelling variants: exact neighbours by pairs of trie nodes."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import mixed, numbering, numbers_of, slices, texts
from riskgrid.session import stage

#: Words have at least so many letters and occur at least so often.
SHORTEST = 5
RAREST = 3
#: A word's form occurs at least so many times as often.
RATIO = 2
#: Different words that a task counts before it sends them on.
MEMORY = 300_000
#: Letters of words whose nodes are numbered at once.
LETTERS = 1 << 18
#: Attempts to number all nodes differently.
SALTS = 8
#: Each round of root finding doubles the steps, and counts double at each step.
ROUNDS = 8
#: Longest words whose checksums and trie nodes are worked out many at a time.
SHORT = 64
#: By Latin-1 byte: A-Z in lower case, a-z and U+00C0 to U+00FF as they are, spaces for all others.
FOLDED = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))

#: Given document numbers, different words (Latin-1), and the document and the word of each occurrence: which
#: occurrences change, and to what.
Rewrite = Callable[[list, list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, list[bytes]]]
COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
PAIRS = pa.schema([("rank", pa.int64()), ("before", pa.int64()), ("after", pa.int64()), ("kind", pa.int32())])
NODES = pa.schema([("reverse", pa.bool_()), ("node", pa.int64()), ("depth", pa.int64()), ("parent", pa.int64()), ("letter", pa.int32())])
#: Kinds of pairs: nothing left out, a letter left out, and the same for the first letter of a run of equal letters.
GAP, SKIP, FIRST_SKIP = 0, 1, 2


def words_of(text: bytes) -> list[bytes]:
    """The runs of letters of a UTF-8 text, A-Z lower-cased, as Latin-1: other characters end a run."""
    return text.decode().encode("latin-1", "replace").translate(FOLDED).split()


def count_words(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """``word, n``: all runs of letters in all texts, lower-cased (A-Z only), and how often they occur.

    ``rewrite`` may change occurrences. Counts are summed in the tasks before they are sent, so a word that makes up a
    third of a corpus is a row per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in slices(batches):
            found = [words_of(t) for t in batch.column("text").to_pylist()]
            ids = numbering()
            of = numbers_of([w for words in found for w in words], ids)
            words = list(ids)
            many = np.bincount(of, minlength=len(words))
            if rewrite is not None:
                doc = np.repeat(np.arange(len(found)), [len(w) for w in found])
                changed, new = rewrite(batch.column("doc_id").to_pylist(), words, doc, of)
                many -= np.bincount(of[changed], minlength=len(words))
                counts.update(new)
            for word, n in zip(words, many.tolist()):
                counts[word] += n
            if len(counts) > MEMORY:
                yield from _counted(counts)
                counts.clear()
        yield from _counted(counts)

    return texts(docs).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter[bytes]) -> Iterator[pa.RecordBatch]:
    words = [w for w, n in counts.items() if n]
    for i in range(0, len(words), 1 << 16):
        part = words[i : i + (1 << 16)]
        numbers = np.fromiter((counts[w] for w in part), np.int64, len(part))
        plain = pa.array([w.decode("latin-1") for w in part], pa.string())
        yield pa.RecordBatch.from_arrays([plain, pa.array(numbers)], schema=COUNTS)


@cache
def _carried(length: int) -> np.ndarray:
    """What becomes of each byte of a crc32 when ``length`` more bytes follow: crc32(ab) is carried(a) ^ crc32(b)."""
    zeros = bytes(length)
    none = zlib.crc32(zeros)
    return np.array([[zlib.crc32(zeros, v << 8 * k) ^ none for v in range(256)] for k in range(4)], np.uint32)


def misspelt(doc_ids: list, words: list[bytes], doc: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Takes a letter out of about one run in 97, by the crc32 of ``<doc_id>:<run>``; documents without a number are
    left alone."""
    plain = [w.decode("latin-1").encode() for w in words]
    size = np.array([len(w) for w in plain], np.int64)
    own = np.array([zlib.crc32(w) for w in plain], np.uint32)
    seeds = np.array([0 if i is None else zlib.crc32(f"{i}:".encode()) for i in doc_ids], np.uint32)
    numbered = np.array([i is not None for i in doc_ids], bool)
    table = np.zeros((SHORT + 1, 4, 256), np.uint32)
    for n in np.unique(size[size <= SHORT]).tolist():
        table[n] = _carried(n)
    seed, n = seeds[doc], np.minimum(size, SHORT)[of]
    h = own[of]
    for k in range(4):
        h ^= table[n, k, (seed >> np.uint32(8 * k)) & np.uint32(255)]
    for i in np.flatnonzero(size[of] > SHORT).tolist():
        h[i] = zlib.crc32(plain[of[i]], int(seed[i]))
    changed = np.flatnonzero((h % 97 == 0) & numbered[doc])
    new = []
    for word, hash_ in zip(of[changed].tolist(), h[changed].tolist()):
        letters = words[word]
        at = hash_ % len(letters)
        new.append(letters[:at] + letters[at + 1 :])
    return changed, new


def trie_nodes(words: list[np.ndarray], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the trie nodes on the way of each word, and where each word's begin: one more than it has letters.

    A node's number is a digest of its parent's number and its letter, so words with a common prefix share the
    numbers of its nodes. That different nodes have different numbers is checked by ``_all_different``.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.r_[0, np.cumsum(lengths + 1)]
    out = np.full(starts[-1], _root(salt), np.uint64)
    letters = np.zeros(starts[-1], np.uint64)
    if len(words):
        inner = np.ones(starts[-1], bool)
        inner[starts[1:] - 1] = False
        letters[inner] = np.concatenate(words)
    # A letter after the other, of all words that are long enough; the rest of long words one by one.
    left = np.arange(len(words))
    for i in range(min(int(lengths.max(initial=0)), SHORT)):
        left = left[lengths[left] > i]
        at = starts[left] + i
        out[at + 1] = _child(out[at], letters[at])
    for k in np.flatnonzero(lengths > SHORT).tolist():
        at, end = int(starts[k]) + SHORT, int(starts[k + 1])
        rest = itertools.accumulate(letters[at : end - 1].tolist(), _slow_child, initial=int(out[at]))
        out[at:end] = np.fromiter(rest, np.uint64, end - at)
    return out.view(np.int64), starts


def _root(salt: int) -> int:
    return int(mixed(np.array([salt], np.uint64))[0])


def _child(node: np.ndarray, letter: np.ndarray) -> np.ndarray:
    node = (node + letter + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return node ^ (node >> np.uint64(32))


def _slow_child(node: int, letter: int) -> int:
    node = (node + letter + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return node ^ node >> 32


def _word_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Ranks and letters of words, about ``LETTERS`` at a time."""
    for batch in slices(batches, "word", LETTERS):
        words = [np.frombuffer(w.encode("latin-1"), np.uint8) for w in batch.column("word").to_pylist()]
        yield np.asarray(batch.column("rank"), dtype=np.int64), words


def _node_rows(salt: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _word_groups(batches):
            for reverse in (False, True):
                turned = [w[::-1] for w in words] if reverse else words
                nodes, starts = trie_nodes(turned, salt)
                last = np.zeros(len(nodes), bool)
                last[starts[1:] - 1] = True
                at = np.flatnonzero(~last)
                depth = np.arange(len(nodes)) - np.repeat(starts[:-1], np.diff(starts))
                letters = np.concatenate(turned).astype(np.int32) if turned else np.zeros(0, np.int32)
                columns = (np.full(len(at), reverse), nodes[at + 1], depth[at] + 1, nodes[at], letters)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), schema=NODES)

    return rows


def _all_different(words: DataFrame, salt: int) -> bool:
    """Whether each number belongs to one node of a trie: one depth, one parent, one letter. Then, from the root on,
    equal numbers mean equal prefixes (or suffixes)."""
    nodes = words.mapInArrow(_node_rows(salt), "reverse boolean, node bigint, depth bigint, parent bigint, letter int")
    way = F.struct("depth", "parent", "letter")
    ways = nodes.groupBy("reverse", "node").agg(F.min(way).alias("least"), F.max(way).alias("most"))
    root = int(np.uint64(_root(salt)).view(np.int64))
    return ways.where((F.col("least") != F.col("most")) | (F.col("node") == root)).isEmpty()


def _pair_rows(salt: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ranks, words in _word_groups(batches):
            lengths = np.array([len(w) for w in words], np.int64)
            forward, starts = trie_nodes(words, salt)
            backward, _ = trie_nodes([w[::-1] for w in words], salt)
            word = np.repeat(np.arange(len(words)), lengths + 1)
            place = np.arange(len(forward)) - starts[word]
            # backward[suffix] is the node of the suffix that begins at this place.
            suffix = starts[word] + lengths[word] - place
            inner = np.flatnonzero(place < lengths[word])
            letters = np.concatenate(words).astype(np.int32) if words else np.zeros(0, np.int32)
            same = np.zeros(len(inner), bool)
            same[1:] = (letters[1:] == letters[:-1]) & (place[inner][1:] > 0)
            kinds = np.where(same, SKIP, FIRST_SKIP)
            before = np.r_[forward, forward[inner]]
            after = np.r_[backward[suffix], backward[suffix[inner] - 1]]
            kind = np.r_[np.full(len(forward), GAP), kinds].astype(np.int32)
            rank = ranks[np.r_[word, word[inner]]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (rank, before, after, kind))), schema=PAIRS)

    return rows


def ranked_words(counts: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """Staged ``rank, word, n`` of the words that count: a smaller rank is a larger n, then a smaller word."""
    words = counts.where((F.col("n") >= rarest) & (F.char_length("word") >= shortest)).orderBy(F.desc("n"), "word")
    return stage(words.select(F.monotonically_increasing_id().alias("rank"), "word", "n"), "words")


def neighbours(words: DataFrame) -> DataFrame:
    """``rank, n_near, best`` of each word with near words: how many, and the smallest rank among them.

    A word gives a pair (node of what is before, node of what is after) for each letter left out, and one for each
    place between letters. Words that share a pair and a place differ there by one letter replaced, or one has a
    letter more. Of equal letters in a row only leaving out the first counts as that, so each near word is met once.
    A pair's words differ in one letter, so there are at most as many as letters, and one more.
    """
    for salt in range(1, SALTS + 1):
        if _all_different(words, salt):
            break
    else:
        raise RuntimeError("trie nodes could not be numbered differently")
    pairs = words.mapInArrow(_pair_rows(salt), "rank bigint, before bigint, after bigint, kind int")
    met = pairs.groupBy("before", "after").agg(F.sort_array(F.collect_list(F.struct("rank", "kind"))).alias("met"))
    met = met.where(F.size("met") > 1).select(
        "met",
        F.expr("filter(met, m -> m.kind > 0)").alias("skips"),
        F.expr("filter(met, m -> m.kind = 2)").alias("longer"),
        F.expr("filter(met, m -> m.kind = 0)").alias("shorter"),
    )
    each = met.select(F.explode("met").alias("m"), "skips", "longer", "shorter")
    replaced = F.expr("if(get(skips, 0).rank = m.rank, get(skips, 1).rank, get(skips, 0).rank)")
    near = F.when(F.col("m.kind") == GAP, F.size("longer"))
    near = near.when(F.col("m.kind") == SKIP, F.size("skips") - 1).otherwise(F.size("skips") - 1 + F.size("shorter"))
    best = F.when(F.col("m.kind") == GAP, F.expr("get(longer, 0).rank"))
    best = best.when(F.col("m.kind") == SKIP, replaced).otherwise(F.least(replaced, F.expr("get(shorter, 0).rank")))
    each = each.select(F.col("m.rank").alias("rank"), near.cast("long").alias("n_near"), best.alias("best"))
    return each.where("n_near > 0").groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _last(links: DataFrame) -> DataFrame:
    """``rank, to``: where the links from each rank end. Each round joins the links with themselves."""
    now = stage(links, "links")
    for _ in range(ROUNDS):
        there = now.select(F.col("rank").alias("at"), F.col("to").alias("further"))
        now = stage(now.join(there, F.col("to") == F.col("at"), "left").select("rank", F.coalesce("further", "to").alias("to"), F.col("at").isNotNull().alias("moved")), "links")
        if now.where("moved").isEmpty():
            return now.select("rank", "to")
        now = now.select("rank", "to")
    raise RuntimeError("links did not end")


def variants(counts: DataFrame, shortest: int = SHORTEST, rarest: int = RAREST, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``counts`` (``word, n``) that is long and frequent enough.

    Near words differ by one letter inserted, deleted or replaced. A word's form is the most frequent near word (of
    equals the first in code-point order) if it occurs ``ratio`` times as often; its root is what forms lead to.
    Words hold letters up to U+00FF. A word of a million letters gives two million pairs, no copies of itself.
    """
    words = ranked_words(counts, shortest, rarest)
    near = stage(neighbours(words), "near")
    others = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = words.join(near, "rank", "left").join(others, "best", "left")
    is_form = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    found = stage(
        found.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                     *[F.when(is_form, F.col(c)).alias(c) for c in ("best", "form", "form_n")]),
        "forms",
    )
    ends = _last(found.where("best is not null").select("rank", F.col("best").alias("to")))
    roots = ends.join(words.select(F.col("rank").alias("to"), F.col("word").alias("root")), "to").select("rank", "root")
    return found.join(roots, "rank", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_groups(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """``variants`` of the words of all texts.

    Null and empty texts have no words; a null number only matters to ``rewrite``; repeated rows count as often as they
    occur; ties go by code-point order; other columns are left out, so their names don't matter; an empty
    table gives no rows. Very long texts are counted whole.
    """
    return variants(count_words(docs, rewrite))
