"""Packing of tokenised documents into sequences by bin completion, on the histogram of piece lengths."""

from __future__ import annotations

import itertools
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.llm.common import kept, slices, texts
from riskgrid.session import shuffle_width, stage

CAPACITY = 2048
#: Words, and runs of letters in them, whose ids a Python worker remembers.
CACHE_WORDS, CACHE_LETTERS = 400_000, 450_000
#: ASCII marks but the apostrophe, which the tokenizer's rules single out.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Latin letters whose lower case is one letter each.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
#: Fillings that the search around one largest piece may look at before it takes its incumbent.
FILLING_NODES = 3000
#: Times that the whole search goes back and takes another filling.
BACKTRACKS = 12
_END = (0).to_bytes(4, "little")


class Memory:
    """Values of about ``most`` keys: those of late, and the generation before them.

    Full, it drops the older half, so that frequent keys stay however many rare ones pass by.
    """

    def __init__(self, most: int):
        self.most = most
        self.now: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def unknown(self, wanted: set[bytes]) -> set[bytes]:
        """Brings what is known of ``wanted`` into the present generation; the other keys are returned."""
        now, before = self.now, self.before
        missing = wanted.difference(now)
        back = {k: before[k] for k in missing if k in before}
        if len(now) + len(missing) > self.most // 2:
            self.now, self.before = {k: now[k] for k in wanted if k in now}, now
        self.now.update(back)
        return missing.difference(back)


class WordIds:
    """Token ids of texts, from the ids of their words.

    The tokenizer cuts at white space before it merges, so a text's ids are those of its words in order (ASCII blanks
    only: other white space is left to the tokenizer). It also cuts between letters and marks, and lowers letters: a
    word of Latin letters and then ASCII marks has the ids of the letters and then those of the marks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Memory(CACHE_WORDS)
        self.letters = Memory(CACHE_LETTERS)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [np.array(e.ids, "<u4").tobytes() for e in encode(texts, add_special_tokens=False)]

    def _learn_letters(self, wanted: set[bytes]) -> None:
        """All in one text: each run of letters is one word to the tokenizer, so its word numbers say whose an id is."""
        new = list(self.letters.unknown(wanted))
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            made = self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False)
            ids = np.array(made.ids, "<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(np.array(made.word_ids), minlength=len(part)))).tolist()
            self.letters.now.update((w, ids[a:b]) for w, a, b in zip(part, [0, *ends[:-1]], ends))

    def learn(self, words: set[bytes]) -> None:
        heads, rest = {}, []
        for word in words:
            head = word.rstrip(MARKS)
            if head.isalpha() or head and not head.isascii() and LATIN.fullmatch(head.decode("utf-8", "replace")):
                heads[word] = head
            else:
                rest.append(word)
        self._learn_letters(set(heads.values()))
        marks = list({word[len(head) :] for word, head in heads.items()})
        of_marks = dict(zip(marks, self._encoded([m.decode() for m in marks])))
        of_letters, known = self.letters.now, self.words.now
        for word, head in heads.items():
            known[word] = of_letters[head] if len(word) == len(head) else of_letters[head] + of_marks[word[len(head) :]]
        known.update(zip(rest, self._encoded([w.decode("utf-8", "replace") for w in rest])))

    def __call__(self, data: list[bytes]) -> list[bytes]:
        """Per text the ids and then id 0, as little-endian 32-bit numbers."""
        # Lower-casing first leaves fewer words; not where it could make the name of a special token.
        split = [(x if b"<|" in x else x.lower()).split() for x in data]
        self.learn(self.words.unknown(set().union(*split)))
        get = self.words.now.__getitem__
        return [b"".join(map(get, words)) + _END for words in split]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: documents longer than ``capacity`` are cut, the others are whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One for each tokenizer and Python worker: later tasks find the words of earlier ones.
        name = f"ids of words, {tokenizer_path}"
        for batch in slices(batches, keep=name):
            ids_of = kept(name, lambda: WordIds(tokenizer_path))
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of(batch.column("text").to_pylist())):
                n = len(ids) // 4
                for k, start in enumerate(range(0, n, capacity)):
                    end = min(n, start + capacity)
                    rows.append((doc, k, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
            schema = pa.schema([(x, pa.int32() if x == "piece" else pa.int64()) for x in names])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return texts(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---------------------------------------------------------------- the search, on counts by length


class Counts:
    """How many pieces of each length are left, and the lengths that are left in ascending order."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.lengths = sorted(k for k, n in counts.items() if n)

    def take(self, filling: dict[int, int], times: int) -> None:
        for length, m in filling.items():
            self.left[length] -= m * times
            if not self.left[length]:
                self.lengths.pop(bisect_right(self.lengths, length) - 1)


def best_fit(counts: Counts, room: int, used: dict[int, int]) -> dict[int, int]:
    """The incumbent: again and again the longest piece that still fits."""
    filling: dict[int, int] = {}
    while True:
        at = bisect_right(counts.lengths, room) - 1
        while at >= 0 and counts.left[counts.lengths[at]] <= used.get(counts.lengths[at], 0):
            at -= 1
        if at < 0:
            return filling
        length = counts.lengths[at]
        n = min(room // length, counts.left[length] - used.get(length, 0))
        filling[length] = filling.get(length, 0) + n
        used[length] = used.get(length, 0) + n
        room -= n * length


def completions(counts: Counts, room: int, largest: int, wanted: int = 1) -> list[dict[int, int]]:
    """Fillings of ``room`` beside a piece of length ``largest``, least waste first, at most ``wanted``.

    Depth first, long pieces first, so that of fillings with equal sums the one found is not dominated by (cannot be
    cut out of) a later one. A branch is left if even its longest remaining pieces can't bring the waste below the
    incumbent's, whose first is the best fit.
    """
    first = best_fit(counts, room, {largest: 1})
    waste_of = lambda f: room - sum(k * m for k, m in f.items())
    found = [(waste_of(first), first)]
    seen = {tuple(sorted(first.items()))}
    nodes = FILLING_NODES
    lengths, left = counts.lengths, counts.left
    # prefix[i]: all that pieces of the i shortest lengths could fill
    reach, total = [0], 0
    for k in lengths[: bisect_right(lengths, room)]:
        total += k * left[k]
        reach.append(total)
        if total >= room:
            break

    def bound() -> int:
        return found[-1][0] if len(found) >= wanted else room + 1

    def down(room_left: int, top: int, filling: dict[int, int]) -> None:
        nonlocal nodes
        at = bisect_right(lengths, min(room_left, top)) - 1
        if at < 0 or not room_left:
            key = tuple(sorted(filling.items()))
            if room_left < bound() and key not in seen:
                seen.add(key)
                found.append((room_left, dict(filling)))
                found.sort(key=lambda x: x[0])
                del found[wanted:]
            return
        deeper = False
        while at >= 0 and nodes > 0 and bound() > 0:
            length = lengths[at]
            free = left[length] - (length == largest)
            if at + 1 < len(reach) and room_left - reach[at + 1] >= bound():
                break
            for m in range(min(room_left // length, free), 0, -1):
                nodes -= 1
                deeper = True
                filling[length] = m
                down(room_left - m * length, length - 1, filling)
                del filling[length]
                if nodes <= 0 or bound() == 0:
                    return
            at -= 1
        if not deeper and nodes > 0:
            down(room_left, 0, filling)

    if found[0][0] > 0 or wanted > 1:
        down(room, room, {})
    return [f for _, f in sorted(found, key=lambda x: x[0])]


Pattern = tuple[dict[int, int], int]


def complete(histogram: dict[int, int], capacity: int, depart_at: int = -1, waste_limit: int | None = None) -> list[Pattern] | None:
    """Bins for all pieces: around the longest piece left, a filling; as often as the counts allow.

    At step ``depart_at`` the second-best filling is taken. None as soon as the waste exceeds ``waste_limit``.
    """
    counts, patterns, waste, step = Counts(histogram), [], 0, 0
    while counts.lengths:
        largest = counts.lengths[-1]
        room = capacity - largest
        choices = completions(counts, room, largest, 2 if step == depart_at else 1) if room else [{}]
        filling = dict(choices[-1])
        filling[largest] = filling.get(largest, 0) + 1
        times = min(counts.left[k] // m for k, m in filling.items())
        counts.take(filling, times)
        patterns.append((filling, times))
        if counts.lengths:
            waste += times * (capacity - sum(k * m for k, m in filling.items()))
            if waste_limit is not None and waste > waste_limit:
                return None
        step += 1
    return patterns


def bins_of(patterns: list[Pattern]) -> int:
    return sum(times for _, times in patterns)


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    total = sum(k * n for k, n in histogram.items())
    # Pieces over half fill a bin each; those of half or less can only fill what they leave (Martello and Toth's L2).
    best = -(-total // capacity)
    for cut in {0, *(k for k in histogram if 2 * k <= capacity)}:
        high = sum(n for k, n in histogram.items() if k > capacity - cut)
        middle = {k: n for k, n in histogram.items() if capacity - cut >= k > capacity / 2}
        low = sum(k * n for k, n in histogram.items() if cut <= k <= capacity / 2)
        free = sum((capacity - k) * n for k, n in middle.items())
        best = max(best, high + sum(middle.values()) + max(0, -(-(low - free) // capacity)))
    return best


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Fewest bins found: the incumbent, and better ones until the lower bound or the limit of backtracks is reached."""
    if not histogram:
        return []
    incumbent = complete(histogram, capacity)
    least, total = lower_bound(histogram, capacity), sum(k * n for k, n in histogram.items())
    steps = np.linspace(0, len(incumbent) - 1, min(BACKTRACKS, len(incumbent))).astype(int)
    for step in dict.fromkeys(steps.tolist()):
        if bins_of(incumbent) <= least:
            break
        limit = (bins_of(incumbent) - 1) * capacity - total
        other = complete(histogram, capacity, step, limit) if limit >= 0 else None
        if other and bins_of(other) < bins_of(incumbent):
            incumbent = other
    return incumbent


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first bin, pieces of the length in a bin, offset of the first) in order of rank."""
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    first_bin = 0
    for filling, times in patterns:
        offset = 0
        for length in sorted(filling, reverse=True):
            m = filling[length]
            rank = taken.get(length, 0)
            by_length.setdefault(length, []).append((rank, first_bin, m, offset))
            taken[length] = rank + m * times
            offset += m * length
        first_bin += times
    return {k: np.array(v, np.int64) for k, v in by_length.items()}


# ---------------------------------------------------------------- on Spark


def ranked(found: DataFrame, parts: int) -> DataFrame:
    """``rank``: 0, 1, 2, ... among the pieces of a length, counted in ``parts`` parts of each length and then put together."""
    salted = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    # At most CAPACITY * parts rows; a window per length holds ``parts`` of them.
    counts = salted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    offsets = counts.select("length", "part", before.alias("before"))
    in_part = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("in_part", F.row_number().over(in_part) - 1)
    return numbered.join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("in_part")).drop("part", "in_part", "before")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence and its place there.

    A null or empty text is one piece of the end token. Rows are pieces of their own even if repeated or without a
    number; pieces of one length are alike to the packing, so ties only decide which of them goes where. An empty
    table gives no rows; other columns are ignored. The driver sees only the counts by length (``capacity`` rows at
    most); the patterns sent back are bounded by the lengths too: each uses up one.
    """
    found = stage(pieces(docs, tokenizer_path, capacity), "pieces")
    histogram = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    places = slots(solve(histogram, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                size = int(length[rows[0]])
                table = places[size]
                hit = table[np.searchsorted(table[:, 0], rank[rows], side="right") - 1]
                inside = rank[rows] - hit[:, 0]
                sequence[rows] = hit[:, 1] + inside // hit[:, 2]
                offset[rows] = hit[:, 3] + inside % hit[:, 2] * size
            keep = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked(found, max(8, shuffle_width(found.sparkSession))).mapInArrow(run, schema)
