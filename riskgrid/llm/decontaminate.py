"""Benchmark decontamination: q-grams of whole items in diagonal bands, passages verified by bit-parallel alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import mixed, slices, texts

Q = 12
#: A passage of a benchmark item: so many bytes from each word on (less for short items, see passage_bytes). At most 64.
WINDOW = 64
#: Edits allowed, as a share of the passage: a replaced word or two.
EDIT_SHARE = 0.125
#: q-grams of a passage that must stand in one diagonal band. See ``sure_edits``.
SHARED = 5
#: Pairs of places that are looked at together, and bytes that two such looks have in common (a passage and its band).
ENTRIES = 300_000
OVERLAP = 2 * WINDOW
#: Shorter items are no evidence: they occur by chance.
SHORTEST = 40
#: Bytes of benchmark text that are broadcast at once; a larger benchmark takes more passes over the documents.
BLOCK_BYTES = 4 << 20
_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: bytes) -> bytes:
    """Lower case, runs of ASCII white space as one space, none at the ends."""
    return b" ".join(text.decode("utf-8", "replace").lower().encode().split())


def qgram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q bytes from each place on."""
    h = mixed(np.arange(1, 257, dtype=np.uint64))[data]
    if len(h) < Q:
        return np.zeros(0, np.uint64)
    have, span = {1: h}, 1
    with np.errstate(over="ignore"):
        while 2 * span <= Q:
            part = have[span]
            have[2 * span] = part[:-span] * _BASE ** np.uint64(span) + part[span:]
            span *= 2
        out, size = have[span], span
        while size < Q:
            span //= 2
            if size + span <= Q:
                n = len(data) - size - span + 1
                out = out[:n] * _BASE ** np.uint64(span) + have[span][size : size + n]
                size += span
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out


def passage_bytes(length: int) -> int:
    """Bytes of the passages of an item: a little under half of a short item, so that half of any item holds one."""
    return min(length, WINDOW, max(SHORTEST, length // 2 - 8))


@dataclass
class Index:
    """The items of one block of the benchmark, where each of their q-grams stands, and their passages."""

    data: np.ndarray  # the bytes of all items, one after another
    hashes: np.ndarray  # sorted, one entry for each place
    item: np.ndarray  # row of the item, by hash
    place: np.ndarray  # place in the item, by hash
    present: np.ndarray  # by the hash's first bits
    items: np.ndarray  # item_id by passage
    rows: np.ndarray  # row of the item, by passage
    starts: np.ndarray  # place in the item, by passage
    first: np.ndarray  # place in data, by passage
    sizes: np.ndarray  # bytes, by passage
    length: np.ndarray  # bytes of the passages, by row of the item

    @staticmethod
    def of(rows: list[tuple[int, bytes]]) -> Index:
        kept = [(item, plain) for item, text in rows if len(plain := normalised(text)) >= SHORTEST]
        plains = [np.frombuffer(plain, np.uint8) for _, plain in kept]
        offsets = np.cumsum([0] + [len(x) for x in plains])
        length = np.array([passage_bytes(len(x)) for x in plains], np.int64)
        starts = []
        for x, size in zip(plains, length.tolist()):
            words = np.flatnonzero(x == 32) + 1
            last = len(x) - size
            starts.append(np.unique(np.r_[0, words[words < last], last]))
        made = [qgram_hashes(x) for x in plains]
        none = np.zeros(0, np.int64)
        hashes = np.concatenate(made) if made else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        present = np.zeros(1 << _BITS, bool)
        present[hashes >> np.uint64(64 - _BITS)] = True
        item = np.repeat(np.arange(len(made)), [len(x) for x in made])
        place = np.concatenate([np.arange(len(x)) for x in made]) if made else none
        row = np.repeat(np.arange(len(starts)), [len(x) for x in starts])
        start = np.concatenate(starts) if starts else none
        ids = np.array([i for i, _ in kept], np.int64)
        return Index(
            np.concatenate(plains) if plains else np.zeros(0, np.uint8), hashes[order], item[order], place[order], present,
            ids[row], row, start, offsets[row] + start, length[row], length,
        )

    @property
    def passages(self) -> list[bytes]:
        return [self.data[f : f + n].tobytes() for f, n in zip(self.first.tolist(), self.sizes.tolist())]


def budget(length: int) -> int:
    """Edits that a passage may have where it is found."""
    return int(length * EDIT_SHARE)


def sure_edits(length: int) -> int:
    """Edits with which a passage is found wherever they are: each spoils at most Q of its q-grams, and SHARED remain."""
    return (length - Q + 1 - min(SHARED, length - Q + 1)) // Q


def edits(passage: bytes, region: bytes, first: int, most: int) -> int:
    """Fewest edits from ``passage`` to a piece of ``region``, at most ``most`` + 1.

    The alignment stays within the diagonals first - most ... first + 3 * most of region against passage; begin and end
    in the region are free. The plain form of fewest_edits, for one passage of any length.
    """
    if passage in region:
        return 0
    low, width = first - most, 4 * most + 1
    text = np.frombuffer(region, np.uint8)
    big = most + 1
    shifts = np.arange(width)
    at = low + shifts  # column of each diagonal before the first passage byte
    row = np.where((at >= 0) & (at <= len(text)), 0, big)
    for k, byte in enumerate(passage, 1):
        column = low + shifts + k
        valid = (column >= 0) & (column <= len(text))
        letter = text[np.clip(column - 1, 0, len(text) - 1)] if len(text) else np.zeros(width, np.uint8)
        change = row + np.where((column >= 1) & (letter == byte), 0, 1)
        skip = np.r_[row[1:], big] + 1
        best = np.where(valid, np.minimum(change, skip), big)
        # An extra letter of the region: the running minimum of (value - shift) + shift.
        best = np.minimum.accumulate(best - shifts) + shifts
        row = np.minimum(np.where(valid, best, big), big)
        if row.min() >= big:
            return big
    return int(row.min())


def fewest_edits(index: Index, passage: np.ndarray, text: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Fewest edits from each passage to a piece of text[begin:stop], begin and end free: Myers' bit vectors."""
    known, number = np.unique(passage, return_inverse=True)
    size = index.sizes[known]
    letters = np.zeros((len(known), 257), np.uint64)  # the last column is for places outside the region
    for k in range(int(size.max())):
        at = np.flatnonzero(size > k)
        letters[at, index.data[index.first[known[at]] + k]] |= np.uint64(1 << k)
    one = np.uint64(1)
    score = index.sizes[passage]
    top = one << (score - 1).astype(np.uint64)
    best = score.copy()
    more, less = np.full(len(passage), ~np.uint64(0)), np.zeros(len(passage), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(int((stop - begin).max())):
            at = begin + k
            letter = np.where(at < stop, text[np.minimum(at, len(text) - 1)], 256)
            same = letters[number, letter]
            down = same | less
            along = (((same & more) + more) ^ more) | same
            up, low = less | ~(along | more), more & along
            score = score + ((up & top) != 0) - ((low & top) != 0)
            up, low = up << one, low << one
            more, less = low | ~(down | up), up & down
            best = np.minimum(best, score)
    return best


def matches(data: list[bytes], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item, edits, shared q-grams, place) of verified passages in normalised texts, best per text and item."""
    plain = [normalised(x) for x in data]
    joined = np.frombuffer(b"\0".join(plain), np.uint8)
    found = qgram_hashes(joined)
    if not len(found) or not len(index.hashes):
        return
    hit = np.flatnonzero(index.present[found >> np.uint64(64 - _BITS)])
    low = np.searchsorted(index.hashes, found[hit], side="left")
    many = np.searchsorted(index.hashes, found[hit], side="right") - low
    hit, low, many = hit[many > 0], low[many > 0], many[many > 0]
    if not len(hit):
        return
    offsets = np.cumsum([0] + [len(x) + 1 for x in plain])
    parts = [_verified(index, joined, offsets, hit[p], low[p], many[p]) for p in _pieces(hit, many)]
    doc, item, cost, shared, at = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((at, -shared, cost, item, doc))
    doc, item, cost, shared, at = doc[order], item[order], cost[order], shared[order], at[order]
    best = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else order
    yield from zip(*(x[best].tolist() for x in (doc, item, cost, shared, at)))


def _pieces(hit: np.ndarray, many: np.ndarray) -> Iterator[slice]:
    """Stretches of the places in ``hit`` that share about ENTRIES q-grams with the items, whatever the texts repeat.

    Each begins OVERLAP bytes before the last one's end: all q-grams of a passage, wherever it is, are in one of them.
    """
    upto, start = np.cumsum(many), 0
    while start < len(hit):
        base = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, base + ENTRIES, side="right")))
        yield slice(int(np.searchsorted(hit, hit[start] - OVERLAP)), stop)
        start = stop


def _verified(index: Index, joined: np.ndarray, offsets: np.ndarray, hit: np.ndarray, low: np.ndarray, many: np.ndarray):
    """(text number, item, edits, shared q-grams, place) of the verified passages at some places, as arrays."""
    nothing = tuple(np.zeros(0, np.int64) for _ in range(5))
    doc_of_hit = np.searchsorted(offsets, hit, side="right") - 1
    # Every (place in the text, place in an item) that share a q-gram.
    entry = ranges(low, many)
    doc, at = np.repeat(doc_of_hit, many), np.repeat(hit - offsets[doc_of_hit], many)
    row, place = index.item[entry], index.place[entry]
    # Bands of 2(e + 1) diagonals that begin e + 1 apart: any e + 1 neighbouring diagonals are whole in one of them.
    budgets = np.array([budget(n) for n in index.length.tolist()])
    band = (at - place) // (budgets[row] + 1)
    keys = np.r_[np.c_[doc, row, band, place], np.c_[doc, row, band - 1, place]]
    keys = keys[np.lexsort(keys.T[::-1])]
    # A q-gram of the item counts once in a band, however often the text repeats it.
    keys = keys[np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]]
    new = np.r_[True, (keys[1:, :3] != keys[:-1, :3]).any(axis=1)]
    group = np.cumsum(new) - 1
    doc, row, band, place = keys.T
    # The passages that hold SHARED q-grams in a row of a band, fewer if a passage has no more.
    needed = np.minimum(SHARED, index.length[row] - Q + 1)
    last = np.arange(len(group)) + needed - 1
    inside = last < len(group)
    inside[inside] = group[last[inside]] == group[inside]
    k = np.flatnonzero(inside)
    span = int(index.starts.max()) + 1
    where = index.rows * span + index.starts
    from_ = np.maximum(place[last[k]] + Q - index.length[row[k]], 0)
    to = np.minimum(place[k], span - 1)
    low = np.searchsorted(where, row[k] * span + np.minimum(from_, span - 1), side="left")
    many = np.where(from_ <= to, np.searchsorted(where, row[k] * span + to, side="right") - low, 0)
    passage, group_of = ranges(low, many), group[np.repeat(k, many)]
    if not len(passage):
        return nothing
    pairs = np.unique(group_of * len(where) + passage)
    group_of, passage = pairs // len(where), pairs % len(where)
    head = np.flatnonzero(new)[group_of]
    doc, band, start = doc[head], band[head], index.starts[passage]
    # group * step + place is sorted, as places are within a group.
    step = int(place.max()) + Q + 1
    order = group * step + place
    shared = np.searchsorted(order, group_of * step + np.minimum(start + index.sizes[passage] - Q, step - 1), side="right")
    shared -= np.searchsorted(order, group_of * step + start, side="left")
    most = budgets[index.rows[passage]]
    at = start + band * (most + 1)
    begin = offsets[doc] + np.maximum(0, at - most)
    stop = np.minimum(offsets[doc + 1] - 1, offsets[doc] + at + 2 * (most + 1) + index.sizes[passage] + most)
    cost = np.empty(len(passage), np.int64)
    for k in range(0, len(passage), 4096):
        part = slice(k, k + 4096)
        cost[part] = fewest_edits(index, passage[part], joined, begin[part], stop[part])
    good = np.flatnonzero(cost <= most)
    return doc[good], index.items[passage[good]], cost[good], shared[good], np.maximum(0, at[good])


def ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each pair, ``many`` numbers."""
    return np.repeat(first - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum()) if len(many) else first


def blocks(benchmark: DataFrame, numberless: bool = False) -> Iterator[Index]:
    """Indexes of the benchmark in blocks of a bounded number of bytes, read by the driver one after another.

    Items without a number are left out, or, with ``numberless``, dealt out by their texts and numbered -1.
    """
    rows = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )
    rows = rows if numberless else rows.where(F.col("item_id").isNotNull())
    deal = F.xxhash64(F.coalesce("item_id", F.xxhash64("text")))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for k in range(n):
        part = rows.where(F.pmod(deal, F.lit(n)) == k).orderBy("item_id").collect()
        yield Index.of([(-1 if r["item_id"] is None else r["item_id"], bytes(r["text"])) for r in part])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item of which it holds a passage.

    Passages begin at each word of an item and at its end, so a stretch of passage_bytes and a word holds one. A passage
    within ``sure_edits`` (4 of 64 bytes, 2 of 40) is always found, by the q-gram lemma. One with more, up to ``budget``
    (8 of 64 bytes), is found if SHARED of its q-grams stand in one band, as where a word or two are replaced; edits
    spread evenly leave no q-gram then, and it is not found. ``edits`` is the smallest
    edit distance over the item's passages, ``shared_qgrams`` and ``place`` (bytes into the normalised text, to within the
    band) those of that passage. Null and empty texts hold nothing; items shorter than
    SHORTEST are no evidence. Rows are searched alone, so repeated rows give repeated rows; rows without a number are
    left out; an empty table on either side gives no rows; other columns are ignored. Of very long texts, a
    stretch after the other is compared, so that memory grows with the text alone, also where it repeats a q-gram of an item.
    """
    schema = "doc_id long, item_id long, edits int, shared_qgrams long, place long"
    session = docs.sparkSession
    out = None
    for index in blocks(benchmark):
        shared = session.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, limit=1 << 20):
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[d], *rest) for d, *rest in matches(batch.column("text").to_pylist(), shared.value)]
                columns = list(zip(*rows)) if rows else [[]] * 5
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                names = ["doc_id", "item_id", "edits", "shared_qgrams", "place"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        part = texts(docs.where(F.col("doc_id").isNotNull())).mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return session.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no passage of the benchmark, numbered or not. Null texts stay."""
    session = docs.sparkSession
    for index in blocks(benchmark, numberless=True):
        shared = session.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, limit=1 << 20):
                data = [(x or "").encode() for x in batch.column("text").to_pylist()]
                clean = np.ones(len(data), bool)
                for d, *_ in matches(data, shared.value):
                    clean[d] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
