"""Periodic runs of words, found by block convolution at dyadic scales."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import numbering, numbers_of, slices, texts

#: A run has at least so many words, and at least so many periods.
SHORTEST = 6
PERIODS = 4
#: Words of a block that one transform compares; longer scales take several windows.
WIDEST = 1 << 15
#: Numbers that a batch of transforms holds.
BATCH = 1 << 18
#: Primes p with a power of two that divides p - 1, and a generator of each: sums are told apart up to their product.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("strongest", RUN), ("collapsed", pa.string())]
)


@cache
def _roots(p: int, g: int, half: int, inverse: bool) -> np.ndarray:
    """w^0 ... w^(half-1) for w of order 2 * half modulo p."""
    w = pow(g, (p - 1) // (2 * half), p)
    w = pow(w, p - 2, p) if inverse else w
    out = np.ones(half, np.uint64)
    span = 1
    while span < half:
        out[span : 2 * span] = out[:span] * np.uint64(pow(w, span, p)) % np.uint64(p)
        span *= 2
    return out


def _ntt(rows: np.ndarray, p: int, g: int) -> np.ndarray:
    """Number-theoretic transform of each row; the result is in bit-reversed order."""
    m, n = rows.shape
    q, half = np.uint64(p), n // 2
    while half:
        pairs = rows.reshape(m, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1]
        out = np.empty_like(pairs)
        total = u + v
        np.minimum(total, total - q, out=out[:, :, 0])
        np.remainder((u + q - v) * _roots(p, g, half, False), q, out=out[:, :, 1])
        rows, half = out, half // 2
    return rows.reshape(m, n)


def _inverse_ntt(rows: np.ndarray, p: int, g: int) -> np.ndarray:
    """Undo ``_ntt``."""
    m, n = rows.shape
    q, half = np.uint64(p), 1
    while half < n:
        pairs = rows.reshape(m, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1] * _roots(p, g, half, True) % q
        out = np.empty_like(pairs)
        total = u + v
        np.minimum(total, total - q, out=out[:, :, 0])
        total = u + q - v
        np.minimum(total, total - q, out=out[:, :, 1])
        rows, half = out, half * 2
    return rows.reshape(m, n) * np.uint64(pow(n, p - 2, p)) % q


def squared_differences(blocks: np.ndarray, windows: np.ndarray, p: int, g: int) -> np.ndarray:
    """Sum of (block[j] - window[o + j])^2 over j, modulo p, for each row and each offset o below the block's length."""
    m, size = blocks.shape
    q = np.uint64(p)
    mirrored = np.zeros((m, 2 * size), np.uint64)
    mirrored[:, 0] = blocks[:, 0]
    if size > 1:
        mirrored[:, : size : -1] = blocks[:, 1:]
    products = _ntt(mirrored % q, p, g) * _ntt(windows % q, p, g) % q
    cross = _inverse_ntt(products, p, g)[:, :size]
    own = np.sum(blocks * blocks % q, axis=1) % q
    squares = np.cumsum(windows * windows % q, axis=1)
    theirs = (squares[:, size - 1 : 2 * size - 1] - squares[:, :size] + (windows[:, :size] * windows[:, :size] % q)) % q
    return (own[:, None] + theirs + 2 * (q - cross)) % q


def occurrences(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ``size`` words and distances from ``size`` to below ``2 * size`` at which they occur again.

    ``starts`` are places of blocks in ``codes``, ``ends`` those where their texts end. A block longer than ``WIDEST`` is
    represented by its first words, so such a distance is necessary but not yet sufficient. The sum of squared
    differences is zero exactly where nothing differs: it is below the product of the primes used.
    """
    width = min(size, WIDEST)
    beyond = int(codes.max(initial=0)) + 1
    bound, primes = width * beyond * beyond, []
    for p, g in PRIMES:
        primes.append((p, g))
        bound //= p
        if not bound:
            break
    else:
        raise ValueError("too many different words")
    at, distances = [], []
    step = max(1, BATCH // (2 * width))
    for shift in range(size, 2 * size, width):
        fits = np.flatnonzero(starts + shift + width <= ends)
        for first in range(0, len(fits), step):
            rows = fits[first : first + step]
            block = starts[rows]
            blocks = codes[block[:, None] + np.arange(width)].astype(np.uint64)
            places = block[:, None] + shift + np.arange(2 * width)
            inside = places < ends[rows][:, None]
            windows = np.where(inside, codes[np.minimum(places, len(codes) - 1)], beyond).astype(np.uint64)
            alive, zero = np.arange(len(rows)), np.ones((len(rows), width), bool)
            for p, g in primes:
                if not len(alive):
                    break
                zero[alive] &= squared_differences(blocks[alive], windows[alive], p, g) == 0
                alive = alive[zero[alive].any(axis=1)]
            hit, offset = np.nonzero(zero)
            at.append(block[hit])
            distances.append(shift + offset)
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(at), np.concatenate(distances)


def _reach(codes: np.ndarray, places: np.ndarray, distances: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``places`` on, in direction ``step``, equal those ``distances`` later; at most ``room``."""
    reach = np.zeros(len(places), np.int64)
    active, width = np.flatnonzero(room > 0), 8
    while len(active):
        still = []
        for first in range(0, len(active), max(1, BATCH // width)):
            part = active[first : first + max(1, BATCH // width)]
            ahead = reach[part][:, None] + np.arange(width)
            valid = ahead < room[part][:, None]
            place = places[part][:, None] + step * np.where(valid, ahead, 0)
            equal = valid & (codes[place] == codes[place + distances[part][:, None]])
            run = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
            reach[part] += run
            still.append(part[(run == width) & (reach[part] < room[part])])
        active, width = np.concatenate(still), min(4 * width, 1 << 14)
    return reach


def _covering(low: np.ndarray, high: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which of ``runs`` (rows of start, end, period) holds all from ``low`` to ``high``: a row number, or -1."""
    if not len(runs):
        return np.full(len(low), -1)
    order = np.argsort(runs[:, 0], kind="stable")
    ends = runs[order, 1]
    furthest = np.maximum.accumulate(ends)
    which = order[np.maximum.accumulate(np.where(ends == furthest, np.arange(len(ends)), 0))]
    last = np.searchsorted(runs[order, 0], low, side="right") - 1
    held = (last >= 0) & (furthest[np.maximum(last, 0)] >= high)
    return np.where(held, which[np.maximum(last, 0)], -1)


def _promising(at: np.ndarray, distance: np.ndarray, size: int, width: int, runs: np.ndarray) -> np.ndarray:
    """Leaves out occurrences that, by what is known of smaller periods, can't be part of a run of period ``distance``.

    A block in a run of a small period occurs at many distances. If all up to the end of the other block is one run, there
    is no new one. If the blocks are in two such runs, equality ends where the first of them ends, on either side, unless
    both end at that distance of each other; so one of the sides must.
    """
    keep = _covering(at, at + distance + size, runs) < 0
    small = runs[4 * runs[:, 2] <= width]
    here, there = _covering(at, at + width, small), _covering(at + distance, at + distance + width, small)
    both = (here >= 0) & (there >= 0)
    if both.any():
        apart = (small[there, :2] - small[here, :2] != distance[:, None]).all(axis=1)
        keep &= ~(both & apart)
    return keep


def find(codes: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)`` of texts that lie one after another in ``codes``, bounded by ``offsets``.

    A run of period p with size <= p < 2 * size (a power of two) and four periods holds a block of ``size`` words, aligned
    in its text, that occurs again p words later. So at each size the aligned blocks are compared with the windows after them by
    convolution, and each distance found is extended to both sides word by word. Left out are only blocks that can't be such:
    those with a word that doesn't come again within 2 * size words, those whose whole window lies in a run of a smaller
    period (two runs of different smallest periods never share as many words as both periods have), and see ``_promising``.
    """
    n, lengths = len(codes), np.diff(offsets)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    key = doc * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    again = key[order[1:]] == key[order[:-1]]
    worst = np.full(n, n + 1)
    worst[order[:-1][again]] = (order[1:] - order[:-1])[again]
    start = np.arange(n)
    index = start - offsets[doc]
    runs: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()
    size = 1
    while True:
        enough = lengths[doc] >= max(PERIODS * size, SHORTEST)
        start, index, doc, worst = start[enough], index[enough], doc[enough], worst[enough]
        if not len(start):
            return runs
        alive = np.flatnonzero((worst < 2 * size) & (start + 2 * size <= offsets[doc + 1]))
        smaller = np.array(runs, np.int64).reshape(-1, 3)
        alive = alive[_covering(start[alive], np.minimum(start[alive] + 3 * size, offsets[doc[alive] + 1]), smaller) < 0]
        at, distance = occurrences(codes, start[alive], offsets[doc[alive] + 1], size)
        promising = _promising(at, distance, size, min(size, WIDEST), smaller)
        at, distance = at[promising], distance[promising]
        for run in _extended(codes, offsets, at, distance, min(size, WIDEST)):
            if run[:2] not in known:
                known.add(run[:2])
                runs.append(run)
        # Two neighbouring blocks of a text make one of the next size.
        pair = np.flatnonzero((index[:-1] % 2 == 0) & (doc[1:] == doc[:-1]))
        worst = np.maximum(worst[pair], worst[pair + 1])
        start, index, doc = start[pair], index[pair] // 2, doc[pair]
        size *= 2


def _extended(codes, offsets, at, distance, width) -> list[tuple[int, int, int]]:
    """Maximal stretches of at least four periods around blocks at ``at`` that occur again at ``distance``."""
    if not len(at):
        return []
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    # Blocks that follow each other at one distance are one stretch.
    new = np.r_[True, (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + width)]
    low, distance = at[new], distance[new]
    high = np.r_[at[1:][new[1:]], 0]
    high[:-1] = at[:-1][new[1:]]
    high[-1] = at[-1]
    high = high + width
    text = np.searchsorted(offsets, low, side="right") - 1
    begin, end = offsets[text], offsets[text + 1]
    low = low - _reach(codes, low - 1, distance, low - begin, -1)
    high = high + _reach(codes, high, distance, end - distance - high, 1)
    stop = high + distance
    good = stop - low >= np.maximum(PERIODS * distance, SHORTEST)
    return list(dict.fromkeys(zip(low[good].tolist(), stop[good].tolist(), distance[good].tolist())))


def _results(ids: list, split: list[list[bytes]]) -> Iterator[dict]:
    lengths = np.array([len(w) for w in split], np.int64)
    offsets = np.r_[0, np.cumsum(lengths)]
    codes = numbers_of([w for words in split for w in words], numbering())
    by_text: dict[int, list] = {}
    for low, stop, period in sorted(find(codes, offsets), key=lambda r: (r[0], r[2])):
        text = int(np.searchsorted(offsets, low, side="right") - 1)
        by_text.setdefault(text, []).append((low - int(offsets[text]), stop - low, period))
    for i, (doc_id, words) in enumerate(zip(ids, split)):
        runs = by_text.get(i, [])
        best = None
        for run in runs:
            # Exponents are compared as fractions; the first of equal ones has the smallest start and period.
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        kept = words
        if runs:
            marks = np.zeros(len(words) + 1, np.int64)
            for start, length, period in runs:
                marks[start + period] += 1
                marks[start + length] -= 1
            kept = [words[j] for j in np.flatnonzero(np.cumsum(marks[:-1]) == 0)]
        named = [dict(zip(("start", "length", "period"), r)) for r in runs]
        strongest = None if best is None else dict(zip(("start", "length", "period"), best))
        yield {
            "doc_id": doc_id,
            "n_words": len(words),
            "runs": named,
            "strongest": strongest,
            "collapsed": b" ".join(kept).decode(),
        }


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id, n_words, runs, strongest, collapsed`` of every text.

    Words are what ASCII white space leaves, of whole texts; ``rewrite`` may change a text's words first. A run is a
    stretch of words with smallest period q, of at least 6 words and 4 * q, that can't be made longer on either side.
    ``runs`` are in order of start, then period; ``strongest`` has the greatest length by period, then the smallest
    start, then the smallest period (null without runs). ``collapsed`` has each run's first period only, words joined by one space.
    Null and empty texts, and those of white space, have no words and no runs. Null numbers and repeated rows give rows
    like others, one per row. Other columns are left out, so their names don't matter; an empty table gives no rows.
    Very long texts are whole in one task, in memory that grows in proportion; the work of a size grows by n log n.
    """

    def find_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            split = [t.split() for t in batch.column("text").to_pylist()]
            if rewrite is not None:
                split = [rewrite(i, w) for i, w in zip(ids, split)]
            yield pa.RecordBatch.from_pylist(list(_results(ids, split)), schema=FOUND)

    run = "struct<start:bigint,length:bigint,period:bigint>"
    schema = f"doc_id bigint, n_words bigint, runs array<{run}>, strongest {run}, collapsed string"
    return texts(docs).mapInArrow(find_all, schema)


def made_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of about one text in ten, with its end made periodic; a text without a number stays."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digests(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: its count, its strongest run, and digests of all runs and of the collapsed text."""
    line = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
