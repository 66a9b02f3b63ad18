"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import mixed, slices, texts
from riskgrid.session import stage

#: A cut is where the rolling hash is the largest within so many bytes on both sides: a chunk is longer than this.
REACH = 24
#: Longer chunks (of repetitive text) are cut at every so many bytes.
LONGEST = 1024
#: A repeated stretch counts from so many bytes on. A passage of 51 words holds chunks of this together.
SHORTEST_REPEAT = 64
GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash h = 2h + gear[byte] at every byte; 32 bits, so it sees the last 32 bytes. By doubling the span."""
    h = GEAR[data]
    for span in (1, 2, 4, 8, 16):
        h[span:] += h[:-span] << np.uint32(span)
    return h


def sliding_max(values: np.ndarray, width: int) -> np.ndarray:
    """Largest of values[i : i + width] for each i with a whole window."""
    span, top = 1, values
    while 2 * span <= width:
        top = np.maximum(top[:-span], top[span:])
        span *= 2
    rest = width - span
    return np.maximum(top[: len(top) - rest], top[rest:]) if rest else top


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text (without 0, with its length).

    A chunk ends after a byte whose hash is above those of the REACH bytes before and not below those of the REACH
    bytes after. That looks at nearby bytes only, so an insertion changes the chunks around it and no others.
    """
    n = len(data)
    ends = np.zeros(0, np.int64)
    if n > 2 * REACH + 1:
        h = gear_hashes(data)
        around = sliding_max(h, REACH)
        middle = h[REACH : n - REACH]
        before = around[: n - 2 * REACH]
        after = around[REACH + 1 : REACH + 1 + len(middle)]
        ends = np.flatnonzero((middle > before) & (middle >= after)) + REACH + 1
    ends = np.r_[ends, n] if n and (not len(ends) or ends[-1] != n) else ends
    gaps = np.diff(np.r_[0, ends])
    if len(gaps) and gaps.max() > LONGEST:
        ends = np.array([x for a, b in zip(np.r_[0, ends[:-1]], ends) for x in (*range(a + LONGEST, b, LONGEST), b)])
    return ends


def chunked(docs: DataFrame) -> DataFrame:
    """One row per chunk: its document, place and 128-bit digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in slices(batches, limit=2 << 20):
            doc_parts, start_parts, size_parts, digests = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ends = cuts(np.frombuffer(text, np.uint8))
                starts = np.r_[0, ends[:-1]] if len(ends) else ends
                doc_parts += [doc] * len(ends)
                start_parts.append(starts)
                size_parts.append(ends - starts)
                digests += [digest(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            two = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_parts, pa.int64()),
                    pa.array(np.concatenate(start_parts) if start_parts else [], pa.int32()),
                    pa.array(np.concatenate(size_parts) if size_parts else [], pa.int32()),
                    pa.array(two[:, 0]),
                    pa.array(two[:, 1]),
                ],
                names=["doc_id", "start", "size", "high", "low"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, start int, size int, high long, low long")


def repeats(docs: DataFrame, shortest: int = SHORTEST_REPEAT) -> DataFrame:
    """Documents with repeated passages: one row each, with the stretches that dedup takes out.

    Of equal chunks the one of the smallest (doc_id, start) is kept, every other one is a repeat. ``spans`` are the
    stretches (``start:end`` in bytes of UTF-8, comma-joined) of consecutive repeats of at least ``shortest`` bytes,
    ``first_docs`` the documents that keep their chunks (sorted, also the document itself if it repeats itself).
    ``n_chunks`` and ``n_repeats`` count chunks in these stretches. Documents without such a stretch, thus also null
    and empty texts, give no row, nor do rows without a number. Repeated rows with one number count as one document
    whose later copies repeat nothing new. An empty table gives none; other columns are ignored.
    """
    found = stage(chunked(docs.where(F.col("doc_id").isNotNull())), "chunks")
    place = F.struct("doc_id", "start")
    # Partial sums meet in the map tasks: a chunk of a third of all texts is one row a task.
    first = (
        found.groupBy("high", "low")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("high", "low", F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first_start"))
    )
    again = found.join(first, ["high", "low"]).where(
        (F.col("doc_id") != F.col("first_doc")) | (F.col("start") != F.col("first_start"))
    )
    schema = "doc_id long, n_repeats long, repeated_bytes long, spans string, first_docs array<long>"
    return again.select("doc_id", "start", "size", "first_doc").groupBy("doc_id").applyInArrow(
        lambda rows: stretches(rows, shortest), schema
    )


def stretches(rows: pa.Table, shortest: int) -> pa.Table:
    """The repeats of one document joined to stretches; a document's chunks are bounded by its text."""
    start = rows.column("start").to_numpy().astype(np.int64)
    size = rows.column("size").to_numpy().astype(np.int64)
    source = rows.column("first_doc").to_numpy()
    start, at = np.unique(start, return_index=True)
    end, source = start + size[at], source[at]
    group = np.cumsum(np.r_[0, start[1:] != end[:-1]]) if len(start) else start
    low, high = np.full(group[-1] + 1, start[-1]), np.zeros(group[-1] + 1, np.int64)
    np.minimum.at(low, group, start)
    np.maximum.at(high, group, end)
    long = high - low >= shortest
    kept = long[group]
    names = ["doc_id", "n_repeats", "repeated_bytes", "spans", "first_docs"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
    out: list[list] = [[], [], [], [], []]
    if kept.any():
        spans = ",".join(f"{a}:{b}" for a, b in zip(low[long].tolist(), high[long].tolist()))
        values = (rows.column("doc_id")[0].as_py(), int(kept.sum()), int((high - low)[long].sum()), spans, np.unique(source[kept]).tolist())
        out = [[x] for x in values]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
