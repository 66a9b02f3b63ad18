"""Shared helpers: table access, texts as bytes, bounded slices of Arrow batches, token numbering."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import itertools
import sys
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one slice of a batch holds (more only if a single text is longer).
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` as bytes (null: empty); other columns, whatever their names, are left out."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more)


def id_remainder(modulus: int):
    """crc32 of the document number written as text, modulo ``modulus``; null for a null number."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps under ``name`` for its later tasks, until it reads slices for something else."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, keep: str | None = None
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in pieces of about ``limit`` bytes of ``column``.

    What earlier tasks of this worker kept under other names than ``keep`` is let go first.
    """
    others = [name for name in _KEPT if name != keep]
    for name in others:
        del _KEPT[name]
    if others:
        trim()
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    trim()


def trim() -> None:
    """Give freed memory back to the system: Python workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def numbering() -> defaultdict:
    """A dictionary that numbers new keys 0, 1, 2, ... as they are looked up."""
    return defaultdict(itertools.count().__next__)


def numbers_of(words: list, ids: defaultdict) -> np.ndarray:
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value scattered over all 64 bits (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans_text(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def stable_sample(df: DataFrame, rows: int, salt: str) -> DataFrame:
    """At most ``rows`` rows with different numbers, the first by a salted digest: the same for any partitioning.

    Only numbers are ordered; the rows come by a join with the chosen ones, at most ``rows`` of them.
    """
    chosen = (
        df.where(F.col("doc_id").isNotNull())
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64(F.lit(salt), F.col("doc_id")), "doc_id")
        .limit(rows)
    )
    return df.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
