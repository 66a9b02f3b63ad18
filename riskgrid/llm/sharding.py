"""Shards in random order, by a two-pass external shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskgrid.llm.common import mixed, slices, trim
from riskgrid.session import delete, scratch_path

SHARDS = 40
SEED = 11
#: Bytes of records that a bucket holds on average: one task has it in memory.
BUCKET_BYTES = 32 << 20
#: Bytes of a record beside its text.
OVERHEAD = 16
#: Offsets of so many buckets are broadcast (8 bytes each, and a number); beyond that the join is left to Spark.
BROADCAST_BUCKETS = 1 << 20
#: What the shards have in common: their counts of rows are at most one apart.
LAW = "rows"


def record_size(text="document.text"):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit key: the upper half of the key, scaled."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def scatter_keys(digests: np.ndarray, seen: dict[int, int], seed: int, partition: int) -> np.ndarray:
    """A seeded key for each record.

    It depends on the record alone; only the second and later of equal records in a partition also take their
    count and the partition's number, so that a record repeated any number of times is scattered like others.
    Equal records are interchangeable: a task that runs again gives the same keys in whatever order it reads.
    """
    keys = mixed(mixed(digests.view(np.uint64)) + np.uint64(seed))
    again = []
    for i, digest in enumerate(digests.tolist()):
        count = seen.get(digest, 0)
        seen[digest] = count + 1
        if count:
            again.append((i, count))
    if again:
        at, counts = np.array(again, dtype=np.uint64).T
        at = at.astype(np.int64)
        keys[at] = mixed(mixed(keys[at] + counts) + np.uint64(partition + 1))
    return keys


def fisher_yates(rows: int, seed: int, bucket: int) -> np.ndarray:
    """A random order of ``rows`` places; numpy's shuffle is Fisher and Yates'."""
    order = np.arange(rows)
    np.random.Generator(np.random.Philox(key=np.array([seed, bucket], np.uint64))).shuffle(order)
    return order


def shuffle(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all rows of ``docs`` in random order to ``path``, as ``shards`` folders ``shard=0``, ``shard=1``, ...

    First pass: every row goes to one of ``buckets`` by a seeded hash of all its columns; their number is the table's
    bytes by ``bucket_bytes``. Second pass: a task reads one bucket, puts it in order of the keys, shuffles it by Fisher
    and Yates' method and writes it. The buckets one after another are a random order of the table; a row's position
    in it gives its shard, ``floor(position * shards / rows)``, so shards differ by one row at most, and its ``slot``.
    The same rows and seed give the same order for any partitioning (but see ``scatter_keys`` for equal rows).

    Returned and written: ``shard``, ``slot`` (from 0 without gaps in each shard) and ``document``, a struct of all
    columns, so columns of any name can't clash. Null texts stay null, and null numbers, empty texts and repeated rows
    are rows like others; ties are equal rows. Of an empty table nothing is written. Shards may be empty if there are
    fewer rows than shards. A very long text makes its bucket larger by itself and nothing else.
    A lost task reads its input again: buckets are written before shards and deleted after them.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(record_size("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    rows = rows.withColumn("digest", F.xxhash64(*[F.col("document").getField(c) for c in docs.columns]))
    document = rows.schema["document"]
    keyed = T.StructType([document, T.StructField("key", T.LongType()), T.StructField("bucket", T.IntegerType())])
    placed = T.StructType([document, T.StructField("bucket", T.IntegerType()), T.StructField("place", T.LongType())])

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        partition = TaskContext.get().partitionId()
        for batch in batches:
            digests = np.asarray(batch.column("digest"), dtype=np.int64)
            keys = scatter_keys(digests, seen, seed, partition)
            bucket = pa.array(bucket_of(keys, buckets))
            yield pa.RecordBatch.from_arrays([batch.column("document"), pa.array(keys.view(np.int64)), bucket], keyed.names)
        trim()

    def shuffled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        numbers = np.asarray(table.column("bucket"))
        for number in np.unique(numbers):
            mine = np.flatnonzero(numbers == number)
            keys = np.asarray(table.column("key"))[mine].view(np.uint64)
            by_key = mine[np.argsort(keys, kind="stable")]
            order = by_key[fisher_yates(len(mine), seed, int(number))]
            # Rows are taken in small pieces: the bucket is never there twice.
            for start in range(0, len(order), 512):
                piece = order[start : start + 512]
                taken = table.select(["document"]).take(pa.array(piece)).combine_chunks().column(0)
                for chunk, at in _chunks(taken, start):
                    bucket = pa.array(np.full(len(chunk), number, np.int32))
                    places = pa.array(np.arange(at, at + len(chunk), dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([chunk, bucket, places], placed.names)
        del table, held
        trim()

    scattered = rows.mapInArrow(scatter, keyed).repartitionById(buckets, "bucket")
    passed = scratch_path(spark, "buckets")
    scattered.mapInArrow(shuffled, placed).write.option("compression", "zstd").parquet(passed)
    written = spark.read.schema(placed).parquet(passed)

    sizes = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("bucket", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    n = written.count()
    position = F.col("before") + F.col("place")
    shard = F.expr(f"(before + place) * {shards} div {max(n, 1)}")
    # The first position p with p * shards >= shard * n.
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    result = written.join(offsets, "bucket").select("document", position.alias("position"), shard.cast("int").alias("shard"))
    result = result.select("document", (F.col("position") - first).alias("slot"), "shard")
    result = result.sortWithinPartitions("shard", "slot")
    result.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    delete(spark, passed)
    return spark.read.schema(result.schema).parquet(path)


def _chunks(taken: pa.ChunkedArray | pa.Array, start: int) -> Iterator[tuple[pa.Array, int]]:
    for chunk in taken.chunks if isinstance(taken, pa.ChunkedArray) else [taken]:
        if len(chunk):
            yield chunk, start
            start += len(chunk)


def digests(shuffled: DataFrame) -> DataFrame:
    """Per row of ``shuffle``'s result: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    text = F.coalesce(F.col("document.text"), F.lit("")).cast("binary")
    return shuffled.select(
        "document.doc_id",
        record_size().alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
