"""Katz backoff language model: Good-Turing discounted word pairs over discounted words, exactly normalised.

The corpus is dealt into blocks of documents. A block asks for the counts of its distinct words, then of its distinct
word pairs; its questions go, sorted and packed, to buckets by word or pair, which add up what all blocks bring, keep
the table, and answer in the order asked. So a word or pair travels once a block, not once an occurrence, however
frequent it is; pairs behind a frequent word are dealt out by both words.

    P(w | h) = c*(h w) / c(h)    if the pair was seen,  else  alpha(h) P(w)
    P(w)     = c*(w) / N         if the word was seen,  else  what the discounts of words left (one unknown word)

with c* = d_r r, Good-Turing's d_r for counts r up to 5. Larger counts give up BEYOND of one count, so that every
context keeps some mass; alpha(h) is that mass over the P of the words never seen behind h: all P(. | h) add up to one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import id_remainder, mixed, numbering, texts, trim
from riskgrid.session import scratch_path, stage

#: Counts up to this are discounted by Good-Turing.
CUTOFF = 5
BEYOND = 0.01
#: Bytes of text in a block, and entries (about) that a bucket gets.
BLOCK_BYTES = 8 << 20
BUCKET_ENTRIES = 1_500_000
HELD_OUT, FOLDS = 2, 7
#: The token behind the last word; no word holds a blank.
END = b" "
#: Numbers of words: unknown, the context before the first word, and then known words.
UNKNOWN, START, FIRST = 0, 1, 2


def packed(values: np.ndarray) -> bytes:
    """Non-negative integers by byte place, high places that are all zero left out: sorted ones as differences are short."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    used = max((k + 1 for k in range(8) if planes[k].any()), default=0)
    return bytes([used]) + len(values).to_bytes(8, "little") + planes[:used].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    used, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.zeros((n, 8), np.uint8)
    if n:
        planes[:, :used] = np.frombuffer(data, np.uint8, offset=9).reshape(used, n).T
    return planes.reshape(-1).view("<u8").astype(np.uint64)


def steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


@dataclass(frozen=True)
class Discounts:
    """d_r for r = 0 ... CUTOFF, from how many words or pairs were seen r times."""

    d: tuple[float, ...]

    @staticmethod
    def of(seen: list[int]) -> Discounts:
        """``seen[r]``: how many were seen r times, r = 1 ... CUTOFF + 1.

        Where Good-Turing gives no discount between 0 and 1 (small or copied corpora), half a count is taken off.
        """
        n = [*seen, *[0] * (CUTOFF + 2 - len(seen))]
        common = (CUTOFF + 1) * n[CUTOFF + 1] / n[1] if n[1] else 1.0
        out = [0.0]
        for r in range(1, CUTOFF + 1):
            d = ((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common) if n[r] and common < 1 else 0.0
            out.append(d if 0 < d < 1 else (r - 0.5) / r)
        return Discounts(tuple(out))

    def reduced(self, counts: np.ndarray) -> np.ndarray:
        """c* of counts; 0 of 0."""
        counts = counts.astype(np.float64)
        small = np.array(self.d)[np.minimum(counts, CUTOFF).astype(np.int64)] * counts
        return np.where(counts <= CUTOFF, small, counts - BEYOND)


@dataclass(frozen=True)
class Words:
    """The word level of the model: all that is global."""

    n: int  # training tokens
    v: int  # distinct ones
    documents: int  # training texts: how often START was a context
    discounts: Discounts
    unknown: float  # P of the unknown word

    @staticmethod
    def of(seen: list[int], n: int, v: int, documents: int) -> Words:
        discounts = Discounts.of(seen)
        if not n:
            return Words(0, 0, documents, discounts, 1.0)
        counted = sum(seen[1 : CUTOFF + 1])
        kept = sum(discounts.d[r] * r * seen[r] for r in range(1, CUTOFF + 1))
        large = n - sum(r * seen[r] for r in range(1, CUTOFF + 1))
        return Words(n, v, documents, discounts, 1 - (kept + large - BEYOND * (v - counted)) / n)

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts.reduced(counts) / max(self.n, 1), self.unknown)


# ---------------------------------------------------------------- blocks


class Block:
    """The tokens of a block's documents: local word numbers, with the END of each text."""

    def __init__(self, table: pa.Table):
        ids = numbering()
        ids[END]
        self.training = np.array(table.column("training").to_pylist(), bool)
        parts, sizes = [], []
        for text in table.column("text").to_pylist():
            words = text.lower().split()
            words.append(END)
            parts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
            sizes.append(len(words))
        self.tokens = np.concatenate(parts)
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.of_training = np.repeat(self.training, self.sizes)
        trim()
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids))
        # Words in order of their hashes: the order of questions and answers.
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.tokens = place[self.tokens]

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.of_training], minlength=len(self.hashes)).astype(np.uint64)

    def contexts(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the word before each token (START at the first), and its own."""
        own = numbers[self.tokens]
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[self.starts] = START
        return before, own


def by_hash(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash: by its highest bits, so sorted hashes stay in order."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def pair_keys(before: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where both words are known, and the keys of these pairs."""
    known = (before != UNKNOWN) & (own != UNKNOWN)
    return known, before[known] << np.uint64(32) | own[known]


def by_pair(keys: np.ndarray, frequent: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each pair: by its context, or by both words where the context is ``frequent``."""
    return mixed(np.where(frequent, keys, keys >> np.uint64(32))) % np.uint64(buckets)


def questions(block: int, bucket: np.ndarray, keys: np.ndarray, counts: np.ndarray, notes: np.ndarray) -> pa.Table:
    """One row a bucket: the block's sorted keys there, their training counts, and a note on each."""
    rows: dict[str, list] = {"bucket": [], "block": [], "keys": [], "counts": [], "notes": []}
    order = np.argsort(bucket, kind="stable")
    cuts = np.r_[0, np.flatnonzero(np.diff(bucket[order])) + 1, len(order)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if a < b:
            part = order[a:b]
            values = int(bucket[part[0]]), block, packed(steps(keys[part])), packed(counts[part]), packed(notes[part])
            for name, value in zip(rows, values):
                rows[name].append(value)
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(rows.values(), types)], names=list(rows))


QUESTION = "bucket long, block long, keys binary, counts binary, notes binary"
#: kind 0: answers to a block (counts, numbers); kind 1: the table of the bucket (keys, counts) with its statistics;
#: kind 2 (pairs only): contexts of the bucket with their mass.
ANSWER = (
    "kind int, bucket long, block long, keys binary, counts binary, numbers binary, seen array<long>, total long,"
    " distinct long, context array<long>, left array<double>, covered array<double>"
)
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
_ANSWER_SCHEMA = pa.schema([(x.split()[0], _ARROW[x.split()[1]]) for x in ANSWER.split(", ")])


def answer_table(rows: list[dict]) -> pa.Table:
    """Rows of the answers' schema; what a row doesn't name is null."""
    return pa.Table.from_pylist(rows, schema=_ANSWER_SCHEMA)


def table_row(bucket: int, keys: np.ndarray, counts: np.ndarray, numbers: np.ndarray | None = None) -> dict:
    row = {"kind": 1, "bucket": bucket, "keys": packed(steps(keys)), "counts": packed(counts), "seen": seen_times(counts)}
    return row | {"total": int(counts.sum()), "distinct": len(keys), "numbers": None if numbers is None else packed(numbers)}


def merged(table: pa.Table) -> tuple[list[int], list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All questions of one bucket: blocks, lengths, the distinct keys, where each asked key is among them, sums, notes."""
    order = np.argsort(table.column("block").to_numpy(), kind="stable")
    pick = lambda name: [table.column(name)[int(k)].as_py() for k in order]
    keys = [np.cumsum(unpacked(x), dtype=np.uint64) for x in pick("keys")]
    sizes = [len(k) for k in keys]
    distinct, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    counts = np.concatenate([unpacked(x) for x in pick("counts")])
    notes = np.concatenate([unpacked(x) for x in pick("notes")])[first]
    sums = np.bincount(at, weights=counts.astype(np.float64), minlength=len(distinct)).astype(np.uint64)
    return pick("block"), sizes, distinct, at, sums, notes


def seen_times(counts: np.ndarray) -> list[int]:
    return np.bincount(counts[counts <= CUTOFF + 1].astype(np.int64), minlength=CUTOFF + 2).tolist()


def answered_words(table: pa.Table, buckets: int) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    blocks, sizes, keys, at, counts, _ = merged(table)
    known = counts > 0
    numbers = np.zeros(len(keys), np.uint64)
    numbers[known] = np.arange(known.sum(), dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket + FIRST)
    if len(numbers) and int(numbers.max()) >= 1 << 32:
        raise ValueError("more than 2^32 words")
    rows = [table_row(bucket, keys[known], counts[known], numbers[known])]
    ends = np.cumsum([0, *sizes])
    for block, a, b in zip(blocks, ends[:-1].tolist(), ends[1:].tolist()):
        rows.append({"kind": 0, "bucket": bucket, "block": block, "counts": packed(counts[at[a:b]]), "numbers": packed(numbers[at[a:b]])})
    return answer_table(rows)


def answered_pairs(table: pa.Table, words: Words) -> pa.Table:
    """Answers, the bucket's pairs, and for each context here: how often pairs of each count, and the P of their words."""
    bucket = table.column("bucket")[0].as_py()
    blocks, sizes, keys, at, counts, notes = merged(table)
    known = counts > 0
    rows = [table_row(bucket, keys[known], counts[known])]
    ends = np.cumsum([0, *sizes])
    for block, a, b in zip(blocks, ends[:-1].tolist(), ends[1:].tolist()):
        rows.append({"kind": 0, "bucket": bucket, "block": block, "counts": packed(counts[at[a:b]])})
    context = (keys[known] >> np.uint64(32)).astype(np.int64)
    if len(context):
        # Keys are sorted, so a context's pairs are neighbours.
        starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        covered = np.add.reduceat(words.p(notes[known]), starts)
        spread = [np.add.reduceat((counts[known] == r).astype(np.float64), starts) for r in range(1, CUTOFF + 1)]
        beyond = np.add.reduceat((counts[known] > CUTOFF).astype(np.float64), starts)
        left = np.stack([*spread, beyond], axis=1).ravel()
        rows.append({"kind": 2, "bucket": bucket, "context": context[starts], "left": left, "covered": covered})
    return answer_table(rows)


# ---------------------------------------------------------------- the model on Spark


@dataclass
class Model:
    """The trained model and the blocks it was trained beside. Tables are on disk: ``words`` and ``pairs`` by bucket."""

    blocks: DataFrame
    words: Words
    word_answers: DataFrame
    pair_discounts: Discounts
    pair_answers: DataFrame
    weights: DataFrame  # context, log_freed
    limit: int  # contexts that occur more often are dealt out by both words
    buckets: int


def dealt(docs: DataFrame, training) -> DataFrame:
    """The documents as a table bucketed by block: later passes read whole blocks without moving the texts again."""
    spark = docs.sparkSession
    rows = texts(docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("training")), "training")
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = int(max(1, -(-size // BLOCK_BYTES)))
    # Rows without a number, or with one number, are dealt out by their text too.
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
    name = f"riskgrid_lm_{uuid.uuid4().hex}"
    (
        rows.withColumn("block", block)
        .repartition(n, "block")
        .write.format("parquet")
        .option("path", scratch_path(spark, "blocks"))
        .option("compression", "zstd")
        .bucketBy(n, "block")
        .saveAsTable(name)
    )
    return spark.table(name)


def totals(answers: DataFrame) -> tuple[list[int], int, int]:
    """How many were seen r times, all counts, and how many were seen at all: one row reaches the driver."""
    table = answers.where("kind = 1")
    sums = [F.coalesce(F.sum(F.col("seen")[r]), F.lit(0)) for r in range(CUTOFF + 2)]
    row = table.agg(*sums, F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    return [int(x) for x in row[: CUTOFF + 2]], int(row[CUTOFF + 2]), int(row[CUTOFF + 3])


def train(docs: DataFrame, training) -> Model:
    """Counts over all rows where ``training`` holds; every row is dealt into blocks, to be scored later."""
    blocks = dealt(docs, training)
    size = blocks.agg(F.sum(F.octet_length("text")), F.sum(F.col("training").cast("long"))).first()
    buckets = int(max(1, -(-(size[0] or 0) // (8 * BUCKET_ENTRIES))))
    word_buckets, pair_buckets = max(1, buckets // 4), buckets

    def ask_words(table: pa.Table) -> pa.Table:
        block = Block(table)
        counts = block.word_counts()
        return questions(table.column("block")[0].as_py(), by_hash(block.hashes, word_buckets), block.hashes, counts, np.zeros_like(counts))

    asked = blocks.groupBy("block").applyInArrow(ask_words, QUESTION)
    word_answers = store(asked.groupBy("bucket").applyInArrow(lambda t: answered_words(t, word_buckets), ANSWER), "words")
    seen, n, v = totals(word_answers)
    words = Words.of(seen, n, v, int(size[1] or 0))
    limit = max(1, n // (4 * pair_buckets))

    def ask_pairs(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return questions(0, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        block = Block(table)
        counts, numbers = word_values(answers)
        before, own = block.contexts(numbers)
        known, keys = pair_keys(before, own)
        distinct, first, at = np.unique(keys, return_index=True, return_inverse=True)
        sums = np.bincount(at[block.of_training[known]], minlength=len(distinct)).astype(np.uint64)
        notes = counts[block.tokens[known]][first]
        often = context_counts(block, counts, words.documents)[known][first]
        bucket = by_pair(distinct, often > limit, pair_buckets)
        return questions(table.column("block")[0].as_py(), bucket, distinct, sums, notes)

    word_replies = word_answers.where("kind = 0").select("block", "bucket", "counts", "numbers")
    asked = blocks.groupBy("block").cogroup(word_replies.groupBy("block")).applyInArrow(ask_pairs, QUESTION)
    pair_answers = store(asked.groupBy("bucket").applyInArrow(lambda t: answered_pairs(t, words), ANSWER), "pairs")
    pair_discounts = Discounts.of(totals(pair_answers)[0])
    weights = stage(backoff_weights(pair_answers, pair_discounts, words), "weights")
    return Model(blocks, words, word_answers, pair_discounts, pair_answers, weights, limit, pair_buckets)


def store(answers: DataFrame, name: str) -> DataFrame:
    """The tables and answers on disk, partitioned by kind."""
    spark = answers.sparkSession
    path = scratch_path(spark, name)
    answers.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return spark.read.schema(answers.schema).parquet(path)


def word_values(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Counts and numbers of a block's words: hashes are sorted, and buckets are ranges of hashes."""
    order = np.argsort(answers.column("bucket").to_numpy(), kind="stable").tolist()
    counts = [unpacked(answers.column("counts")[k].as_py()) for k in order]
    numbers = [unpacked(answers.column("numbers")[k].as_py()) for k in order]
    return np.concatenate(counts), np.concatenate(numbers)


def context_counts(block: Block, counts: np.ndarray, documents: int) -> np.ndarray:
    """How often the context of each token was one in training: a word is followed each time it occurs."""
    own = counts[block.tokens]
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[block.starts] = documents
    return before


def backoff_weights(pair_answers: DataFrame, discounts: Discounts, words: Words) -> DataFrame:
    """``context, log_freed``: log10 of alpha(h) c(h), the counts that the discounts free over the P of words not seen
    behind the context. A frequent context has parts in several buckets, which are summed here."""
    width = CUTOFF + 1
    zipped = F.arrays_zip("context", "covered", F.sequence(F.lit(0), F.size("context") - 1).alias("at"))
    rows = pair_answers.where("kind = 2 and size(context) > 0").select("left", F.explode(zipped).alias("z"))
    parts = rows.select(
        F.col("z.context").alias("context"),
        F.col("z.covered").alias("covered"),
        *[F.col("left")[F.col("z.at") * width + k].alias(f"n{k + 1}") for k in range(width)],
    )
    summed = parts.groupBy("context").agg(F.sum("covered").alias("covered"), *[F.sum(f"n{k + 1}").alias(f"n{k + 1}") for k in range(width)])
    freed = sum((F.col(f"n{r}") * (r * (1 - discounts.d[r])) for r in range(1, width)), F.lit(0.0)) + F.col(f"n{width}") * BEYOND
    return summed.select("context", F.log10(freed / (1 - F.col("covered"))).alias("log_freed"))


def score(model: Model) -> DataFrame:
    """One row per document: its log10 probability, and that of the add-one base.

    A null or empty text is its end token alone. Each row is scored, also repeated ones and those without a number
    (they were not held out if their training flag was null: then they are not trained on). An empty training part
    leaves one unknown word of P 1: scores are 0. Words are compared after lower-casing A-Z; an empty table gives no
    rows; other columns are ignored.
    """
    words, pair_discounts = model.words, model.pair_discounts
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "contexts", "times"]
    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, contexts array<long>, times array<long>"
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    n, v = words.n, words.v
    limit, buckets = model.limit, model.buckets

    def evaluate(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        block = Block(table)
        is_word = np.asarray(answers.column("level").to_numpy()) == 1
        counts, numbers = word_values(answers.filter(pa.array(is_word)))
        before, own = block.contexts(numbers)
        known, keys = pair_keys(before, own)
        distinct, first, at = np.unique(keys, return_index=True, return_inverse=True)
        often = context_counts(block, counts, words.documents)
        bucket = by_pair(distinct, often[known][first] > limit, buckets)
        pair_rows = answers.filter(pa.array(~is_word))
        replies = {b: unpacked(c) for b, c in zip(pair_rows.column("bucket").to_pylist(), pair_rows.column("counts").to_pylist())}
        pair_counts = np.zeros(len(distinct), np.uint64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.r_[0, np.flatnonzero(np.diff(bucket[order])) + 1, len(order)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a < b:
                pair_counts[order[a:b]] = replies[int(bucket[order[a]])]
        seen = np.zeros(len(own), np.uint64)
        seen[known] = pair_counts[at]
        c = counts[block.tokens]
        hit = seen > 0
        # Unseen pairs: alpha(h) = freed(h) / c(h) / (1 - covered(h)) comes later, but for its 1 / c(h).
        context_known = before != UNKNOWN
        log_context = np.log10(np.maximum(often, 1).astype(np.float64))
        log_p = np.log10(words.p(c))
        with np.errstate(divide="ignore"):
            direct = np.log10(np.maximum(pair_discounts.reduced(seen), 1e-300)) - log_context
        back = context_known & ~hit & (often > 0)
        value = np.where(hit, direct, log_p - np.where(back, log_context, 0))
        base = np.log10((c.astype(np.float64) + 1) / (n + v + 1))
        scores, bases = np.add.reduceat(value, block.starts), np.add.reduceat(base, block.starts)
        n_known = np.add.reduceat((c > 0).astype(np.int64), block.starts)
        owner = np.repeat(np.arange(len(block.sizes)), block.sizes)[back]
        contexts: list[list[int]] = [[] for _ in block.sizes]
        times: list[list[int]] = [[] for _ in block.sizes]
        if len(owner):
            pairs, many = np.unique(owner.astype(np.uint64) << np.uint64(32) | before[back], return_counts=True)
            for p, k in zip(pairs.tolist(), many.tolist()):
                contexts[p >> 32].append(p & 0xFFFFFFFF)
                times[p >> 32].append(k)
        rows = (table.column("block")[0].as_py() << 32) + np.arange(len(block.sizes), dtype=np.int64)
        values = [rows, table.column("doc_id").combine_chunks(), ~block.training, block.sizes, n_known, bases, scores, contexts, times]
        return pa.Table.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(values, types)], names=names)

    replies = model.word_answers.where("kind = 0").select("block", "bucket", "counts", "numbers", F.lit(1).alias("level"))
    replies = replies.unionAll(model.pair_answers.where("kind = 0").select("block", "bucket", "counts", "numbers", F.lit(2).alias("level")))
    evaluated = model.blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(evaluate, schema)
    evaluated = stage(evaluated, "evaluated")
    waiting = evaluated.where(F.size("contexts") > 0).select("row", F.explode(F.arrays_zip("contexts", "times")).alias("z"))
    waiting = waiting.select("row", F.col("z.contexts").alias("context"), F.col("z.times").alias("times"))
    more = waiting.join(model.weights, "context").groupBy("row").agg(F.sum(F.col("times") * F.col("log_freed")).alias("more"))
    return evaluated.join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
