"""Near-duplicate classes: 5-word shingle sets joined at Jaccard 0.8 with signature trees.

1. Each text becomes a set of 64-bit shingle hashes, a bitmap of about two bits a shingle, and a prefix: two sets that
   link share a shingle of their prefixes, whatever the common order. Shingles that are frequent on a sample come last.
2. Sets that share a prefix shingle form a group. In a group, a signature tree (OR-combined bitmaps, size ranges) is
   walked against itself; node pairs whose largest possible overlap is too small are left. What remains is tied
   together; sets tied to one another form a neighbourhood.
3. In a neighbourhood the walk is repeated with the sets themselves at the leaves: only links that the exact sets
   confirm are kept.

Equal sets are one node from the start. Groups and neighbourhoods beyond a size are dealt out as pairs of parts, so no
task holds more than two parts. A walk skips node pairs that are already one class, and hands on a tree of links for
each class, not its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import mixed, slices, stable_sample, texts, trim
from riskgrid.llm.components import components
from riskgrid.session import stage

WORDS = 5
#: Documents on which frequent shingles are sought. They come last in the order of prefixes, which changes no result.
ORDER_SAMPLE = 4000
#: Sets of a group or neighbourhood that one part holds at most (on average).
PART = 1024
#: Sets below one leaf of a tree, and children of an inner node.
LEAF, FAN = 32, 8
#: Numbers of sets that may be broadcast (16 bytes each); beyond, the join is left to Spark.
BROADCAST_SETS = 1_000_000
#: Bytes of bitmaps or sets that one Python call gets.
BUCKET_BYTES = 16 << 20
CACHE_WORDS = 250_000
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(WORDS)]


def share_needed(a, b):
    """Smallest intersection of linked sets of sizes a and b: 100 i >= 80 (a + b - i)."""
    return -(-4 * (a + b) // 9)


class Shingles:
    """Sorted distinct shingle hashes of texts; word hashes are remembered."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        value = self.known[word] = xxhash.xxh64_intdigest(word)
        return value

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        get = self.known.get
        hashes = np.array([get(w) or self._hash(w) for w in words], np.uint64)
        if not len(hashes):
            return hashes
        n = max(1, len(hashes) - WORDS + 1)
        out = np.full(n, np.uint64(len(hashes) if n == 1 else WORDS))
        for k in range(min(WORDS, len(hashes))):
            out += mixed(hashes[k : k + n]) * _POWERS[k]
        return np.unique(mixed(out))


def width_of(n: int) -> int:
    """Bits of a bitmap for ``n`` shingles: a power of two, from 2n on, 64 at least."""
    return max(64, 1 << int(2 * n - 1).bit_length())


def bitmap(shingles: np.ndarray) -> bytes:
    width = width_of(len(shingles))
    bits = np.zeros(width, bool)
    bits[(shingles >> np.uint64(8)) & np.uint64(width - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def number_of(raw: bytes, salt: int) -> int:
    """A signed 64-bit number for a set, from its sorted shingles."""
    return xxhash.xxh3_64_intdigest(raw, seed=salt) - (1 << 63)


def prefix(shingles: np.ndarray, late: np.ndarray) -> np.ndarray:
    """The first |s| - ceil(0.8 |s|) + 1 shingles in the order: not in ``late`` before in ``late``, then by hash."""
    n = len(shingles)
    size = n - -(-4 * n // 5) + 1 if n else 0
    if len(late) and n:
        at = np.minimum(np.searchsorted(late, shingles), len(late) - 1)
        is_late = late[at] == shingles
        shingles = np.concatenate([shingles[~is_late], shingles[is_late]])
    return shingles[:size]


def late_shingles(docs: DataFrame, rows: int = ORDER_SAMPLE) -> np.ndarray:
    """Shingles in two or more of at most ``rows`` sampled documents: read by the driver, bounded by the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Shingles()
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(made(text).view(np.int64))], names=["g"])

    counted = texts(stable_sample(docs.select("doc_id", "text"), rows, "order")).mapInArrow(run, "g long").groupBy("g").count()
    found = counted.where("count > 1").select("g").toArrow().column("g").to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def signatures(docs: DataFrame, late: np.ndarray, salt: int = 0) -> DataFrame:
    """One row per document: its set's number and second digest, size, bitmap and prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(late)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, late = Shingles(), shared.value
        for batch in slices(batches):
            sets = [made(x) for x in batch.column("text").to_pylist()]
            raw = [s.tobytes() for s in sets]
            heads = [prefix(s, late).view(np.int64) for s in sets]
            offsets = np.cumsum([0] + [len(h) for h in heads]).astype(np.int32)
            flat = np.concatenate(heads) if heads else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([number_of(x, salt) for x in raw], pa.int64()),
                    pa.array([number_of(x, ~salt & 0xFFFF) for x in raw], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["doc_id", "node", "second", "n", "bits", "head"],
            )

    schema = "doc_id long, node long, second long, n long, bits binary, head array<long>"
    return texts(docs).mapInArrow(run, schema)


def distinct_sets(docs: DataFrame, late: np.ndarray) -> tuple[DataFrame, int]:
    """:func:`signatures`, stored, and their salt; drawn anew if two different sets got one number."""
    for salt in range(8):
        found = stage(signatures(docs, late, salt), "signatures")
        clash = found.groupBy("node").agg(F.min("second").alias("low"), F.max("second").alias("high")).where("low != high")
        if clash.isEmpty():
            return found, salt
    raise RuntimeError("set numbers collide")


# ---------------------------------------------------------------- the walk


class Classes:
    """Union-find over the members of one group."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


class Tree:
    """A signature tree over members in a given order: OR-combined bitmaps, size ranges, largest slack.

    ``slack``: shingles of a set beyond its bits. Sets x, y share at most popcount(X & Y) + min(slack) shingles if
    their bits lie in X and Y.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.levels = []
        slack = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        level = (bits, sizes, sizes, slack)
        step = LEAF
        while len(level[0]) > 1 or not self.levels:
            starts = np.arange(0, len(level[0]), step)
            level = (
                np.bitwise_or.reduceat(level[0], starts),
                np.minimum.reduceat(level[1], starts),
                np.maximum.reduceat(level[2], starts),
                np.maximum.reduceat(level[3], starts),
            )
            self.levels.append(level)
            step = FAN
        self.members = (bits, sizes, sizes, slack)


def may_link(left, i: np.ndarray, right, j: np.ndarray) -> np.ndarray:
    """Which pairs of entries (i of left, j of right) can hold linked sets, by size ranges and largest possible overlap."""
    low_i, high_i, low_j, high_j = left[1][i], left[2][i], right[1][j], right[2][j]
    fits = (5 * high_i >= 4 * low_j) & (5 * high_j >= 4 * low_i)
    out = np.zeros(len(i), bool)
    k = np.flatnonzero(fits)
    for part in np.array_split(k, max(1, len(k) * left[0].shape[1] // (1 << 19))):
        a, b = i[part], j[part]
        shared = np.bitwise_count(left[0][a] & right[0][b]).sum(axis=1, dtype=np.int64) + np.minimum(left[3][a], right[3][b])
        shared = np.minimum(shared, np.minimum(left[2][a], right[2][b]))
        # The smallest sizes the two sides can have need the smallest overlap.
        out[part] = shared >= share_needed(left[1][a], right[1][b])
    return out


def walk(bits: np.ndarray, sizes: np.ndarray, classes: Classes, numbers: np.ndarray, confirm: Callable[[int, int], bool] | None) -> None:
    """Joins the classes of all pairs of members that may link and that ``confirm`` (if given) confirms.

    ``numbers`` are the members' numbers in ``classes``. Members should come so that likely links are near each other.
    """

    def settle(i: np.ndarray, j: np.ndarray) -> None:
        for a, b in zip(numbers[i].tolist(), numbers[j].tolist()):
            if classes.find(a) != classes.find(b) and (confirm is None or confirm(a, b)):
                classes.join(a, b)

    n = len(sizes)
    tree = Tree(bits, sizes)
    near = np.arange(n - 1)
    near = near[may_link(tree.members, near, tree.members, near + 1)]
    settle(near, near + 1)
    spans = [LEAF * FAN**k for k in range(len(tree.levels))]
    stack = [(len(tree.levels) - 1, 0, 0)]

    def one_class(level: int, i: int, j: int) -> bool:
        roots = {classes.find(numbers[x]) for k in (i, j) for x in range(k * spans[level], min(n, (k + 1) * spans[level]))}
        return len(roots) < 2

    while stack:
        level, x, y = stack.pop()
        if one_class(level, x, y):
            continue
        below, size = (tree.members, LEAF) if level == 0 else (tree.levels[level - 1], FAN)
        i = np.arange(x * size, min(len(below[0]), (x + 1) * size))
        j = np.arange(y * size, min(len(below[0]), (y + 1) * size))
        i, j = np.repeat(i, len(j)), np.tile(j, len(i))
        keep = i < j if level == 0 else i <= j
        i, j = i[keep], j[keep]
        good = may_link(below, i, below, j)
        i, j = i[good], j[good]
        if level == 0:
            settle(i, j)
        else:
            stack.extend((level - 1, a, b) for a, b in zip(i.tolist(), j.tolist()))


def folded(raw: list[bytes], width: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, wider ones folded to ``width`` bits."""
    out = np.zeros((len(raw), width // 64), np.uint64)
    for k, data in enumerate(raw):
        out[k] = np.bitwise_or.reduce(np.frombuffer(data, np.uint64).reshape(-1, width // 64), axis=0)
    return out


def linked(raw: list[bytes], sizes: np.ndarray, order: np.ndarray, confirm: Callable[[int, int], bool] | None = None) -> Classes:
    """Classes of the members of one group. Linked sets differ in size by a quarter at most, so their bitmaps have one
    width or neighbouring ones: each width is walked together with the next one folded to it."""
    classes = Classes(len(raw))
    widths = np.array([8 * len(x) for x in raw])
    for width in np.unique(widths):
        some = order[(widths[order] == width) | (widths[order] == 2 * width)]
        if len(some) > 1:
            walk(folded([raw[k] for k in some], int(width)), sizes[some], classes, some, confirm)
    return classes


def star_edges(classes: Classes, nodes: np.ndarray) -> list[tuple[int, int]]:
    return [(int(nodes[k]), int(nodes[r])) for k in range(len(nodes)) if (r := classes.find(k)) != k]


# ---------------------------------------------------------------- groups and neighbourhoods on Spark


def parted(members: DataFrame, key: str, part: int) -> DataFrame:
    """``unit, node``: each group of ``members(key, node)`` as one unit, or beyond ``part`` sets as pairs of parts.

    Any two sets of a group meet in a unit. Equal groups become one unit.
    """
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    large = sizes.where(F.col("size") > part).withColumn("parts", F.ceil(F.col("size") / part).cast("int"))
    small = members.join(large.select(key), key, "left_anti").groupBy(key).agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    units = small.where(F.size("nodes") > 1).select("nodes").distinct().select(F.xxhash64("nodes").alias("unit"), F.explode("nodes").alias("node"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    pairs = (
        members.join(large, key)
        .select(key, "node", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .where("own != other")
        .select(F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other"), F.lit("pair")).alias("unit"), "node")
    )
    return units.unionAll(pairs).distinct()


def walked(rows: DataFrame, payload: str, run: Callable[[pa.Table], list[tuple[int, int]]]) -> DataFrame:
    """Edges ``u, v`` from the units of ``rows(unit, node, payload, ...)``; a Python call gets about BUCKET_BYTES of them."""
    rows = stage(rows, "units")
    total = rows.agg(F.sum(F.octet_length(payload) + 64)).first()[0] or 0
    buckets = int(max(1, -(-total // BUCKET_BYTES)))
    spread = max(buckets, rows.sparkSession.sparkContext.defaultParallelism)

    def call(table: pa.Table) -> pa.Table:
        table = table.sort_by([("unit", "ascending"), ("node", "ascending")])
        unit = table.column("unit").to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(unit)) + 1, len(unit)]
        edges = [e for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if b - a > 1 for e in run(table.slice(a, b - a))]
        u, v = (list(x) for x in zip(*edges)) if edges else ([], [])
        trim()
        return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("unit", F.lit(1)), F.lit(spread)))
    return bucketed.groupBy("bucket").applyInArrow(lambda t: call(t.drop_columns(["bucket"])), "u long, v long")


def candidate_unit(table: pa.Table) -> list[tuple[int, int]]:
    nodes, sizes = table.column("node").to_numpy(), table.column("n").to_numpy()
    return star_edges(linked(table.column("bits").to_pylist(), sizes, np.argsort(sizes, kind="stable")), nodes)


def exact_unit(table: pa.Table) -> list[tuple[int, int]]:
    nodes = table.column("node").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])

    def confirm(a: int, b: int) -> bool:
        i = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        return i >= share_needed(len(sets[a]), len(sets[b]))

    # Sets with equal smallest shingles are often alike: they become neighbours.
    order = np.lexsort((sizes, [int(s[0]) for s in sets]))
    return star_edges(linked([bitmap(s) for s in sets], sizes, order, confirm), nodes)


def links(found: DataFrame, salt: int, docs: DataFrame, part: int = PART, broadcast_sets: int = BROADCAST_SETS) -> DataFrame:
    """A forest ``u, v`` of confirmed links between the sets (nodes) of ``found``."""
    heads = found.select("node", F.explode("head").alias("g"))
    met = heads.groupBy("g").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("g")
    members = stage(heads.join(met, "g").select("g", "node").distinct(), "members")
    units = parted(members, "g", part)
    marks = found.select("node", "n", "bits").dropDuplicates(["node"])
    candidates = components(walked(units.join(marks, "node"), "bits", candidate_unit))
    candidates = stage(candidates, "neighbourhoods")

    # One document stands for each set whose shingles are needed again.
    needed = candidates.select("node").join(found.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "node").select("node", "doc_id")
    needed = stage(needed, "needed")
    side = F.broadcast(needed) if needed.count() <= broadcast_sets else needed
    wanted = texts(docs).join(side, "doc_id")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Shingles()
        for batch in slices(batches):
            sets = [made(x).tobytes() for x in batch.column("text").to_pylist()]
            # Another text with the same document number has another set.
            right = [number_of(x, salt) == n for x, n in zip(sets, batch.column("node").to_pylist())]
            made_of = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])
            yield made_of.filter(pa.array(right, pa.bool_()))

    shingles = wanted.select("node", "text").mapInArrow(sets_of, "node long, shingles binary")
    units = parted(candidates.select(F.col("component").alias("g"), "node"), "g", part)
    return walked(units.join(shingles, "node"), "shingles", exact_unit)


def classes(docs: DataFrame, sample: int = ORDER_SAMPLE, part: int = PART, broadcast_sets: int = BROADCAST_SETS) -> DataFrame:
    """One row per document: the size of its shingle set, and the smallest document number of its class.

    A null or empty text, or one without words, has no shingles and is a class of its own. Texts of fewer than five
    words have one shingle. Repeated rows and equal texts share a class; of ties the smallest number wins. Rows without
    a number take part in no link and have a null class. An empty table gives no rows; other columns are ignored.
    """
    plain = docs.select("doc_id", "text")
    found, salt = distinct_sets(plain, late_shingles(plain, sample))
    numbered = found.where("n > 0 and doc_id is not null")
    label = components(links(numbered, salt, plain, part, broadcast_sets))
    named = numbered.groupBy("node").agg(F.min("doc_id").alias("first"))
    named = named.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "component").select("node", "component_id")
    rows = found.select("doc_id", F.col("n").alias("n_shingles"), "node")
    known = rows.where("n_shingles > 0 and doc_id is not null").join(named, "node")
    alone = rows.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return known.select(*columns).unionAll(alone.select(*columns))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose number is the smallest of their class; also rows without a number.

    Of several rows with one number all stay, unless they are in different classes of which one has a smaller number.
    """
    found = classes(docs)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")
