"""Exact ranks without sending a whole group to one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Half the width of a bracket around the expected place of a cut, in standard deviations of its number of rows.
_DEVIATIONS = 8.0
# 4 hex digits of an md5: 65,536 buckets of equal expected size per group, for cuts outside their bracket.
_BUCKET_DIGITS = 4
# Groups whose limits are broadcast.
MOST_GROUPS = 10_000


def text_hash(columns: Sequence[str]) -> Column:
    """md5 over the columns' text: a repeatable random order that any engine reproduces."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def cut_by_hash(
    df: DataFrame, group: str, key: Sequence[str], cuts: Sequence[Column], out: str = "segment"
) -> DataFrame:
    """Number of ``cuts`` a row lies behind when its group is put in hash order.

    ``cuts`` are row counts within the group, ascending, written over columns ``_group`` (the group's
    value), ``group_rows`` (rows in the row's group) and ``smallest_group`` (rows in the smallest group). Row number ``r`` (from 1)
    gets ``count(cut < r)``, exactly as a ``row_number`` over the whole group would decide; ``key`` must
    tell rows apart, rows with equal keys are not parted.

    Groups are counted first. Digests are spread evenly, so a cut is expected in a narrow bracket of them: one pass over
    group and key counts the rows between brackets and keeps those inside, a few times the square root of the
    group. The cut is exact wherever it lies: one outside its bracket is looked for by ``_beyond`` (without such cuts,
    adaptive execution drops that). Whole rows are then read once and compared with the last row before each cut, without a
    shuffle, and with one digest per row. The table of these rows is
    broadcast; it has a row per group, groups are class labels, and more than
    ``MOST_GROUPS`` are an error. Rows of a null group are kept apart by a null-safe match.
    """
    # The digest is generated as a row of its own, so that it is worked out once per row and not again in each condition.
    once = F.explode(F.array(text_hash(key))).alias("_digest")
    place = F.struct(F.col("_digest").alias("hash"), *key)
    counts = df.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("group_rows"))
    totals = counts.agg(F.struct(F.min("group_rows").alias("smallest"), F.count(F.lit(1)).alias("groups"))).scalar()
    counts = counts.withColumn("smallest_group", totals["smallest"])
    counts = counts.where(F.when(totals["groups"] <= MOST_GROUPS, True).otherwise(F.raise_error(F.lit("too many groups"))))
    limits = counts.select(
        "_group", "group_rows", F.array(*[F.floor(cut).cast("bigint") for cut in cuts]).alias("_cuts")
    )
    ends = [end for i in range(len(cuts)) for end in _bracket(F.col("_cuts")[i], F.col("group_rows"))]
    packed = limits.select(F.col("_group").alias("_of"), F.array(*ends).alias("_ends"))

    digests = df.select(F.col(group).alias("_group"), *key, once)
    digests = digests.join(F.broadcast(packed), F.col("_group").eqNullSafe(F.col("_of")))
    digest, bound = F.col("_digest"), [F.col("_ends")[i] for i in range(len(ends))]
    inside = reduce(or_, [(digest >= low) & (digest < high) for low, high in zip(bound[::2], bound[1::2])])
    # Stretches between ends are numbered in the order of the digests; a stretch is kept whole or counted.
    stretch = sum(((digest >= end).cast("int") for end in bound), F.lit(0))
    located = digests.select("_of", stretch.alias("_stretch"), inside.alias("_inside"), place.alias("_place"))
    kept = located.groupBy("_of", "_stretch", F.when(F.col("_inside"), F.col("_place")).alias("_kept"))
    upto = W.partitionBy("_of").orderBy("_stretch", "_kept").rowsBetween(W.unboundedPreceding, -1)
    sizes = kept.agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(upto), F.lit(0)))
    wanted = limits.select("_group", F.posexplode("_cuts").alias("_number", "_cut"))
    crossed = sizes.join(F.broadcast(wanted), F.col("_of").eqNullSafe(F.col("_group")))
    crossed = crossed.where("_before < _cut and _cut <= _before + _size")

    found = crossed.where("_kept is not null").select("_of", "_number", F.col("_kept").alias("_place"))
    missed = crossed.where("_kept is null").select(
        F.col("_of").alias("_in"), F.col("_stretch").alias("_at"), "_number", "_cut", "_before"
    )
    near = located.join(F.broadcast(missed), F.col("_of").eqNullSafe(F.col("_in")) & (F.col("_stretch") == F.col("_at")))
    found = found.unionByName(_beyond(near.select("_of", "_number", "_cut", "_before", "_place")))
    last = found.groupBy("_of").agg(
        *[F.max(F.when(F.col("_number") == i, F.col("_place"))).alias(f"_last{i}") for i in range(len(cuts))]
    )
    table = limits.join(last, F.col("_group").eqNullSafe(F.col("_of")), "left")

    # The limits travel as one column, so that none of their names meets one of the rows'.
    packed = table.select("_group", F.struct("group_rows", "_cuts", *[f"_last{i}" for i in range(len(cuts))]).alias("_limits"))
    placed = df.join(F.broadcast(packed), F.col(group).eqNullSafe(F.col("_group")))

    def passed(i: int) -> Column:
        cut, at = F.col("_limits._cuts")[i], F.col(f"_limits._last{i}")
        return F.when(cut <= 0, 1).when(cut >= F.col("_limits.group_rows"), 0).when(place > at, 1).otherwise(0)

    placed = placed.select(*df.columns, "_limits", once)
    return placed.select(*df.columns, sum((passed(i) for i in range(len(cuts))), F.lit(0)).alias(out))


def _bracket(cut: Column, rows: Column) -> tuple[Column, Column]:
    """First digest inside and first digest above the bracket of a cut, as prefixes of 8 hex digits."""
    spread = F.lit(_DEVIATIONS) * (F.sqrt(F.greatest(cut * (rows - cut) / rows, F.lit(0.0))) + 1)

    def prefix(position: Column) -> Column:
        number = F.floor(F.greatest(position / rows, F.lit(0.0)) * 2**32)
        return F.when(number >= 2**32, "g").otherwise(F.lpad(F.lower(F.hex(number)), 8, "0"))

    return prefix(cut - spread), prefix(cut + spread)


def _beyond(near: DataFrame) -> DataFrame:
    """``_of, _number, _place`` of the cuts that lie in the rows of ``near``, of which ``_before`` come earlier.

    Hash buckets are counted, and only those that a cut passes through are ranked, about 1/65,536 of the rows each.
    """
    bucket = F.substring("_place.hash", 1, _BUCKET_DIGITS)
    sizes = near.groupBy("_of", "_number", "_cut", "_before", bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.partitionBy("_of", "_number").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    crossed = sizes.where("_before < _cut and _cut <= _before + _size").select(
        F.col("_of").alias("_in"), F.col("_number").alias("_which"), "_bucket", F.col("_before").alias("_ahead")
    )
    same = F.col("_of").eqNullSafe(F.col("_in")) & (F.col("_number") == F.col("_which")) & (bucket == F.col("_bucket"))
    rows = near.join(F.broadcast(crossed), same)
    order = W.partitionBy("_of", "_number").orderBy("_place")
    rows = rows.withColumn("_row", F.col("_ahead") + F.row_number().over(order)).where("_row = _cut")
    return rows.select("_of", "_number", "_place")


def number_by_first_seen(df: DataFrame, seen: str, seen_hour: str, ties: Sequence[str], out: str) -> DataFrame:
    """Consecutive numbers from 0 in order of first appearance.

    Two levels: hours are counted and summed up first (one row per hour of history), then rows are
    numbered within their hour, so no task orders the whole table.
    """
    per_hour = df.groupBy(seen_hour).agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.orderBy(seen_hour).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_hour.select(seen_hour, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    within = W.partitionBy(seen_hour).orderBy(seen, *ties)
    numbered = df.join(offsets, seen_hour).withColumn(out, F.col("_before") + F.row_number().over(within) - 1)
    return numbered.drop("_before")
