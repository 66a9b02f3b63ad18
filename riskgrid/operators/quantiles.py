"""Exact medians and modes of groups that may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Slices of the first round: so many for each doubling of a value, numbered from the smallest double's.
_PER_DOUBLING = 1 << 10
_DOUBLINGS = 1080
_BEYOND = 1 << 22
# Slices of equal width of the second round. What is left in one then has at most 2^(53 - 10 - 21) different values.
_SLICES = 1 << 21


def _magnitude(value: Column) -> Column:
    """A number that never falls as the value grows: about ``_PER_DOUBLING`` of them for each doubling."""
    step = F.floor((F.log2(F.abs(value)) + _DOUBLINGS) * _PER_DOUBLING) + 1
    return (
        F.when(F.isnan(value), 2 * _BEYOND)
        .when(value == float("inf"), _BEYOND)
        .when(value == float("-inf"), -_BEYOND)
        .when(value > 0, step)
        .when(value < 0, -step)
        .otherwise(0)
    )


def _holding(counts: DataFrame, within: Sequence[str], ranks: Sequence[str], order: str) -> DataFrame:
    """The slices that hold one of the ranks, and the ranks counted from the slice's first row on (null: not in it)."""
    upto = F.sum("_count").over(W.partitionBy(*within).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    placed = counts.withColumn("_before", upto - F.col("_count"))
    inside = {r: F.when(F.col(r).between(F.col("_before"), F.col("_before") + F.col("_count") - 1), F.col(r) - F.col("_before")) for r in ranks}
    return placed.withColumns(inside).where(" or ".join(f"{r} is not null" for r in ranks)).drop("_before", "_count")


def rows_of(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose keys are in ``groups``, null keys included.

    The digest is a key of the join but not of what follows: a hot group can be split in the join, and its rows are
    counted before they are sent on.
    """
    digest = F.xxhash64(*keys)
    wanted = groups.select(digest.alias("_digest"), *[F.col(c).alias(f"_{c}") for c in keys])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return df.withColumn("_of", digest).join(wanted, reduce(and_, same, F.col("_of") == F.col("_digest")), "left_semi").drop("_of")


def exact_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Interpolated median of every column per key, nulls skipped; one row if ``keys`` is empty.

    With keys, the first slice of a group is all of it: one aggregate, combined in the map tasks, finds how many values
    each column has, the smallest and the largest. Groups that have at most two values in each column, or one repeated,
    are settled by it with one row and one exchange, and so however many groups there are. The rows of the others are
    looked into (``_by_slices``), as all rows are without keys.
    """
    if not keys:
        return _by_slices(df, keys, columns)
    # Columns go by number, so that no name meets one of the frame's.
    numbers = [F.col(f"`{c}`").cast("double") for c in columns]
    ends = [f(v).alias(f"_{n}_{i}") for i, v in enumerate(numbers) for n, f in (("n", F.count), ("low", F.min), ("high", F.max))]
    first = df.groupBy(*keys).agg(*ends)
    measures = range(len(columns))
    is_open = F.expr(" or ".join(f"(_n_{i} > 2 and _low_{i} < _high_{i})" for i in measures))
    is_known = F.expr(" or ".join(f"_n_{i} > 0" for i in measures))
    middles = [((F.col(f"_low_{i}") + F.col(f"_high_{i}")) / 2).alias(c) for i, c in enumerate(columns)]
    settled = first.where(~is_open & is_known).select(*keys, *middles)
    rest = rows_of(df.select(*keys, *[v.alias(c) for v, c in zip(numbers, columns)]), first.where(is_open), keys)
    return settled.unionByName(_by_slices(rest, keys, columns))


def _by_slices(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``exact_medians`` by counts per slice.

    For few but large groups. ``percentile`` would bring all distinct values of a group to one task. Here values are
    counted per slice, and only the slices that hold the two middle ranks are looked into: first slices by magnitude,
    then slices of equal width of the values found there, then single values; a slice of one value is not looked into. The slices depend on the
    values' order alone, so whatever the distribution, a task orders at most 2^22 slices or values of a group;
    rows are only counted, in the map tasks already. The result is exact.
    Without keys at most two slices per column are broadcast; with keys the joins are left to Spark, which sees
    how many groups there are.
    """
    group = [*keys, "_measure"]
    few = (lambda df: df) if keys else F.broadcast
    pairs = ", ".join(f"{i}, cast(`{c}` as double)" for i, c in enumerate(columns))
    values = df.select(*keys, F.expr(f"stack({len(columns)}, {pairs}) as (_measure, _value)"))
    values = values.where(F.col("_value").isNotNull())
    found = [F.count(F.lit(1)).alias("_count"), F.min("_value").alias("_low"), F.max("_value").alias("_high")]
    ranks = ["_first", "_second"]

    slices = values.groupBy(*group, _magnitude(F.col("_value")).alias("_slice")).agg(*found)
    rows = F.sum("_count").over(W.partitionBy(*group))
    # Ranks, from 0, of the two middle values.
    slices = slices.withColumns({"_first": F.floor((rows - 1) / 2), "_second": F.floor(rows / 2)})
    held = _holding(slices, group, ranks, "_slice").drop("_slice")

    limits = [*group, "_from", "_to"]
    settled = [held.where("_low = _high")]
    for last in (False, True):
        # Slices of a single value need no further look; if there are no others, adaptive execution drops the rest.
        open_ = held.where("_low < _high").withColumnsRenamed({"_low": "_from", "_high": "_to"})
        near = values.join(few(open_), group).where("_value between _from and _to")
        width = F.try_divide(F.col("_value") - F.col("_from"), F.col("_to") - F.col("_from"))
        # All of one value, or of values without a distance, are one slice.
        slice = F.col("_value") if last else F.floor(F.coalesce(F.nanvl(width, F.lit(0.0)), F.lit(0.0)) * _SLICES)
        slices = near.groupBy(*limits, *ranks, slice.alias("_slice")).agg(*found)
        held = _holding(slices, limits, ranks, "_slice").drop("_slice", "_from", "_to")
        settled.append(held.where("_low = _high"))

    held = reduce(DataFrame.unionByName, settled)
    middle = lambda rank: F.max(F.when(F.col(rank).isNotNull(), F.col("_low")))
    medians = held.groupBy(*group).agg(((middle("_first") + middle("_second")) / 2).alias("_median"))
    spread = [F.max(F.when(F.col("_measure") == i, F.col("_median"))).alias(c) for i, c in enumerate(columns)]
    return medians.groupBy(*keys).agg(*spread)


def exact_modes(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value per key, the smallest on ties, null if all are null: count, then compare."""
    counts = df.groupBy(*keys, column).agg(F.count(column).alias("_count"))
    seen = F.when(F.col("_count") > 0, F.struct((-F.col("_count")).alias("_rank"), F.col(column).alias("_value")))
    return counts.groupBy(*keys).agg(F.min(seen)["_value"].alias(column))
