"""Connected components of a graph in a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.session import stage

#: Rounds after which something must be wrong: each one at least halves the paths.
MOST_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_least(both), "u").where(F.col("v") > F.col("u"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = down.join(_least(down), "u")
    pairs = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(tied.select("u", F.col("m").alias("v")))
    return pairs.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) of every node of ``edges(u, v)``; no edges give no rows.

    Sums and minima are formed before the shuffle, and joins on a hot node can be split, so a star of any size is fine.
    """
    now = stage(edges.where("u != v").select("u", "v").distinct(), "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        now = stage(_small_star(_large_star(now)), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
        before = state
    raise RuntimeError("components did not settle")
