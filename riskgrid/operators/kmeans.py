"""K-means on weighted positions, all restarts in the same passes.

A pass reads the positions once, whatever the number of restarts: tasks sum weight, coordinates and cost per
(restart, cluster), and the driver gets those sums, never positions beyond the sampled candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskgrid.session import stage

# Fixed value: squared movement of a centre below which it stands still.
TOLERANCE = 1e-4
# Rounds that draw candidates, and how many times the clusters are drawn in each.
ROUNDS = 5
OVERSAMPLING = 2
# Distances that a task holds at once, and that it works out in a pass at most (without what blocks rule out).
CELLS = 1 << 21
TASK_CELLS = 1 << 24
# Neighbouring positions that are compared with the same centres.
BLOCK = 2_048


@dataclass(frozen=True)
class Clusters:
    """Centres of the best restart, the cost of each restart, and how often the positions were read."""

    centres: np.ndarray
    costs: list[float]
    passes: int

    @property
    def cost(self) -> float:
        return min(self.costs)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre (the first of equals) and squared distance to it."""
    of, cost = np.empty(len(points), np.int64), np.empty(len(points))
    step = max(1, min(BLOCK, CELLS // max(1, len(centres))))
    for i in range(0, len(points), step):
        part = points[i : i + step]
        reach = _within_reach(part, centres)
        near = centres[reach]
        apart = (part[:, :1] - near[:, 0]) ** 2 + (part[:, 1:] - near[:, 1]) ** 2
        of[i : i + step] = reach[apart.argmin(axis=1)]
        cost[i : i + step] = apart.min(axis=1)
    return of, cost


def _within_reach(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Numbers of the centres that may be nearest to some point.

    A centre further from the points' box than another one is from its farthest corner is nearest to none. Rounding
    keeps the order of distances, so no centre is missed.
    """
    low, high = points.min(axis=0), points.max(axis=0)
    least = np.maximum(np.maximum(low - centres, centres - high), 0.0) ** 2
    most = np.maximum(np.abs(low - centres), np.abs(centres - high)) ** 2
    return np.flatnonzero(~(least[:, 0] + least[:, 1] > (most[:, 0] + most[:, 1]).min()))


def _in_blocks(points: np.ndarray) -> np.ndarray:
    """An order of the points in which those of a block lie together: halved by the wider side until a block is left."""
    order, stack = [], [np.arange(len(points))]
    while stack:
        mine = stack.pop()
        if len(mine) <= BLOCK:
            order.append(mine)
            continue
        at = points[mine]
        side = int(np.argmax(at.max(axis=0) - at.min(axis=0)))
        # Halves of whole blocks, so that blocks are cut where the pass cuts them.
        half = -(-len(mine) // (2 * BLOCK)) * BLOCK
        mine = mine[np.argpartition(at[:, side], half - 1)] if half < len(mine) else mine
        stack += [mine[half:], mine[:half]]
    return np.concatenate(order) if order else np.arange(0)


def _dealt(points: DataFrame, centres: int) -> DataFrame:
    """Staged positions in as many tasks as their distances to so many centres ask for, neighbours in a block."""
    tasks = max(1, -(-points.count() * centres // TASK_CELLS))
    table = points.select(*[F.col(c).cast("double").alias(c) for c in _POINT])
    if tasks > 1:
        table = table.repartitionByRange(tasks, "longitude", "latitude")
    table = table.sortWithinPartitions("longitude", "latitude")

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(_in_blocks(_points(batch)[0])))

    return stage(table.mapInArrow(arrange, ", ".join(f"{c} double" for c in _POINT)), "points")


def _points(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x, y, w = (np.asarray(batch.column(c), np.float64) for c in _POINT)
    return np.stack([x, y], axis=1), w


def _uniform(points: np.ndarray, seed: int, round_: int) -> np.ndarray:
    """A repeatable number in (0, 1) for each position."""
    x = points[:, 0].copy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ points[:, 1].copy().view(np.uint64)
    x ^= np.uint64((seed * 0xD1B54A32D192ED03 + round_ * 0x8CB92BA72F3D8DD7) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def _drawn(points: DataFrame, centres: list[np.ndarray], seeds: list[int], round_: int, most: int) -> list[np.ndarray]:
    """For each restart up to ``most`` new positions, drawn by weight times squared distance to its centres so far.

    Each position runs for a time drawn by that product, and the first ``most`` win: one pass draws for all restarts.
    """

    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros((0, 3)) for _ in seeds]
        for batch in batches:
            at, w = _points(batch)
            for r, (seed, own) in enumerate(zip(seeds, centres)):
                pull = w * nearest(at, own)[1] if len(own) else w
                on = np.flatnonzero(pull > 0)
                times = -np.log(_uniform(at[on], seed, round_)) / pull[on]
                rows = np.concatenate([kept[r], np.column_stack([times, at[on]])])
                kept[r] = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))[:most]]
        for r, rows in enumerate(kept):
            arrays = [pa.array(np.full(len(rows), r, np.int32)), *(pa.array(rows[:, i]) for i in range(3))]
            yield pa.RecordBatch.from_arrays(arrays, names=["restart", "time", "latitude", "longitude"])

    table = points.mapInArrow(race, "restart int, time double, latitude double, longitude double")
    order = W.partitionBy("restart").orderBy("time", "latitude", "longitude")
    rows = table.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).collect()
    rows.sort(key=lambda r: (r.restart, r.place))
    return [np.array([(r.latitude, r.longitude) for r in rows if r.restart == k]).reshape(-1, 2) for k in range(len(seeds))]


def _sums(points: DataFrame, centres: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Weight and coordinate sums per cluster, and the cost, of each restart: one pass."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(c), 4)) for c in centres]
        for batch in batches:
            at, w = _points(batch)
            for own, total in zip(centres, sums):
                of, cost = nearest(at, own)
                for i, values in enumerate((w, w * at[:, 0], w * at[:, 1], w * cost)):
                    total[:, i] += np.bincount(of, values, len(own))
        for r, total in enumerate(sums):
            arrays = [np.full(len(total), r, np.int32), np.arange(len(total), dtype=np.int32), *total.T]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=_SUM_NAMES)

    added = points.mapInArrow(add, "restart int, cluster int, w double, x double, y double, cost double")
    rows = added.groupBy("restart", "cluster").agg(*[F.sum(c).alias(c) for c in _SUM_NAMES[2:]]).collect()
    out = [np.zeros((len(c), 4)) for c in centres]
    for r in rows:
        out[r.restart][r.cluster] = (r.w, r.x, r.y, r.cost)
    return [(t[:, 0], t[:, 1:3], float(t[:, 3].sum())) for t in out]


_POINT = ["latitude", "longitude", "events"]
_SUM_NAMES = ["restart", "cluster", "w", "x", "y", "cost"]


def _seeded(candidates: np.ndarray, weights: np.ndarray, clusters: int, seed: int) -> np.ndarray:
    """Starting centres out of weighted candidates: each drawn by weight times squared distance to those before."""
    rng = np.random.default_rng(seed)
    centres = candidates[[rng.choice(len(candidates), p=weights / weights.sum())]]
    while len(centres) < clusters:
        pull = weights * nearest(candidates, centres)[1]
        if not pull.sum() > 0:
            break
        centres = np.concatenate([centres, candidates[[rng.choice(len(candidates), p=pull / pull.sum())]]])
    return centres


def fit(points: DataFrame, clusters: int, seed: int, restarts: int, max_iter: int = 300) -> Clusters:
    """Best of ``restarts`` runs on ``latitude, longitude, events``; they are staged by place and read once per pass.

    Candidates are drawn in rounds and weighed by the events nearest to them; starting centres are drawn from these.
    A restart whose centres stand still takes no part in further passes. Fewer different positions than clusters give
    fewer clusters. Without positions there are no centres.
    """
    seeds = [seed + i for i in range(restarts)]
    points = _dealt(points, clusters * restarts)
    candidates = _drawn(points, [np.zeros((0, 2))] * restarts, seeds, 0, 1)
    passes = 1
    if not len(candidates[0]):
        return Clusters(np.zeros((0, 2)), [0.0], passes)
    for round_ in range(1, ROUNDS + 1):
        new = _drawn(points, candidates, seeds, round_, OVERSAMPLING * clusters)
        candidates = [np.concatenate(pair) for pair in zip(candidates, new)]
        passes += 1
    weighed = _sums(points, candidates)
    passes += 1
    centres = [_seeded(c, np.maximum(w, 1e-300), clusters, s) for c, (w, _, _), s in zip(candidates, weighed, seeds)]
    costs = [float("inf")] * restarts
    moving = list(range(restarts))
    for step in range(max_iter + 1):
        found = _sums(points, [centres[r] for r in moving])
        passes += 1
        still = []
        for r, (w, sums, cost) in zip(moving, found):
            # The cost is that of the centres before they move.
            costs[r] = cost
            if step == max_iter:
                continue
            new = np.where(w[:, None] > 0, sums / np.maximum(w, 1e-300)[:, None], centres[r])
            if ((new - centres[r]) ** 2).sum(axis=1).max() > TOLERANCE**2:
                still.append(r)
                centres[r] = new
        moving = still
        if not moving:
            break
    return Clusters(centres[int(np.argmin(costs))], costs, passes)


def assign(df: DataFrame, centres: np.ndarray, out: str = "cluster_id") -> DataFrame:
    """``df`` with the number of the nearest centre of each ``latitude, longitude``."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, `{out}` int"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.stack([np.asarray(batch.column(c), np.float64) for c in ("latitude", "longitude")], axis=1)
            of = pa.array(nearest(at, centres)[0].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, of], names=[*batch.schema.names, out])

    return df.mapInArrow(number, schema)
