"""k-means for many numbers of clusters at once: every scan of the points serves all of them.

Nothing here depends on how the points are dealt to tasks: random draws are hashes of the points, and
sums are of whole numbers, so they are the same in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from math import frexp
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.session import settle

BLOCK_POINTS = 8192
TASK_POINTS = 1_000_000
ROUNDS = 3
DRAWN_PER_CLUSTER = 4
TRIES = 8
MAX_ITER = 20
TOLERANCE = 1e-4
_HALF_BITS = 30
_HALF = float(1 << _HALF_BITS)


class Clustering(NamedTuple):
    """Centres of a fit; a point belongs to the nearest, the first of equally near ones."""

    centres: np.ndarray
    vector: str

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Add the number of each point's cluster, by built-in expressions."""
        values = vector_to_array(self.vector)

        def distance(centre: np.ndarray) -> Column:
            gaps = [(F.get(values, F.lit(i)) - F.lit(float(c))) for i, c in enumerate(centre)]
            return reduce(add, [gap * gap for gap in gaps])

        away = F.array(*[distance(c) for c in self.centres])
        return df.withColumn(output, (F.array_position(away, F.array_min(away)) - 1).cast("int"))


class Points(NamedTuple):
    """Points packed in blocks on shared files, how many, their width, and a power of two that no
    coordinate exceeds. ``first`` is the point of the smallest hash."""

    blocks: DataFrame
    size: int
    width: int
    scale: float
    first: np.ndarray


def pack(df: DataFrame, vector: str, seed: int) -> Points:
    """Points of a vector column, with a hash of each, in blocks that are cheap to read again.

    Blocks that came in fewer tasks than there are cores, or in tasks of more than ``TASK_POINTS``, are
    dealt out once. No result depends on where they lie.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_POINTS):
                part = batch.slice(start, BLOCK_POINTS)
                values = part.column("x").flatten().to_numpy(zero_copy_only=False)
                rows = values.reshape(part.num_rows, -1)
                hashes = part.column("h").to_numpy()
                least = int(hashes.argmin())
                yield pa.RecordBatch.from_pydict({
                    "x": [rows.tobytes()], "h": [hashes.tobytes()], "n": [part.num_rows],
                    "farthest": [float(np.abs(rows).max(initial=0.0))],
                    "least": [int(hashes[least])], "first": [rows[least].tolist()]})

    x = vector_to_array(vector)
    rows = df.select(x.alias("x"), F.xxhash64(x, F.lit(seed)).alias("h"))
    blocks = settle(rows.mapInArrow(
        packed, "x binary, h binary, n bigint, farthest double, least bigint, first array<double>"),
        "points")
    found = blocks.agg(F.sum("n"), F.max("farthest"), F.min(F.struct("least", "first"))).first()
    if not found[0]:
        raise ValueError("there are no points to cluster")
    first = np.array(found[2]["first"])
    blocks = blocks.select("x", "h")
    held = blocks.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.sum("count")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-found[0] // TASK_POINTS), min(held[1], cores))
    if held[0] < tasks:
        blocks = settle(blocks.repartition(tasks), "dealt-points")
    return Points(blocks, found[0], len(first), 2.0 ** frexp(found[1])[1], first)


def _read(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for x, h in zip(batch.column("x"), batch.column("h"), strict=True):
            yield (np.frombuffer(x.as_py()).reshape(-1, width),
                   np.frombuffer(h.as_py(), np.uint64))


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each centre, the same however points are put together."""
    columns = np.ascontiguousarray(x.T)
    return np.stack([_square(columns, centre) for centre in centres], axis=1)


def _square(columns: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distance of points, given by coordinate, to one centre."""
    total = np.zeros(columns.shape[1])
    gap = np.empty_like(total)
    for column, at in zip(columns, centre, strict=True):
        np.subtract(column, at, out=gap)
        np.multiply(gap, gap, out=gap)
        total += gap
    return total


def nearest(columns: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre, the first of equally near ones, and the squared distance to it.

    Points are given by coordinate, so that each step runs along all of them.
    """
    label, least = np.zeros(columns.shape[1], np.int64), _square(columns, centres[0])
    for i, centre in enumerate(centres[1:], 1):
        away = _square(columns, centre)
        np.copyto(label, i, where=away < least)
        np.minimum(least, away, out=least)
    return label, least


def halves(values: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Two whole numbers that stand for a value of at most ``scale``, to 60 bits of it."""
    high = np.floor(values * (_HALF / scale))
    return high, np.floor((values * (_HALF / scale) - high) * _HALF)


def _whole(high: int, low: int, scale: float) -> float:
    return scale * (((int(high) << _HALF_BITS) + int(low)) / (1 << (2 * _HALF_BITS)))


class Sums:
    """Whole sums per group and column of a task."""

    def __init__(self, groups: int, columns: int):
        self.high = np.zeros((groups, max(columns, 1)), np.int64)
        self.low = np.zeros_like(self.high)
        self.n = np.zeros(groups, np.int64)

    def add(self, group: np.ndarray, values: np.ndarray, scales: Sequence[float]) -> None:
        self.add_halves(0, len(self.n), group, [halves(values[:, i], s) for i, s in enumerate(scales)])

    def add_halves(self, start: int, stop: int, label: np.ndarray,
                   parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> None:
        """Add the halves of each column to the groups from ``start`` on, by label."""
        size = stop - start
        self.n[start:stop] += np.bincount(label, minlength=size)
        for i, (high, low) in enumerate(parts):
            self.high[start:stop, i] += np.bincount(label, high, size).astype(np.int64)
            self.low[start:stop, i] += np.bincount(label, low, size).astype(np.int64)


def add_nearest(sums: Sums, x: np.ndarray, fits: Sequence[np.ndarray], scales: Sequence[float],
                far: float | None = None) -> None:
    """Add points to their clusters in each of several clusterings, one's groups behind the other's.

    Points are cut into halves once for all clusterings. With ``far`` their squared distance, at most
    that, is the last column.
    """
    columns = np.ascontiguousarray(x.T)
    parts = [halves(column, scale) for column, scale in zip(columns, scales, strict=False)]
    start = 0
    for centres in fits:
        label, away = nearest(columns, centres)
        sums.add_halves(start, start + len(centres), label, parts if far is None else [*parts, halves(away, far)])
        start += len(centres)


def _summed(points: Points, groups: int, scales: Sequence[float],
            add: Callable[[Sums, np.ndarray], None]) -> tuple[np.ndarray, np.ndarray]:
    """Number of rows and exact sums per group over all points, from one scan."""
    width = points.width

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = Sums(groups, len(scales))
        for x, _ in _read(batches, width):
            add(task, x)
        group, column = (a.ravel() for a in np.indices(task.high.shape))
        yield pa.RecordBatch.from_pydict({
            "group": group, "column": column, "n": task.n[group], "high": task.high.ravel(),
            "low": task.low.ravel()})

    rows = points.blocks.mapInArrow(
        sums, "group bigint, column bigint, n bigint, high bigint, low bigint").groupBy(
        "group", "column").agg(F.sum("n").alias("n"), *[
            F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]).collect()
    counts, totals = np.zeros(groups, np.int64), np.zeros((groups, len(scales)))
    for row in rows:
        counts[row["group"]] = row["n"]
        if scales:
            totals[row["group"], row["column"]] = _whole(row["high"], row["low"],
                                                         scales[row["column"]])
    return counts, totals


def _uniform(hashes: np.ndarray, turn: int) -> np.ndarray:
    """A draw in (0, 1) for each hash and turn."""
    z = hashes + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(12)).astype(float) + 0.5) / float(1 << 52)


def candidates(points: Points, most: int, rounds: int = ROUNDS) -> np.ndarray:
    """Points to begin from: in each round ``most`` of those far from the ones found before.

    A point's key is an exponential draw over its squared distance; the smallest keys are a sample
    in proportion to the squared distances. Equal points have one key and are one candidate.
    """
    found, width = points.first[None], points.width
    for turn in range(rounds):
        def drawn(batches: Iterator[pa.RecordBatch], known=found, turn=turn):
            keys, rows = np.zeros(0), np.zeros((0, width))
            for x, h in _read(batches, width):
                away = nearest(np.ascontiguousarray(x.T), known)[1]
                far = away > 0
                key = np.concatenate([keys, -np.log(_uniform(h[far], turn)) / away[far]])
                rows = np.concatenate([rows, x[far]])
                keys, at = np.unique(key, return_index=True)
                keys, rows = keys[:most], rows[at[:most]]
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.float64()), "x": pa.array(
                rows.tolist(), pa.list_(pa.float64()))})

        new = (points.blocks.mapInArrow(drawn, "key double, x array<double>").distinct()
               .orderBy("key", "x").limit(most).collect())
        if not new:
            break
        found = np.concatenate([found, np.array([row["x"] for row in new])])
    return found


def _start(rows: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres to begin with, from a few weighted candidates: the best of several careful seedings."""
    best, least = rows[:1], np.inf
    for turn in range(TRIES):
        rng = np.random.default_rng([seed, k, turn])
        chosen = [int(rng.choice(len(rows), p=weights / weights.sum()))]
        while len(chosen) < min(k, len(rows)):
            away = squares(rows, rows[chosen]).min(axis=1) * weights
            if not away.sum() > 0:
                break
            chosen.append(int(rng.choice(len(rows), p=away / away.sum())))
        centres = rows[chosen]
        for _ in range(MAX_ITER):
            label = squares(rows, centres).argmin(axis=1)
            mass = np.bincount(label, weights, len(centres))
            moved = np.stack([np.bincount(label, weights * rows[:, i], len(centres))
                              for i in range(rows.shape[1])], axis=1)
            centres = np.where(mass[:, None] > 0, moved / np.where(mass > 0, mass, 1)[:, None],
                               centres)
        cost = float((squares(rows, centres).min(axis=1) * weights).sum())
        if cost < least:
            best, least = centres, cost
    return best


def fit_all(points: Points, ks: Sequence[int], seed: int = 1, max_iter: int = MAX_ITER,
            tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """Centres for each k. One scan a step moves the centres of all k that have not settled.

    There are fewer centres than k where there are fewer different points.
    """
    rows = candidates(points, DRAWN_PER_CLUSTER * max(ks))
    weights, _ = _summed(points, len(rows), [], lambda sums, x: add_nearest(sums, x, [rows], []))
    centres = [_start(rows, weights.astype(float), k, seed) for k in ks]
    moving = list(range(len(centres)))
    scales = [points.scale] * points.width
    for _ in range(max_iter):
        now = [centres[i] for i in moving]
        starts = np.cumsum([0, *map(len, now)])

        def assign(sums: Sums, x: np.ndarray, now=now) -> None:
            add_nearest(sums, x, now, scales)

        counts, totals = _summed(points, int(starts[-1]), scales, assign)
        still = []
        for i, start in zip(moving, starts, strict=False):
            n, total = counts[start:start + len(centres[i])], totals[start:start + len(centres[i])]
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[i])
            if ((moved - centres[i]) ** 2).sum(axis=1).max() > tolerance ** 2:
                still.append(i)
            centres[i] = moved
        moving = still
        if not moving:
            break
    return centres


def scores(points: Points, fits: Sequence[np.ndarray]) -> list[tuple[float, float]]:
    """Mean silhouette by squared distance, and cost, of each clustering, from two scans for all.

    The mean squared distance of a point to a cluster is that to its mean plus the cluster's own
    spread. A point alone in its cluster scores 0, and so do all where there is one cluster.
    """
    starts = np.cumsum([0, *map(len, fits)])
    far = 4.0 * points.width * points.scale ** 2
    scales = [points.scale] * points.width + [far]

    def gather(sums: Sums, x: np.ndarray) -> None:
        add_nearest(sums, x, fits, scales[:-1], far)

    counts, totals = _summed(points, int(starts[-1]), scales, gather)
    shapes = []
    for start, centres in zip(starts, fits, strict=False):
        n, total = counts[start:start + len(centres)], totals[start:start + len(centres)]
        some = n > 0
        means = np.where(some[:, None], total[:, :-1] / np.maximum(n, 1)[:, None], centres)
        around = np.maximum(total[:, -1] - n * ((means - centres) ** 2).sum(axis=1), 0.0)
        shapes.append((centres, n, means, around, float(total[:, -1].sum())))

    def score(sums: Sums, x: np.ndarray) -> None:
        columns = np.ascontiguousarray(x.T)
        for i, (centres, n, means, around, _) in enumerate(shapes):
            label, _ = nearest(columns, centres)
            own, other = np.zeros(len(x)), np.full(len(x), np.inf)
            for j in np.flatnonzero(n):
                away = _square(columns, means[j]) + around[j] / n[j]
                mine = label == j
                np.copyto(own, away * n[j] / max(n[j] - 1, 1), where=mine)
                np.copyto(away, np.inf, where=mine)
                np.minimum(other, away, out=other)
            larger = np.maximum(own, other)
            known = (n[label] > 1) & np.isfinite(other) & (larger > 0)
            value = np.zeros(len(x))
            value[known] = (other[known] - own[known]) / larger[known]
            sums.add_halves(i, i + 1, np.zeros(len(x), np.int64), [halves(value, 1.0)])

    _, sums = _summed(points, len(fits), [1.0], score)
    return [(float(sums[i, 0]) / points.size, shape[-1]) for i, shape in enumerate(shapes)]


def fit_kmeans(df: DataFrame, k: int, seed: int = 1, vector: str = "pcaFeatures") -> Clustering:
    """k-means on a vector column."""
    return Clustering(fit_all(pack(df, vector, seed), [k], seed)[0], vector)


def kmeans_sweep(df: DataFrame, ks: Sequence[int] = range(2, 11), seed: int = 1,
                 vector: str = "pcaFeatures") -> tuple[DataFrame, Clustering]:
    """``k, silhouette, cost, is_best`` for each k, and the clustering of the best (the first among
    equals).

    The points are written once in blocks. Scans grow with the steps of the slowest k, not with the
    number of them: one a round of seeding, one for the weights, one a step, two for the scores.
    """
    ks = list(ks)
    points = pack(df, vector, seed)
    fits = fit_all(points, ks, seed)
    found = scores(points, fits)
    best = max(range(len(ks)), key=lambda i: found[i][0])
    rows = [(k, *found[i], i == best) for i, k in enumerate(ks)]
    return df.sparkSession.createDataFrame(
        rows, "k int, silhouette double, cost double, is_best boolean"), Clustering(fits[best], vector)
