"""Points in boxes by a space-filling order: one key a point, runs of keys a box, one range join.

The Z-order key of a cell interleaves the bits of its three coordinates, so the cells of a box lie
in few runs of keys. Keys are cut into slices by counts; a point goes to one slice, whatever the
widths of the boxes, and a run to the slices it reaches into.

Totals need no pairs: slices that lie in a box whole are added up, and in the others a task counts for
all boxes at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.session import settle

BITS = 20
PREFIX_BITS = 18
RUNS_PER_BOX = 16
SLICE_ROWS = 250_000
SLICE_RUNS = 200_000
PAIRS_AT_ONCE = 1 << 20
_STEPS = (16, 8, 4, 2, 1)


def _mask(group: int) -> int:
    """Groups of ``group`` ones, each followed by twice as many zeros, in 63 bits."""
    ones = (1 << group) - 1
    return sum(ones << at for at in range(0, 63, 3 * group)) & ((1 << 63) - 1)


def _apart(value: Column) -> Column:
    """A number of up to 21 bits with two zeros put behind each bit."""
    return reduce(lambda x, g: x.bitwiseOR(F.shiftleft(x, 2 * g)).bitwiseAND(F.lit(_mask(g))),
                  _STEPS, value.cast("bigint"))


def _apart_all(values: np.ndarray) -> np.ndarray:
    for group in _STEPS:
        values = (values | values << np.int64(2 * group)) & np.int64(_mask(group))
    return values


def key_of(cells: Sequence[Column]) -> Column:
    """The Z-order key of a cell."""
    high, middle, low = map(_apart, cells)
    return F.shiftleft(high, 2).bitwiseOR(F.shiftleft(middle, 1)).bitwiseOR(low)


def keys_of(cells: np.ndarray) -> np.ndarray:
    """The same for an array of cells, the coordinates along its last axis."""
    apart = _apart_all(cells)
    return apart[..., 0] << 2 | apart[..., 1] << 1 | apart[..., 2]


def key_runs(low: np.ndarray, high: np.ndarray, most: int = RUNS_PER_BOX
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Box number, first and last key of runs that cover all cells of boxes, ``most`` a box at most.

    A box begins as the run from its lowest to its highest key. As long as there are runs left, the
    run with most keys outside its part of the box is split at the highest bit in which its ends
    differ, which halves that part along one coordinate. Runs of a box do not meet.
    """
    n = len(low)
    lows, highs = (np.zeros((n, most, 3), np.int64) for _ in range(2))
    lows[:, 0], highs[:, 0] = low, high
    first, last = np.zeros((n, most), np.int64), np.full((n, most), -1, np.int64)
    waste = np.full((n, most), -1.0)

    def measure(box: np.ndarray, slot: np.ndarray) -> None:
        first[box, slot], last[box, slot] = keys_of(lows[box, slot]), keys_of(highs[box, slot])
        size = (highs[box, slot] - lows[box, slot] + 1).astype(float).prod(axis=-1)
        waste[box, slot] = (last[box, slot] - first[box, slot] + 1) - size

    measure(np.arange(n), np.zeros(n, np.int64))
    for slot in range(1, most):
        worst = waste.argmax(axis=1)
        box = np.flatnonzero(waste[np.arange(n), worst] > 0)
        if not box.size:
            break
        old, new = worst[box], np.full(len(box), slot)
        differ, bit = first[box, old] ^ last[box, old], np.zeros(len(box), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            above = differ >> (bit + step) != 0
            bit += step * above
        axis, place = 2 - bit % 3, bit // 3
        at = highs[box, old, axis] >> place << place
        lows[box, new], highs[box, new] = lows[box, old], highs[box, old]
        highs[box, old, axis], lows[box, new, axis] = at - 1, at
        measure(box, old)
        measure(box, new)
    number, slot = np.nonzero(last >= first)
    return number, first[number, slot], last[number, slot]


class Slices(NamedTuple):
    """Rows before each occupied key prefix, and how many it has; a slice is ``rows`` of them.

    There are ``2 ** PREFIX_BITS`` prefixes at most, whatever the number of rows.
    """

    prefix: np.ndarray
    before: np.ndarray
    count: np.ndarray
    rows: int

    def reached(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last slice of the prefixes between two keys; last < first where there is none."""
        shift = 3 * BITS - PREFIX_BITS
        start = np.searchsorted(self.prefix, first >> shift)
        end = np.searchsorted(self.prefix, last >> shift, side="right") - 1
        some = start <= end
        start, end = np.where(some, start, 0), np.where(some, end, 0)
        low = self.before[start] // self.rows
        high = (self.before[end] + self.count[end] - 1) // self.rows
        return np.where(some, low, 0), np.where(some, high, -1)


def cut_slices(keyed: DataFrame, rows: int) -> Slices:
    """Slices of about ``rows`` rows of ``z``; only counts of prefixes reach the driver."""
    counted = keyed.groupBy(F.shiftright("z", 3 * BITS - PREFIX_BITS).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("prefix").toPandas()
    n = counted["n"].to_numpy(np.int64)
    return Slices(counted["prefix"].to_numpy(np.int64), np.cumsum(n) - n, n, rows)


def _slice_of(keyed: DataFrame, slices: Slices) -> DataFrame:
    """Each point in one of its prefix's slices; a crowded prefix is dealt out by hash."""
    cells = keyed.sparkSession.createDataFrame(
        [(int(p), int(b // slices.rows), int((b + n - 1) // slices.rows)) for p, b, n in
         zip(slices.prefix, slices.before, slices.count)], "_prefix bigint, _from bigint, _to bigint")
    dealt = F.col("_from") + F.pmod(F.xxhash64(*keyed.columns), F.col("_to") - F.col("_from") + 1)
    # One row a prefix: bounded by 2 ** PREFIX_BITS.
    return (keyed.withColumn("_prefix", F.shiftright("z", 3 * BITS - PREFIX_BITS))
            .join(F.broadcast(cells), "_prefix").withColumn("slice", dealt)
            .drop("_prefix", "_from", "_to"))


def box_runs(boxes: DataFrame, bounds: Sequence[str], slices: Slices,
             runs_per_box: int = RUNS_PER_BOX) -> DataFrame:
    """``slice, z, z_end`` and the columns of ``boxes``, which has the cells ``_low`` and ``_high``."""
    sent = boxes.sparkSession.sparkContext.broadcast(slices)
    columns = [c for c in boxes.columns if c not in ("_low", "_high")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (np.stack(batch.column(c).to_numpy(zero_copy_only=False)).reshape(-1, 3)
                         if batch.num_rows else np.zeros((0, 3), np.int64)
                         for c in ("_low", "_high"))
            number, first, last = key_runs(low, high, runs_per_box)
            start, end = sent.value.reached(first, last)
            copies = np.maximum(end - start + 1, 0)
            run = np.repeat(np.arange(len(number)), copies)
            offset = np.arange(len(run)) - np.repeat(np.cumsum(copies) - copies, copies)
            kept = batch.select(columns).take(pa.array(number[run]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(start[run] + offset), pa.array(first[run]), pa.array(last[run]),
                 *kept.columns], names=["slice", "z", "z_end", *columns])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in boxes.schema
                      if f.name in columns)
    return boxes.mapInArrow(cut, f"slice bigint, z bigint, z_end bigint, {kinds}")


def _box_edges(boxes: DataFrame, bounds: Sequence[str], slices: Slices, extents: pd.DataFrame,
               keys: Sequence[str], runs_per_box: int) -> DataFrame:
    """``slice, held`` and the columns of ``boxes``: a row for each slice that a box cuts, and one
    without a slice that holds the number of points in the slices which lie in the box whole."""
    size = int(extents["slice"].max()) + 1
    n = np.zeros(size, np.int64)
    n[extents["slice"]] = extents["n"]
    sides = np.full((size, len(keys), 2), np.nan)
    for i, key in enumerate(keys):
        for j, side in enumerate(("min", "max")):
            sides[extents["slice"], i, j] = extents[f"{side}_{key}"]
    sent = boxes.sparkSession.sparkContext.broadcast((slices, n, sides))
    columns = [c for c in boxes.columns if c not in ("_low", "_high")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, n, sides = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            low, high = (np.stack(batch.column(c).to_numpy(zero_copy_only=False)).reshape(-1, 3)
                         for c in ("_low", "_high"))
            edge = [batch.column(c).to_numpy(zero_copy_only=False) for c in bounds]
            number, first, last = key_runs(low, high, runs_per_box)
            start, end = slices.reached(first, last)
            copies = np.maximum(end - start + 1, 0)
            ends = np.cumsum(copies)
            boxes_at = np.searchsorted(number, np.arange(batch.num_rows + 1))
            box = 0
            while box < batch.num_rows:  # some boxes at a time, with all of their runs
                done = ends[boxes_at[box] - 1] if boxes_at[box] else 0
                upto = np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")
                stop = max(box + 1, int(np.searchsorted(boxes_at, upto, side="right")) - 1)
                runs = slice(boxes_at[box], boxes_at[stop])
                m = copies[runs]
                offset = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                pair = np.unique(np.repeat(number[runs], m) * np.int64(len(n))
                                 + np.repeat(start[runs], m) + offset)
                at, where = pair // len(n), pair % len(n)
                near, inside = (np.ones(len(pair), dtype=bool) for _ in range(2))
                for i in range(len(keys)):
                    least, most = edge[2 * i][at], edge[2 * i + 1][at]
                    near &= (least <= sides[where, i, 1]) & (most >= sides[where, i, 0])
                    inside &= (least <= sides[where, i, 0]) & (most >= sides[where, i, 1])
                held = np.zeros(stop - box, np.int64)
                np.add.at(held, at[inside] - box, n[where[inside]])
                some = np.flatnonzero(held)
                part = near & ~inside
                kept = batch.select(columns).take(pa.array(np.concatenate([some + box, at[part]])))
                known = np.repeat([True, False], [len(some), int(part.sum())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([some, where[part]]), mask=known),
                     pa.array(np.concatenate([held[some], where[part]]), mask=~known), *kept.columns],
                    names=["slice", "held", *columns])
                box = stop

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in boxes.schema
                      if f.name in columns)
    return boxes.mapInArrow(cut, f"slice bigint, held bigint, {kinds}")


def _below(values: np.ndarray, weights: np.ndarray, bits: int, queries: Sequence[np.ndarray],
           left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """Sum of weights in ``[left, right)`` where the value is below a query's, for lists of queries.

    Values are taken bit by bit from the highest, those with a zero put before those with a one, and
    a query's range follows its own bits.
    """
    found = [np.zeros(len(left), np.int64) for _ in queries]
    ranges = [(left, right) for _ in queries]
    for bit in range(bits - 1, -1, -1):
        one = (values >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~one)])
        light = np.concatenate([[0], np.cumsum(np.where(one, 0, weights))])
        for i, query in enumerate(queries):
            a, b = ranges[i]
            up = (query >> bit & 1).astype(bool)
            found[i] += np.where(up, light[b] - light[a], 0)
            ranges[i] = (np.where(up, zeros[-1] + a - zeros[a], zeros[a]),
                         np.where(up, zeros[-1] + b - zeros[b], zeros[b]))
        order = np.concatenate([np.flatnonzero(~one), np.flatnonzero(one)])
        values, weights = values[order], weights[order]
    return found


def totals_inside(points: Sequence[np.ndarray], weights: np.ndarray, lows: Sequence[np.ndarray],
                  highs: Sequence[np.ndarray]) -> np.ndarray:
    """Sum of the weights of the points in each closed box, of three coordinates, without pairs.

    The coordinate with fewest values is cut into halves, quarters and so on, and a box takes the few
    of these that make up its range. In each, points lie sorted by the coordinate with most values,
    where a box is a range, and the third one is counted bit by bit. Work grows with points and boxes
    and, by up to two logarithms, with the number of values.
    """
    totals = np.zeros(len(lows[0]), np.int64)
    if not len(weights):
        return totals
    found = [np.unique(p, return_inverse=True) for p in points]
    tree, middle, line = np.argsort([len(values) for values, _ in found], kind="stable")
    ranks = [rank.astype(np.int64) for _, rank in found]
    starts = [np.searchsorted(values, low).astype(np.int64) for (values, _), low in zip(found, lows, strict=True)]
    stops = [np.searchsorted(values, high, side="right").astype(np.int64)
             for (values, _), high in zip(found, highs, strict=True)]
    alive = np.ones(len(totals), dtype=bool)
    for low, high, start, stop in zip(lows, highs, starts, stops, strict=True):
        alive &= (low <= high) & (start < stop)
    width, bits = len(found[line][0]) + 1, len(found[middle][0]).bit_length()
    node, low, high = ranks[tree].copy(), starts[tree].copy(), stops[tree].copy()
    by_line = np.argsort(ranks[line], kind="stable")
    while (alive & (low < high)).any():
        first, last = alive & (low < high) & (low & 1 == 1), alive & (low < high) & (high & 1 == 1)
        box = np.concatenate([np.flatnonzero(first), np.flatnonzero(last)])
        if box.size:
            taken = np.concatenate([low[first], high[last] - 1])
            order = by_line[np.argsort(node[by_line], kind="stable")]
            key = node[order] * width + ranks[line][order]
            left = np.searchsorted(key, taken * width + starts[line][box])
            right = np.searchsorted(key, taken * width + stops[line][box])
            least, most = _below(ranks[middle][order], weights[order], bits,
                                 [starts[middle][box], stops[middle][box]], left, right)
            np.add.at(totals, box, most - least)
        node, low, high = node >> 1, (low + first) >> 1, (high - last) >> 1
    return totals


def count_met(boxes: DataFrame, placed: DataFrame, place: Sequence[str], keys: Sequence[str],
              bounds: Sequence[tuple[str, str]], name: str = "box_id", copies: str = "copies"
              ) -> DataFrame:
    """``name, copies`` of the boxes that hold points of their place; a task holds one place."""
    flat = [c for pair in bounds for c in pair]
    dealt = _together(boxes, placed, place, [*flat, name], [*keys, copies])

    def totals(held: list[pa.StructArray], points: list[list[np.ndarray]]) -> pa.RecordBatch:
        rows = pa.concat_arrays(held)
        edge = [rows.field(c).to_numpy(zero_copy_only=False).astype(float) for c in flat]
        *at, weights = map(np.concatenate, zip(*points, strict=True))
        found = totals_inside(at, weights, edge[::2], edge[1::2])
        some = np.flatnonzero(found)
        return pa.RecordBatch.from_arrays(
            [rows.field(name).take(pa.array(some)), pa.array(found[some])], names=[name, copies])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, points = None, [], []
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in place])
            turns = np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *turns], [*turns, batch.num_rows], strict=True):
                if here != tuple(where[:, start]):
                    if held and points:
                        yield totals(held, points)
                    here, held, points = tuple(where[:, start]), [], []
                rows = batch.slice(start, stop - start)
                n = len(rows) - rows.column("point").true_count
                if n:
                    held.append(rows.column("run").slice(0, n))
                if n < len(rows) and held:
                    at = rows.column("at").slice(n)
                    fields = dict(zip([f.name for f in at.type], at.flatten(), strict=True))
                    points.append([fields[c].to_numpy(zero_copy_only=False) for c in (*keys, copies)])
        if held and points:
            yield totals(held, points)

    return dealt.mapInArrow(counted, f"{name} {boxes.schema[name].dataType.simpleString()}, {copies} bigint")


def _pairs(points: dict[str, np.ndarray], runs: dict[str, np.ndarray], keys: Sequence[str],
           bounds: Sequence[tuple[str, str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of runs and points that meet, some pairs at a time, tested exactly."""
    order = np.argsort(points["z"], kind="stable")
    z = points["z"][order]
    low = np.searchsorted(z, runs["z"])
    sizes = np.searchsorted(z, runs["z_end"], side="right") - low
    some = np.flatnonzero(sizes)
    low, sizes = low[some], sizes[some]
    ends = np.cumsum(sizes)
    start = 0
    while start < len(some):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
        n = sizes[start:stop]
        run = np.repeat(some[start:stop], n)
        offset = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        point = order[np.repeat(low[start:stop], n) + offset]
        inside = np.ones(len(run), dtype=bool)
        for key, (least, most) in zip(keys, bounds, strict=True):
            inside &= (points[key][point] >= runs[least][run]) & (points[key][point]
                                                                  <= runs[most][run])
        yield run[inside], point[inside]
        start = stop


def match_by_curve(points: DataFrame, boxes: DataFrame, keys: Sequence[str],
                   bounds: Sequence[tuple[str, str]], name: str = "box_id",
                   slice_rows: int = SLICE_ROWS, slice_runs: int = SLICE_RUNS,
                   runs_per_box: int = RUNS_PER_BOX) -> DataFrame:
    """``name`` and the columns of ``points`` for each point and box it lies in, bounds included.

    ``points`` are settled rows without unknown coordinates; ``boxes`` have ``name`` and a low and a
    high bound per key. Points and runs meet in slices of about ``slice_rows`` points. Each point is
    sent once. Where more than ``slice_runs`` runs reach into a slice, these are dealt to several
    tasks and only that slice's points are sent to each. Within a slice the runs are held, the points
    come in batches, and a pair in a run is tested by the exact bounds.
    """
    placed, slices, known = _placed(points, boxes, keys, bounds, name, slice_rows)
    if placed is None:
        return points.filter(F.lit(False)).select(F.lit("").alias(name), *points.columns)
    flat = [c for pair in bounds for c in pair]
    runs = settle(box_runs(known, flat, slices, runs_per_box), "box-runs")
    return _met(*_in_parts(runs, placed, slice_runs), points, keys, bounds, name)


def count_by_curve(points: DataFrame, boxes: DataFrame, keys: Sequence[str],
                   bounds: Sequence[tuple[str, str]], name: str = "box_id", copies: str = "copies",
                   slice_rows: int = SLICE_ROWS, slice_runs: int = SLICE_RUNS,
                   runs_per_box: int = RUNS_PER_BOX) -> DataFrame:
    """``name, copies``: the sum of ``copies`` of the points in a box, in one row or several.

    Points and boxes are those of ``match_by_curve`` and meet in the same slices, but no pair is made.
    A slice that lies in a box whole is counted by its total; the box is sent to the slices that it
    cuts, where ``totals_inside`` counts for all boxes of the slice. One row a slice, its total and
    the box around its points, reaches the driver and all tasks.
    """
    placed, slices, known = _placed(points, boxes, keys, bounds, name, slice_rows)
    if placed is None:
        return points.filter(F.lit(False)).select(F.lit("").alias(name), copies)
    flat = [c for pair in bounds for c in pair]
    extents = placed.groupBy("slice").agg(
        F.sum(copies).alias("n"),
        *[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).toPandas()
    edges = settle(_box_edges(known, flat, slices, extents, keys, runs_per_box), "box-edges")
    whole = edges.filter("slice IS NULL").select(name, F.col("held").alias(copies))
    cut = edges.filter("slice IS NOT NULL").drop("held")
    boxes_in, points_in = _in_parts(cut, placed.select("slice", *keys, copies), slice_runs)
    return whole.unionByName(count_met(boxes_in, points_in, ["slice", "part"], keys, bounds, name, copies))


def _placed(points: DataFrame, boxes: DataFrame, keys: Sequence[str],
            bounds: Sequence[tuple[str, str]], name: str, slice_rows: int
            ) -> tuple[DataFrame | None, Slices | None, DataFrame | None]:
    """Points in slices, the slices, and the boxes near points with their cells; None without points."""
    sides = points.agg(*[f(k) for k in keys for f in (F.min, F.max)]).first()
    if sides is None or sides[0] is None:
        return None, None, None
    cells = (1 << BITS) - 1

    def cell(value: Column, i: int) -> Column:
        least, most = sides[2 * i], sides[2 * i + 1]
        held = F.greatest(F.lit(least), F.least(F.lit(most), value))
        share = (held - F.lit(least)) / F.lit(most - least) if most > least else held * 0.0
        return F.floor(share * F.lit(float(cells))).cast("bigint")

    keyed = points.withColumn("z", key_of([cell(F.col(k), i) for i, k in enumerate(keys)]))
    slices = cut_slices(keyed, slice_rows)
    placed = _slice_of(keyed, slices)
    flat = [c for pair in bounds for c in pair]
    known = boxes.select(name, *[F.col(c).cast("double").alias(c) for c in flat]).filter(
        reduce(and_, [(F.col(a) <= F.col(b)) & (F.col(a) <= F.lit(sides[2 * i + 1]))
                      & (F.col(b) >= F.lit(sides[2 * i])) for i, (a, b) in enumerate(bounds)]))
    low, high = (F.array(*[cell(F.col(pair[side]), i) for i, pair in enumerate(bounds)])
                 for side in (0, 1))
    # A file of many boxes may be one task's input; cutting them into runs is dealt to all cores.
    dealt = known.repartition(known.sparkSession.sparkContext.defaultParallelism, name, *flat)
    return placed, slices, dealt.withColumn("_low", low).withColumn("_high", high)


def _in_parts(runs: DataFrame, placed: DataFrame, slice_runs: int) -> tuple[DataFrame, DataFrame]:
    """Both with ``part``; a slice of more than ``slice_runs`` runs is dealt to several, with its points."""
    over = settle(runs.groupBy("slice").agg(
        F.ceil(F.count(F.lit(1)) / slice_runs).alias("parts")).filter("parts > 1"), "full-slices")
    if over.isEmpty():
        runs, placed = (df.withColumn("part", F.lit(0).cast("bigint")) for df in (runs, placed))
    else:
        parts = F.coalesce("parts", F.lit(1).cast("bigint"))
        runs = runs.join(over, "slice", "left").withColumn(
            "part", F.pmod(F.xxhash64(*runs.columns), parts)).drop("parts")
        placed = placed.join(over, "slice", "left").withColumn(
            "part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("parts")
    return runs, placed


def _together(runs: DataFrame, placed: DataFrame, place: Sequence[str], run_columns: Sequence[str],
              point_columns: Sequence[str]) -> DataFrame:
    """Rows ``*place, point, run, at`` with those of a place in one task, its runs before its points."""
    run_row, point_row = F.struct(*run_columns), F.struct(*point_columns)
    kinds = [df.select(row.alias("r")).schema["r"].dataType
             for df, row in ((runs, run_row), (placed, point_row))]
    both = runs.select(*place, F.lit(False).alias("point"), run_row.alias("run"),
                       F.lit(None).cast(kinds[1]).alias("at")).unionByName(
        placed.select(*place, F.lit(True).alias("point"), F.lit(None).cast(kinds[0]).alias("run"),
                      point_row.alias("at")))
    return (both.repartition(*place).sortWithinPartitions(*place, "point")
            .select(*place, "point", "run", "at"))


def _met(runs: DataFrame, placed: DataFrame, points: DataFrame, keys: Sequence[str],
         bounds: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """The matches of each slice and part, its runs sorted before its points."""
    place = ["slice", "part"]
    flat = [c for pair in bounds for c in pair]
    columns = [*points.columns]
    dealt = _together(runs, placed, place, ["z", "z_end", *flat, name], ["z", *columns])

    def numbers(rows: pa.StructArray, names: Sequence[str]) -> dict[str, np.ndarray]:
        return {c: rows.field(c).to_numpy(zero_copy_only=False) for c in names}

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, runs, names = None, [], None, None
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in place])
            turns = np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *turns], [*turns, batch.num_rows], strict=True):
                if here != tuple(where[:, start]):
                    here, held, runs, names = tuple(where[:, start]), [], None, None
                rows = batch.slice(start, stop - start)
                is_point = rows.column("point")
                n = len(is_point) - is_point.true_count
                if n:
                    held.append(rows.column("run").slice(0, n))
                if n == len(is_point) or not held:
                    continue
                if runs is None:
                    found = pa.concat_arrays(held)
                    runs, names = numbers(found, ["z", "z_end", *flat]), found.field(name)
                at = rows.column("at").slice(n)
                # A slice of a struct array keeps its offset; its fields are taken with it.
                flat_at = dict(zip([f.name for f in at.type], at.flatten(), strict=True))
                coordinates = {c: flat_at[c].to_numpy(zero_copy_only=False) for c in ("z", *keys)}
                for run, point in _pairs(coordinates, runs, keys, bounds):
                    if len(run):
                        yield pa.RecordBatch.from_arrays(
                            [names.take(pa.array(run)),
                             *[flat_at[c].take(pa.array(point)) for c in columns]],
                            names=[name, *columns])

    schema = ", ".join([f"{name} {runs.schema[name].dataType.simpleString()}", *[
        f"{f.name} {f.dataType.simpleString()}" for f in points.schema]])
    return dealt.mapInArrow(matched, schema)
