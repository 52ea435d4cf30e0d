"""Lines of least absolute error for several targets and inputs, by reweighted least squares."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.session import settle

SHRINK = 0.5
LEAST_FLOOR = 1e-5


class L1Line(NamedTuple):
    """A fitted line: its terms, its mean absolute error on the rows it was fitted to, and steps taken."""

    intercept: float
    coefficients: tuple[float, ...]
    mae: float
    rows: int
    steps: int


def _usable(column: str):
    """The value where it is a finite number, null elsewhere."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def _packed(train: DataFrame, targets: Sequence[str], inputs: Sequence[str]) -> DataFrame:
    """Inputs and targets as arrays, without rows that lack an input; a lacking target is null."""
    x, y = F.array(*[_usable(c) for c in inputs]), F.array(*[_usable(c) for c in targets])
    return train.select(x.cast("array<double>").alias("x"), y.alias("y")).filter(
        ~F.exists("x", lambda v: v.isNull()))


def _moments(rows: DataFrame, middle: np.ndarray, width: np.ndarray, lines: np.ndarray,
             floors: np.ndarray) -> list[np.ndarray]:
    """Of each target: weighted squares and products of the terms and it, rows, and absolute error.

    A task adds up all of its batches and returns one number per cell; these are summed by cell, so
    the driver gets as many numbers as the terms have pairs, whatever the number of rows or tasks.
    """
    targets, terms = lines.shape
    cells = terms * (terms + 1) + 2

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((targets, cells))
        for batch in batches:
            n = batch.num_rows
            x = np.ones((n, terms))
            x[:, 1:] = (batch.column("x").flatten().to_numpy().reshape(n, terms - 1) - middle) / width
            ys = batch.column("y").flatten().to_numpy(zero_copy_only=False).reshape(n, targets)
            for t in range(targets):
                has = ~np.isnan(ys[:, t])
                a, y = x[has], ys[has, t]
                error = np.abs(y - a @ lines[t])
                weighted = a / np.maximum(error, floors[t])[:, None] if floors[t] > 0 else a
                sums[t] += np.concatenate([(weighted.T @ a).ravel(), weighted.T @ y,
                                           [has.sum(), error.sum()]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(targets), cells), pa.int32()),
             pa.array(np.tile(np.arange(cells), targets), pa.int32()), pa.array(sums.ravel())],
            names=["target", "cell", "value"])

    found = np.zeros((targets, cells))
    parts = rows.mapInArrow(added, "target int, cell int, value double")
    for row in parts.groupBy("target", "cell").agg(F.sum("value").alias("value")).collect():
        found[row["target"], row["cell"]] = row["value"]
    return list(found)


def fit_l1(train: DataFrame, targets: Sequence[str], inputs: Sequence[str], max_steps: int = 60,
           tolerance: float = 1e-7) -> dict[str, L1Line]:
    """For each target, the line over ``inputs`` whose mean absolute error is least.

    Each step is one pass for all targets: it weighs a row by one over its error under the line so far,
    adds up the weighted moments, and solves for the next line. Weights are held below one over a floor
    that starts at the mean error and is halved every step. A target is done when ten steps or more were
    made and three in a row gain less than ``tolerance`` of its error; the best line seen is returned.

    Rows with an input that is null, not a number or infinite teach nothing; a target that is so is
    left out of that target's line only. Inputs without variance or that depend on others get the
    solution of least norm. Without rows a line is null: not-a-number terms and error.
    """
    targets, inputs = list(targets), list(inputs)
    rows = settle(_packed(train, targets, inputs), "l1-rows")
    shape = rows.agg(*[F.struct(F.avg(F.col("x")[i]), F.stddev_pop(F.col("x")[i]))
                       for i in range(len(inputs))], F.count(F.lit(1))).first()
    if not shape[-1]:
        nothing = L1Line(float("nan"), (float("nan"),) * len(inputs), float("nan"), 0, 0)
        return dict.fromkeys(targets, nothing)
    middle = np.array([pair[0] for pair in shape[:-1]])
    width = np.array([pair[1] or 1.0 for pair in shape[:-1]])
    terms = len(inputs) + 1
    lines = np.zeros((len(targets), terms))
    best, low = lines.copy(), np.full(len(targets), np.inf)
    counts, calm = np.zeros(len(targets), dtype=int), np.zeros(len(targets), dtype=int)
    scale = np.zeros(len(targets))
    done = np.full(len(targets), 0)
    for step in range(max_steps + 1):
        # The zero line's pass has no weights, so the first line is that of least squares.
        floors = scale * max(SHRINK ** max(step - 1, 0), LEAST_FLOOR)
        sums = _moments(rows, middle, width, lines, floors)
        for t, cells in enumerate(sums):
            counts[t], total = int(cells[-2]), cells[-1]
            if not counts[t] or done[t]:
                continue
            mae = total / counts[t]
            if step == 1:
                scale[t] = mae
            if step:
                calm[t] = calm[t] + 1 if mae >= low[t] * (1 - tolerance) else 0
                if mae < low[t]:
                    low[t], best[t] = mae, lines[t]
                if mae == 0 or (step > 10 and calm[t] >= 3):
                    done[t] = step
                    continue
            square = cells[:terms * terms].reshape(terms, terms)
            lines[t] = np.linalg.lstsq(square, cells[terms * terms:-2], rcond=1e-12)[0]
        if (done[counts > 0] > 0).all():
            break
    found = {}
    for t, name in enumerate(targets):
        slopes = best[t, 1:] / width
        start = best[t, 0] - slopes @ middle
        if not counts[t]:
            start, slopes, low[t] = float("nan"), np.full(len(inputs), np.nan), float("nan")
        found[name] = L1Line(float(start), tuple(map(float, slopes)), float(low[t]), int(counts[t]),
                             int(done[t] or max_steps))
    return found


def predict_l1(lines: dict[str, L1Line], df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Predictions of all lines side by side, as ``predicted_<target>``; plain column arithmetic."""
    added = {}
    for target, line in lines.items():
        value = F.lit(line.intercept)
        for name, slope in zip(inputs, line.coefficients):
            value = value + F.lit(slope) * F.col(name).cast("double")
        added[f"predicted_{target}"] = value
    return df.withColumns(added)
