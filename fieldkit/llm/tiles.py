"""Comparing the rows of a group with another tile by tile, whatever the size of the group."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.session import settle

TILE_ROWS = 2048
SMALL_GROUP = 64


def tile_pairs(rows: DataFrame, group: Sequence[str], salt: str, level: str | None = None,
               radius: int = 0, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Deal the rows of each group into pairs of tiles, so that every pair of rows meets in one.

    Adds ``run``, which names a pair of tiles, and whether the pair is of two tiles (``is_cross``) and
    a row in its second (``is_second``). A group of up to ``tile_rows`` rows is one tile. A larger one
    is cut by ``level`` (rows whose levels differ by more than ``radius`` need not meet, so such tiles
    are not paired) and by a hash of ``salt``; its rows are repeated for each tile they meet. Groups
    of one row are left out. ``rows`` is read twice and should be settled.
    """
    level_column = F.col(level).cast("int") if level else F.lit(0)
    rows = rows.withColumn("_level", level_column)
    levels = rows.groupBy(*group, "_level").agg(F.count(F.lit(1)).alias("n"))
    # One row for each group, with an entry for each level: at most as many as levels exist.
    layout = settle(
        levels.groupBy(*group).agg(F.sum("n").alias("rows"), F.collect_list(
            F.struct("_level", F.ceil(F.col("n") / tile_rows).cast("int").alias("cuts")))
            .alias("levels")).filter("rows > 1")
        .withColumn("levels", F.when(F.col("rows") > tile_rows, F.col("levels"))), "layout")
    mine = F.filter("levels", lambda x: x["_level"] == F.col("_level"))[0]["cuts"]
    met = F.flatten(F.transform(
        F.filter("levels", lambda x: F.abs(x["_level"] - F.col("_level")) <= radius),
        lambda x: F.transform(F.sequence(F.lit(0), x["cuts"] - 1),
                              lambda s: F.struct(x["_level"].alias("level"), s.alias("cut")))))
    whole = F.struct(F.lit(0).alias("level"), F.lit(0).alias("cut"))
    return (rows.join(layout, list(group))
              .withColumn("tile", F.when(F.col("levels").isNull(), whole).otherwise(
                  F.struct(F.col("_level").alias("level"),
                           F.pmod(F.xxhash64(salt), mine).cast("int").alias("cut"))))
              .withColumn("_met", F.explode(F.when(F.col("levels").isNull(), F.array(whole))
                                            .otherwise(met)))
              .withColumn("first", F.least("tile", "_met"))
              .withColumn("second", F.greatest("tile", "_met"))
              .withColumn("is_second", F.col("tile") != F.col("first"))
              .withColumn("is_cross", F.col("first") != F.col("second"))
              .withColumn("run", F.xxhash64(*group, "first", "second"))
              .drop("levels", "rows", "_met", "_level", "tile", "first", "second"))


def in_runs(placed: DataFrame, order: str) -> DataFrame:
    """Rows partitioned and sorted so that a pair of tiles is one run of rows."""
    return placed.repartition("run").sortWithinPartitions("run", "is_second", order)


def whole_runs(batches: Iterable[pd.DataFrame], keys: Sequence[str]) -> Iterator[
        tuple[pd.DataFrame, np.ndarray]]:
    """Frames that hold whole runs of equal keys, with the row at which each run starts."""
    held: list[pd.DataFrame] = []

    def starts(frame: pd.DataFrame) -> np.ndarray:
        new = np.zeros(len(frame), dtype=bool)
        new[:1] = True
        for key in keys:
            values = frame[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        last = tuple(batch[k].iloc[-1] for k in keys)
        if all(batch[k].iloc[0] == x for k, x in zip(keys, last, strict=True)):
            if len(held) == 1 or all(held[-2][k].iloc[-1] == x
                                     for k, x in zip(keys, last, strict=True)):
                continue  # the run goes on
        frame = pd.concat(held, ignore_index=True) if len(held) > 1 else batch.reset_index(drop=True)
        begins = starts(frame)
        held = [frame.iloc[begins[-1]:]]
        if len(begins) > 1:
            yield frame.iloc[:begins[-1]], begins[:-1]
    if held:
        frame = pd.concat(held, ignore_index=True)
        yield frame, starts(frame)


def compared_blocks(starts: np.ndarray, rows: int, cross: np.ndarray, second: np.ndarray,
                    width: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Row numbers to compare, as arrays ``left`` (g, n) and ``right`` (g, m), and whether equal.

    Small runs of the same size come together as one array; large ones in blocks. Where left and
    right are the same rows, only pairs above the diagonal count.
    """
    sizes = np.diff(np.append(starts, rows))
    inside = ~cross[starts]
    for size in np.unique(sizes[inside & (sizes > 1) & (sizes <= SMALL_GROUP)]):
        chosen = starts[inside & (sizes == size)]
        step = max(1, width * width // int(size * size))
        for i in range(0, len(chosen), step):
            index = chosen[i:i + step, None] + np.arange(size)
            yield index, index, True
    for start, size in zip(starts[~inside | (sizes > SMALL_GROUP)],
                           sizes[~inside | (sizes > SMALL_GROUP)], strict=True):
        index = np.arange(start, start + size)
        if not cross[start]:
            parts = [index[i:i + width] for i in range(0, size, width)]
            for i, left in enumerate(parts):
                for right in parts[i:]:
                    yield left[None], right[None], left is right
        else:
            lefts, rights = index[~second[index]], index[second[index]]
            for i in range(0, len(lefts), width):
                for j in range(0, len(rights), width):
                    yield lefts[None, i:i + width], rights[None, j:j + width], False
