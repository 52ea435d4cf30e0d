"""Gridded tables ``i, j, v`` with one row per cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.functions.scalars import sine_profile


def grid_neighbor_mean(grid: DataFrame) -> DataFrame:
    """Mean of the four neighbours of each interior cell; cells lacking one give no row.

    Each cell sends its value to its neighbours and marks itself, then one aggregation adds up
    what arrived: one shuffle with map-side combining, at most five rows per cell.
    """
    i, j, v = F.col("i"), F.col("j"), F.col("v")

    def sent(di: int, dj: int):
        return F.struct((i + di).alias("i"), (j + dj).alias("j"), v.alias("v"),
                        F.lit(False).alias("own"))

    own = F.struct(i.alias("i"), j.alias("j"), v.alias("v"), F.lit(True).alias("own"))
    targets = F.array(own, sent(-1, 0), sent(1, 0), sent(0, -1), sent(0, 1))
    return (grid.select(F.explode(targets).alias("c")).select("c.*")
            .groupBy("i", "j")
            .agg(F.sum(F.when(~F.col("own"), F.col("v"))).alias("_total"),
                 F.count_if(~F.col("own")).alias("_neighbours"),
                 F.count_if("own").alias("_own"))
            .filter((F.col("_neighbours") == 4) & (F.col("_own") > 0))
            .select("i", "j", (F.col("_total") * 0.25).alias("v")))


TILE_SIDE = 64


def to_tiles(grid: DataFrame, side: int = TILE_SIDE) -> DataFrame:
    """Cells ``i, j, v`` as square blocks ``ti, tj, values``, row by row, null where a cell is lacking.

    One shuffle, in which each cell travels once. Cells must be unique; a cell without a place or a
    value is lacking.
    """
    i, j = F.col("i"), F.col("j")
    place = (F.pmod(i, F.lit(side)) * side + F.pmod(j, F.lit(side))).cast("int")
    cells = (grid.filter(i.isNotNull() & j.isNotNull() & F.col("v").isNotNull())
             .groupBy(F.floor(i / side).alias("ti"), F.floor(j / side).alias("tj"))
             .agg(F.sort_array(F.collect_list(F.struct(place.alias("p"), F.col("v").cast("double")
                                                       .alias("v")))).alias("_cells")))
    null = F.lit(None).cast("double")

    def after_gap(cell, k):
        before = F.when(k == 0, F.lit(-1)).otherwise(F.get(F.col("_cells"), k - 1)["p"])
        return F.concat(F.array_repeat(null, cell["p"] - before - 1), F.array(cell["v"]))

    rest = F.array_repeat(null, F.lit(side * side - 1) - F.element_at("_cells", -1)["p"])
    return cells.select("ti", "tj", F.concat(
        F.flatten(F.transform("_cells", after_gap)), rest).alias("values"))


def tile_edges(tiles: DataFrame, side: int = TILE_SIDE) -> DataFrame:
    """What each tile sends: its four outer rows and columns, each to the tile beside it."""
    def line(first: int, step: int):
        if step == 1:
            return F.slice("values", first + 1, side)
        return F.transform(F.sequence(F.lit(0), F.lit(side - 1)),
                           lambda k: F.get(F.col("values"), k * step + first))

    def sent(di: int, dj: int, name: str, cells):
        return F.struct((F.col("ti") + di).alias("ti"), (F.col("tj") + dj).alias("tj"),
                        F.lit(name).alias("at"), cells.alias("edge"))

    return tiles.select(F.explode(F.array(
        sent(1, 0, "above", line(side * (side - 1), 1)), sent(-1, 0, "below", line(0, 1)),
        sent(0, 1, "left", line(side - 1, side)), sent(0, -1, "right", line(0, side))))
        .alias("e")).select("e.*")


def tile_neighbor_mean(tiles: DataFrame, side: int = TILE_SIDE) -> DataFrame:
    """``grid_neighbor_mean`` on blocks: cells ``i, j, v`` that have all four neighbours.

    Only edges travel, at most four short rows per tile. Tiles that ``to_tiles`` made in the same plan
    lie where the join wants them and do not move again.
    """
    edges = tile_edges(tiles, side)
    none = F.array_repeat(F.lit(None).cast("double"), side)
    sides = ["above", "below", "left", "right"]
    halo = edges.groupBy("ti", "tj").agg(*[
        F.first(F.when(F.col("at") == s, F.col("edge")), ignorenulls=True).alias(s) for s in sides])
    framed = tiles.join(halo, ["ti", "tj"], "left").withColumns(
        {s: F.coalesce(s, none) for s in sides})
    corner = F.array(F.lit(None).cast("double"))
    middle = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda r: F.concat(
        F.array(F.get(F.col("left"), r)), F.slice("values", r * side + 1, F.lit(side)),
        F.array(F.get(F.col("right"), r)))))
    # As one value: as a plain column each of its five uses would put it together again.
    padded = framed.select("ti", "tj", F.explode(F.array(F.concat(
        corner, F.col("above"), corner, middle, corner, F.col("below"), corner))).alias("_p"))
    wide = side + 2

    def mean(k):
        at = (F.floor(k / side) + 1) * wide + k % side + 1
        up, down, left, right = (F.get(F.col("_p"), (at + d).cast("int")) for d in (-wide, wide, -1, 1))
        return F.when(F.get(F.col("_p"), at.cast("int")).isNotNull(),
                      (up + down + left + right) * 0.25)

    means = padded.select("ti", "tj", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(side * side - 1)), mean)).alias("_k", "v"))
    return means.filter("v IS NOT NULL").select(
        (F.col("ti") * side + F.floor(F.col("_k") / side)).alias("i"),
        (F.col("tj") * side + F.col("_k") % side).alias("j"), "v")


def max_abs_change(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("i", "j"),
                   value: str = "v") -> DataFrame:
    """Largest absolute difference between two versions of a table with unique keys."""
    old = before.select(*keys, F.col(value).alias("_old"))
    new = after.select(*keys, F.col(value).alias("_new"))
    return old.join(new, list(keys)).agg(
        F.max(F.abs(F.col("_new") - F.col("_old"))).alias("max_change"))


def edge_profile(df: DataFrame, index: str, length: int) -> DataFrame:
    """Boundary value at each position of an edge of ``length`` cells."""
    return df.select(index, sine_profile(F.col(index), length).alias("v"))
