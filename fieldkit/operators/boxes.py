"""Closed boxes in frequency, ascension and declination, and the blips inside them.

A box table has ``box_id, f_lo, f_hi, a_lo, a_hi, d_lo, d_hi``. A blip is in a box if its
coordinates, rounded, lie within all three closed ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fieldkit.functions.scalars import bucket
from fieldkit.functions.text import float_list_text, tuple_text
from fieldkit.operators.curve import SLICE_RUNS, count_by_curve, count_met, match_by_curve
from fieldkit.operators.quantiles import exact_medians, exact_medians_by
from fieldkit.operators.signals import KEYS, LIST_ROWS, bucket_blips, signal_times
from fieldkit.operators.skew import HOT_ROWS, deal_salted, expand_copies, match_keys, salted_join
from fieldkit.session import settle

BOX_SCHEMA = ("box_id string, f_lo double, f_hi double, a_lo double, a_hi double, "
              "d_lo double, d_hi double")
_BOUNDS = dict(zip(KEYS, [("f_lo", "f_hi"), ("a_lo", "a_hi"), ("d_lo", "d_hi")]))
FEW_BOXES = 64
# 20,000 boxes are about 160,000 cells of 100 bytes: a broadcast of some 16 MB.
SOME_BOXES = 20_000
LEVEL_CLASSES = 4
_FINEST_LEVEL = -20
_FARTHEST = 2.0 ** 40


@dataclass(frozen=True)
class Box:
    """One named box with its bounds included."""

    box_id: str
    f_lo: float
    f_hi: float
    a_lo: float
    a_hi: float
    d_lo: float
    d_hi: float

    def range_of(self, key: str) -> tuple[float, float]:
        """Lower and upper bound on one coordinate."""
        low, high = _BOUNDS[key]
        return getattr(self, low), getattr(self, high)


def boxes_frame(spark: SparkSession, boxes: Sequence[Box]) -> DataFrame:
    """A box table from a list."""
    rows = [(name, *map(float, bounds)) for name, *bounds in map(astuple, boxes)]
    return spark.createDataFrame(rows, BOX_SCHEMA)


def _inside(box: Box, margin: float = 0.0) -> Column:
    return reduce(and_, [F.col(k).between(F.lit(box.range_of(k)[0] - margin),
                                          F.lit(box.range_of(k)[1] + margin)) for k in KEYS])


def _raw_margin(decimals: int) -> float:
    # twice the rounding radius, so float error cannot lose a row
    return 10.0 ** -decimals


def in_boxes(blips: DataFrame, boxes: Sequence[Box], decimals: int) -> DataFrame:
    """Rounded blips that may be in one of a few boxes.

    Rounded columns cannot be pushed to a scan, so an implied filter on the raw columns, a
    little wider than the boxes, is put before the rounding.
    """
    wide = reduce(or_, [_inside(b, _raw_margin(decimals)) for b in boxes])
    return bucket_blips(blips.filter(wide), decimals)


def box_blips(blips: DataFrame, box: Box, decimals: int = 5) -> DataFrame:
    """Blips in one box, sorted by time."""
    return blips_inside(blips, box, decimals).orderBy("time", *KEYS)


def blips_inside(blips: DataFrame, box: Box, decimals: int = 5) -> DataFrame:
    """Blips in one box, in no order."""
    return in_boxes(blips, [box], decimals).filter(_inside(box)).select(*KEYS, "time")


def box_signals(blips: DataFrame, box: Box, decimals: int = 5, hot_rows: int = HOT_ROWS,
                list_rows: int = LIST_ROWS) -> DataFrame:
    """Count and sorted times of each signal in one box; see ``signal_times`` for ``part``."""
    return signal_times(blips_inside(blips, box, decimals), KEYS, "time", hot_rows, list_rows)


def formatted_boxes(signals: DataFrame) -> DataFrame:
    """Box signals as lines such as ``(3.0, 1.0, 2.0): Count = 2, Times = [4.0, 5.5]``.

    A line for a list after a signal's first one ends in its number, such as ``, Part = 2``.
    """
    line = F.concat(tuple_text([F.col(k) for k in KEYS]), F.lit(": Count = "),
                    F.col("blip_count").cast("string"), F.lit(", Times = "),
                    float_list_text(F.col("times")),
                    F.when(F.col("part") > 1, F.concat(F.lit(", Part = "), F.col("part")
                                                       .cast("string"))).otherwise(""))
    return signals.select(line.alias("line"))


def match_boxes(blips: DataFrame, boxes: DataFrame, decimals: int = 5, **matching) -> DataFrame:
    """One row ``box_id, keys, time, copies`` per different blip and box it lies in.

    ``copies`` says how many equal blips a row stands for. A box without a name matches like any
    other; one with an unknown bound holds nothing. The result does not depend on how boxes are
    matched; see ``_matched`` for the ways and their limits.
    """
    return (_matched(blips, boxes, decimals, **matching).groupBy("box_id", *KEYS, "time")
            .agg(F.sum("copies").alias("copies")))


def _matched(blips: DataFrame, boxes: DataFrame, decimals: int = 5, few_boxes: int = FEW_BOXES,
             some_boxes: int = SOME_BOXES, hot_rows: int = HOT_ROWS,
             by_curve: bool = True, totals: bool = False, **slicing) -> DataFrame:
    """The rows of ``match_boxes``, in which equal blips may be one row or several.

    With ``totals``, columns other than ``box_id`` and ``copies`` may be missing, and a box may have
    a row for many blips: a join by shuffle then counts in its cells or slices and makes no pairs.

    How boxes are matched depends on their checked number:

    * up to ``few_boxes`` become literals: one filter before the rounding and one expansion in
      place, with no join;
    * up to ``some_boxes`` are cut into grid cells, which are broadcast to an equi join;
    * more are joined by shuffling. Equal blips are then counted first. ``by_curve`` sends each
      different blip once, to a slice of the boxes' runs in a space-filling order (``slicing`` goes to
      ``match_by_curve``); else it is sent once for each cell size in use, and a crowded cell is dealt
      to several tasks.
    """
    boxes = boxes.select(*Box.__dataclass_fields__)
    head = boxes.limit(few_boxes + 1).collect()
    if len(head) <= few_boxes:
        few = [Box(*row) for row in head if None not in tuple(row)[1:]]
        if not few:
            return _no_match(bucket_blips(blips, decimals))
        found = F.array(*[F.when(_inside(b), F.struct(F.lit(b.box_id).cast("string")
                                                      .alias("box_id"))) for b in few])
        return (in_boxes(blips, few, decimals)
                .select(F.explode(F.array_compact(found)).alias("_box"), *KEYS, "time")
                .select("_box.box_id", *KEYS, "time", F.lit(1).cast("bigint").alias("copies")))
    grid = _grid(boxes)
    if not grid.cells:
        return _no_match(bucket_blips(blips, decimals))
    inside = grid.envelope()
    rows = bucket_blips(blips.filter(_inside(inside, _raw_margin(decimals))), decimals)
    if boxes.limit(some_boxes + 1).count() <= some_boxes:
        rows = rows.withColumn("copies", F.lit(1).cast("bigint"))
        return _match_by_cell(rows, grid, None)
    counted = settle(rows.groupBy(*KEYS, *([] if totals else ["time"])).agg(
        F.count(F.lit(1)).alias("copies")), "counted-blips")
    if totals:
        return (count_by_curve(counted, boxes, KEYS, list(_BOUNDS.values()), **slicing) if by_curve
                else _count_by_cell(counted, grid, hot_rows))
    if by_curve:
        return match_by_curve(counted, boxes, KEYS, list(_BOUNDS.values()), **slicing)
    return _match_by_cell(counted, grid, hot_rows)


def _no_match(rows: DataFrame) -> DataFrame:
    return rows.filter(F.lit(False)).select(
        F.lit("").alias("box_id"), *KEYS, "time", F.lit(1).cast("bigint").alias("copies"))


def _clip(value: Column) -> Column:
    """Cells stop at some far value, so an open-ended box still covers few of them."""
    return F.greatest(F.lit(-_FARTHEST), F.least(F.lit(_FARTHEST), value))


def _box_level(key: str) -> Column:
    """Power of two that makes a cell at least as wide as the box."""
    low, high = (_clip(F.col(c)) for c in _BOUNDS[key])
    width = F.greatest(high - low, F.lit(2.0 ** _FINEST_LEVEL))
    return F.ceil(F.log2(width)).cast("int")


class Grid(NamedTuple):
    """Boxes with the cell size each uses per coordinate, and the sizes in use with their bounds."""

    boxes: DataFrame
    cells: list[Row]

    def envelope(self) -> Box:
        """The smallest box around all boxes."""
        bounds = [f([row[c] for row in self.cells]) for pair in _BOUNDS.values()
                  for c, f in zip(pair, (min, max))]
        return Box("envelope", *bounds)


def _classes(levels: list[int], most: int) -> list[int]:
    """The largest level of each of up to ``most`` runs of levels, each as long as the others."""
    run = -(-len(levels) // most)
    return [levels[min(i + run, len(levels)) - 1] for i in range(0, len(levels), run)]


def _grid(boxes: DataFrame, classes: int = LEVEL_CLASSES) -> Grid:
    """Cell sizes for the boxes, at most ``classes`` per coordinate.

    A box's own size per coordinate is the power of two next above its width. Where a coordinate has
    more sizes than ``classes``, neighbouring sizes share the largest of them, so sizes are
    coarsened by a part of their range only, whatever the mix of widths. The sizes of one coordinate
    lie between fixed levels, so what is collected is small.
    """
    boxes = boxes.filter(reduce(and_, [F.col(low) <= F.col(high) for low, high in _BOUNDS.values()]))
    found = boxes.agg(*[F.sort_array(F.collect_set(_box_level(k))).alias(k) for k in KEYS]).first()

    def size(key: str) -> Column:
        tops = _classes(found[key], classes)
        return reduce(lambda rest, top: F.when(_box_level(key) <= top, F.lit(top)).otherwise(rest),
                      reversed(tops), F.lit(None).cast("int"))

    if not found[KEYS[0]]:
        return Grid(boxes, [])
    levels = [f"{k}_level" for k in KEYS]
    sized = boxes.select("*", *[size(k).alias(c) for k, c in zip(KEYS, levels)])
    cells = sized.groupBy(*levels).agg(*[
        f(c).alias(c) for pair in _BOUNDS.values() for c, f in zip(pair, (F.min, F.max))]).collect()
    return Grid(sized, cells)


def _in_cells(rows: DataFrame, grid: Grid) -> tuple[DataFrame, DataFrame, list[str]]:
    """Blips and boxes with the cells they lie in, and the columns that name a cell.

    A box covers about two cells per coordinate. A blip lies in one cell of each size in use, and
    is looked up only in the sizes whose boxes' envelope it is in.
    """
    level_cols = [f"{k}_level" for k in KEYS]
    cell_cols = [f"{k}_cell" for k in KEYS]

    box_cells = grid.boxes
    for key in KEYS:
        size = F.pow(F.lit(2.0), F.col(f"{key}_level"))
        low, high = (F.floor(_clip(F.col(c)) / size) for c in _BOUNDS[key])
        box_cells = box_cells.withColumn(f"{key}_cell", F.explode(F.sequence(low, high)))

    def within(row: Row) -> Column:
        return reduce(and_, [F.col(k).between(*[F.lit(row[c]) for c in _BOUNDS[k]]) for k in KEYS])

    places = F.array(*[
        F.when(within(row), F.struct(
            *[F.lit(row[c]).alias(c) for c in level_cols],
            *[F.floor(_clip(F.col(k)) / F.lit(2.0 ** row[f"{k}_level"])).alias(f"{k}_cell")
              for k in KEYS]))
        for row in grid.cells])
    placed = (rows.withColumn("_place", F.explode(F.array_compact(places)))
              .select("*", "_place.*").drop("_place"))

    return placed, box_cells, level_cols + cell_cols


def _match_by_cell(rows: DataFrame, grid: Grid, hot_rows: int | None) -> DataFrame:
    """Equi join of blips and boxes on grid cells, then the exact test.

    The boxes' cells are broadcast if ``hot_rows`` is None, and else joined by shuffle.
    """
    placed, box_cells, on = _in_cells(rows, grid)
    joined = (placed.join(F.broadcast(box_cells), on) if hot_rows is None
              else salted_join(placed, settle(box_cells, "box-cells"), on, hot_rows))
    exact = reduce(and_, [F.col(k).between(*[F.col(c) for c in _BOUNDS[k]]) for k in KEYS])
    return joined.filter(exact).select("box_id", *KEYS, "time", "copies")


def _count_by_cell(rows: DataFrame, grid: Grid, hot_rows: int) -> DataFrame:
    """``box_id, copies`` from the same cells by shuffle, where a task counts for all boxes of a cell."""
    placed, box_cells, on = _in_cells(rows, grid)
    flat = [c for pair in _BOUNDS.values() for c in pair]
    placed = settle(placed.select(*on, *KEYS, "copies"), "placed-blips")
    box_cells = settle(box_cells.select(*on, "box_id", *[F.col(c).cast("double").alias(c) for c in flat]),
                       "box-cells")
    points, boxes, place = deal_salted(placed, box_cells, on, hot_rows, SLICE_RUNS)
    return count_met(boxes, points, place, KEYS, list(_BOUNDS.values()))


def box_totals(blips: DataFrame, boxes: DataFrame, decimals: int = 5, **matching) -> DataFrame:
    """Blips per box; a box without blips has 0. ``matching`` goes to ``_matched``."""
    totals = (_matched(blips, boxes, decimals, totals=True, **matching).groupBy("box_id")
              .agg(F.sum("copies").alias("total_blips")))
    return (match_keys(boxes.select("box_id"), totals, ["box_id"], "left")
            .select("box_id", F.coalesce("total_blips", F.lit(0).cast("bigint"))
                    .alias("total_blips")))


def signals_by_box(blips: DataFrame, boxes: DataFrame, decimals: int = 5,
                   hot_rows: int = HOT_ROWS, list_rows: int = LIST_ROWS, **matching) -> DataFrame:
    """``box_signals`` for all boxes at once, with ``box_id``; the blips are matched one time."""
    columns = ["box_id", *KEYS, "time"]
    matched = settle(_matched(blips, boxes, decimals, hot_rows=hot_rows, **matching), "matched")
    rows = expand_copies(matched, columns, "copies")
    return signal_times(rows, columns[:-1], "time", hot_rows, list_rows)


def median_box(rows: DataFrame, half_width: float, keys: Sequence[str] = KEYS,
               box_id: str = "median") -> DataFrame:
    """One box centred on the median of each coordinate, ``half_width`` to each side.

    A coordinate without any value has unknown bounds, and such a box holds nothing. The
    coordinates are settled, since finding medians reads them several times.
    """
    middles = exact_medians(settle(rows.select(*keys), "median-box"), keys)
    bounds = [None if v is None else v + side
              for v in middles for side in (-half_width, half_width)]
    return rows.sparkSession.createDataFrame([(box_id, *bounds)], BOX_SCHEMA)


def median_boxes(rows: DataFrame, half_width: float, decimals: int = 0,
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """A box per signal, centred on the medians of its blips' coordinates, named by its position.

    A signal is a position rounded to ``decimals``; the medians are those of the coordinates as they
    are. All signals are searched at once, and none is gathered in one task.
    """
    marked = rows.select(*keys, *[bucket(F.col(k), decimals).alias(f"_{k}") for k in keys])
    middles = exact_medians_by(marked, [f"_{k}" for k in keys], keys)
    bounds = [(F.col(k) + side).alias(c) for k, pair in zip(keys, _BOUNDS.values())
              for c, side in zip(pair, (-half_width, half_width))]
    return middles.select(tuple_text([F.col(f"_{k}") for k in keys]).alias("box_id"), *bounds)
