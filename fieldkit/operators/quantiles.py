"""Exact medians of columns too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.operators.skew import match_keys
from fieldkit.session import settle

SMALL_ROWS = 100_000
CELLS = 1024
FEW_RANGES = 100_000


class _RankSearch:
    """Finds the value at one 0-based rank by narrowing an open range of values around it."""

    def __init__(self, column: str, rank: int, size: int) -> None:
        self.column, self.rank, self.size = column, rank, size
        self.low: float | None = None
        self.high: float | None = None
        self.value: float | None = None

    def inside(self) -> Column:
        """The column where it is in the range, null elsewhere."""
        value = F.col(self.column)
        held = value.isNotNull()
        if self.low is not None:
            held = held & (value > self.low)
        if self.high is not None:
            held = held & (value < self.high)
        return F.when(held, value)

    def fences(self, accuracy: int) -> Column:
        """Two values of the range that very likely enclose the rank."""
        at, slack = self.rank / self.size, 2.0 / accuracy
        return F.percentile_approx(
            self.inside(), [max(0.0, at - slack), min(1.0, at + slack)], accuracy)

    def census(self, low: float, high: float) -> Column:
        """Exact numbers of rows of the range below, at, between, at and above the fences."""
        value = self.inside()
        cuts = [value < low, value == low, (value > low) & (value < high),
                (value == high) & (value > low)]
        return F.array(*[F.count_if(cut) for cut in cuts])

    def narrow(self, low: float, high: float, census: list[int]) -> None:
        """Keep the part that holds the rank. It loses the fences, so every pass makes progress."""
        below, at_low, between, at_high = census
        if self.rank < below:
            self.high, self.size = low, below
        elif self.rank < below + at_low:
            self.value = low
        elif self.rank < below + at_low + between:
            self.low, self.high = low, high
            self.rank, self.size = self.rank - below - at_low, between
        elif self.rank < below + at_low + between + at_high:
            self.value = high
        else:
            passed = below + at_low + between + at_high
            self.low, self.rank, self.size = high, self.rank - passed, self.size - passed


def exact_medians(df: DataFrame, columns: Sequence[str], small_rows: int = SMALL_ROWS,
                  accuracy: int = 10_000) -> list[float | None]:
    """Median of each column, nulls left out; the mean of the middle two for an even count.

    The built-in exact median keeps every different value of a column in one task. Here each
    pass asks a bounded sketch for two values near the middle rank, then counts exactly how many
    rows lie around them; this leaves some thousandth of the rows per pass, for all columns
    together. Once at most ``small_rows`` are left, these are listed. The result is exact: the
    sketch only chooses where to count.
    """
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    searches = {c: [_RankSearch(c, rank, counts[c])
                    for rank in ((counts[c] - 1) // 2, counts[c] // 2)] if counts[c] else []
                for c in columns}
    everything = [s for pair in searches.values() for s in pair]
    while todo := [s for s in everything if s.value is None]:
        small = [s for s in todo if s.size <= small_rows]
        large = [s for s in todo if s.size > small_rows]
        probes = ([F.sort_array(F.collect_list(s.inside())) for s in small]
                  + [s.fences(accuracy) for s in large])
        found = list(df.agg(*[p.alias(str(i)) for i, p in enumerate(probes)]).first())
        for s, values in zip(small, found):
            s.value = values[s.rank]
        if large:
            fences = found[len(small):]
            census = df.agg(*[s.census(*f).alias(str(i))
                              for i, (s, f) in enumerate(zip(large, fences))]).first()
            for s, f, counted in zip(large, fences, census):
                s.narrow(*f, counted)
    return [(pair[0].value + pair[1].value) / 2 if pair else None for pair in searches.values()]


def exact_medians_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     cells: int = CELLS, few_ranges: int = FEW_RANGES) -> DataFrame:
    """``keys`` and the median of each column within them; the mean of the middle two for an even
    count, and null without values. Nulls are left out and NaN counts as a value above all others.

    All keys are searched at once. Different values are counted first. A round cuts the range that
    still holds a rank into ``cells`` equal ones, counts each, and keeps the values of the one that the
    rank falls into, from its smallest to its largest; a rank is found when these are the same. A key
    is never listed or sorted in one task: its values are combined within tasks, and what meets in
    one place is ``cells`` counts. The ranges go to all tasks while there are ``few_ranges`` of them,
    and are joined by shuffle beyond.
    """
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_of"), F.col(c).cast("double").alias("_v"))
                               for i, c in enumerate(columns)]))
    values = df.select(*keys, each.alias("_p")).select(*keys, "_p._of", "_p._v")
    counted = settle(values.groupBy(*keys, "_of", "_v").agg(F.count(F.lit(1)).alias("_n")), "values")
    group = [*keys, "_of"]
    known = counted.filter("_v IS NOT NULL")
    sides = known.groupBy(*group).agg(F.sum("_n").alias("_all"), F.min("_v").alias("_low"),
                                      F.max("_v").alias("_high"))
    ranks = F.array_distinct(F.array(F.expr("(_all - 1) div 2"), F.expr("_all div 2")))
    todo = settle(sides.withColumn("_rank", F.explode(ranks)).withColumn("_first", F.col("_rank"))
                  .select(*group, "_first", "_rank", "_low", "_high"), "ranks")
    found = []
    while True:
        found.append(todo.filter("_low = _high").select(*group, F.col("_low").alias("_value")))
        todo = todo.filter("_low <> _high")
        if todo.isEmpty():
            break
        ranges = settle(todo.select(*group, "_low", "_high").distinct(), "ranges")
        asked = F.broadcast(ranges) if ranges.count() <= few_ranges else ranges
        inside = match_keys(known, asked, group, "inner").filter(
            (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
        # Halves, since the width of a range of doubles may be no double itself.
        share = ((F.col("_v") / 2 - F.col("_low") / 2)
                 / F.nullif(F.col("_high") / 2 - F.col("_low") / 2, F.lit(0.0)))
        cell = F.when(F.col("_v") == F.col("_high"), cells).otherwise(
            F.least(F.floor(F.coalesce(F.nanvl(share, F.lit(0.0)), F.lit(0.0)) * cells),
                    F.lit(cells - 1))).cast("int")
        cut = inside.groupBy(*group, "_low", "_high", cell.alias("_cell")).agg(
            F.sum("_n").alias("_held"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        before = (Window.partitionBy(*group, "_low", "_high").orderBy("_cell")
                  .rowsBetween(Window.unboundedPreceding, -1))
        placed = cut.withColumn("_before", F.coalesce(F.sum("_held").over(before), F.lit(0)))
        hit = match_keys(todo, placed, [*group, "_low", "_high"], "inner").filter(
            (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_held")))
        todo = settle(hit.select(*group, "_first", (F.col("_rank") - F.col("_before")).alias("_rank"),
                                 F.col("_least").alias("_low"), F.col("_most").alias("_high")), "ranks")
        # Later rounds read only the values that a range still holds.
        held = todo.filter("_low <> _high").select(*group, "_low", "_high").distinct()
        known = settle(match_keys(known, held, group, "inner").filter(
            (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
            .select(*group, "_v", "_n").distinct(), "held-values")
    middles = reduce(DataFrame.unionByName, found).groupBy(*group).agg(F.avg("_value").alias("_value"))
    wide = middles.groupBy(*keys).agg(*[F.max(F.when(F.col("_of") == i, F.col("_value"))).alias(c)
                                        for i, c in enumerate(columns)])
    named = [c for c in columns if c in keys]
    if named:
        raise ValueError(f"{named} cannot be a key and a value")
    return match_keys(counted.select(*keys).distinct(), wide, keys, "left").select(*keys, *columns)
