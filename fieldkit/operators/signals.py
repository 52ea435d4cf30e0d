"""Repeating signals: blips counted per rounded position, their gaps and periods.

A blip table has ``ascension, declination, time, frequency``, all double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.functions.scalars import bucket
from fieldkit.functions.text import tuple_text
from fieldkit.operators.ordering import running_total
from fieldkit.operators.skew import HOT_ROWS, match_keys, sliced, split_hot
from fieldkit.session import settle

KEYS = ["frequency", "ascension", "declination"]
LIST_ROWS = 100_000


def bucket_blips(blips: DataFrame, decimals: int = 0) -> DataFrame:
    """Blips with their three coordinates rounded; a signal is one rounded position."""
    return blips.select(*[bucket(F.col(k), decimals).alias(k) for k in KEYS], "time")


def blip_counts(blips: DataFrame, decimals: int = 0) -> DataFrame:
    """Blips per signal."""
    return (bucket_blips(blips, decimals).groupBy(*KEYS)
            .agg(F.count(F.lit(1)).alias("blip_count")))


def signal_periods(blips: DataFrame, decimals: int = 0) -> DataFrame:
    """Blips and mean gap per signal; a signal of one blip has no period.

    The mean of consecutive gaps is (last - first) / (n - 1), so neither the list of times nor a
    sort is needed, and a very hot signal costs no more than any other.
    """
    span = F.max("time") - F.min("time")
    return (bucket_blips(blips, decimals).groupBy(*KEYS)
            .agg(F.count(F.lit(1)).alias("blip_count"),
                 F.when(F.count("time") > 1, span / F.nullif(F.count("time") - 1, F.lit(0)))
                 .alias("period")))


def _first(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("blip_count"), *KEYS).limit(1)


def top_signal(blips: DataFrame, decimals: int = 0) -> DataFrame:
    """The signal with most blips; among equals the one with the lowest key."""
    return _first(blip_counts(blips, decimals))


def top_signal_period(blips: DataFrame, decimals: int = 0) -> DataFrame:
    """The top signal with its mean gap, from one pass over the blips."""
    return _first(signal_periods(blips, decimals))


def signal_gaps(blips: DataFrame, decimals: int = 0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Gap of each blip to the one before it in the same signal."""
    return gaps(bucket_blips(blips, decimals), KEYS, "time", hot_rows)


def gaps(rows: DataFrame, keys: Sequence[str], order: str, hot_rows: int = HOT_ROWS,
         counts: DataFrame | None = None) -> DataFrame:
    """Difference of ``order`` to the row before it within ``keys``; a first row gives none.

    Keys with more than ``hot_rows`` rows are sorted over many tasks; the gaps inside a slice
    and the gaps from one slice to the next are found apart and put together.
    """
    rows = rows.select(*keys, order).filter(F.col(order).isNotNull())
    split = split_hot(rows, keys, hot_rows, counts)
    out = [*keys, order, "gap"]

    def inside(df: DataFrame, group: Sequence[str]) -> DataFrame:
        before = F.lag(order).over(Window.partitionBy(*group).orderBy(order))
        return (df.withColumn("gap", F.col(order) - before)
                .filter(F.col("gap").isNotNull()).select(*out))

    result = inside(split.cool, keys)
    if split.hot is None:
        return result
    slices = sliced(split.hot, keys, order)
    edges = (slices.groupBy(*keys, "slice")
             .agg(F.min(order).alias(order), F.max(order).alias("_last")))
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("slice"))
    between = (edges.withColumn("gap", F.col(order) - before)
               .filter(F.col("gap").isNotNull()).select(*out))
    return result.unionByName(inside(slices, [*keys, "slice"])).unionByName(between)


def top_signal_gaps(blips: DataFrame, decimals: int = 0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Gaps of the top signal only. The top signal is one settled row, so it is broadcast."""
    rows = bucket_blips(blips, decimals)
    counts = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("blip_count"))
    top = settle(_first(counts).withColumnRenamed("blip_count", "key_rows"), "top-signal")
    mine = match_keys(rows, F.broadcast(top), KEYS, "left_semi")
    return gaps(mine, KEYS, "time", hot_rows, top)


def ranked_counts(counts: DataFrame) -> DataFrame:
    """Counts in falling order with their rank; equal counts share a rank.

    A rank is one more than the number of signals with a larger count, which is a running sum over
    the table of different counts. Catalyst picks the join by that table's size. The counts are
    settled, so they are worked out once.
    """
    counts = settle(counts, "counts")
    sizes = counts.groupBy("blip_count").agg(F.count(F.lit(1)).alias("_signals"))
    falling = sizes.withColumn("_falling", -F.col("blip_count"))
    larger, _ = running_total(falling, ["_falling"], "_signals", "_larger")
    ranks = larger.select("blip_count", (F.col("_larger") + 1).alias("rank"))
    return (counts.join(ranks, "blip_count").select(*KEYS, "blip_count", "rank")
            .orderBy(F.desc("blip_count"), *KEYS))


def formatted_counts(counts: DataFrame) -> DataFrame:
    """Counts in falling order as lines such as ``(52.0, 3.0, 7.0): 19``."""
    line = F.concat(tuple_text([F.col(k) for k in KEYS]), F.lit(": "),
                    F.col("blip_count").cast("string"))
    return counts.orderBy(F.desc("blip_count"), *KEYS).select(line.alias("line"))


def signal_times(rows: DataFrame, keys: Sequence[str] = KEYS, order: str = "time",
                 hot_rows: int = HOT_ROWS, list_rows: int = LIST_ROWS) -> DataFrame:
    """Count and sorted times per key, as ``part, times, blip_count``.

    The sorted times of every key are cut into lists of ``list_rows``, the last one shorter, and
    ``part`` numbers them from 1. ``blip_count`` is that of the whole key. Null times count but are
    in no list; a key without times has one empty list. Keys with more than ``hot_rows`` rows are
    sorted over many tasks, which changes nothing in the result.
    """
    rows = rows.select(*keys, order)
    split = split_hot(rows, keys, hot_rows)
    out = [*keys, "part", "times", "blip_count"]
    size = F.lit(list_rows)
    cuts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size("_all") / size).cast("int") - 1, F.lit(0))),
        lambda i: F.slice("_all", i * size + 1, size))
    result = (split.cool.groupBy(*keys)
              .agg(F.sort_array(F.collect_list(order)).alias("_all"),
                   F.count(F.lit(1)).alias("blip_count"))
              .select(*keys, "blip_count", F.posexplode(cuts).alias("_part", "times"))
              .withColumn("part", F.col("_part").cast("bigint") + 1).select(*out))
    if split.hot is None:
        return result
    slices = sliced(split.hot.filter(F.col(order).isNotNull()), keys, order)
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    edges = slices.groupBy(*keys, "slice").agg(F.min("position").alias("_first"),
                                               F.count(F.lit(1)).alias("_rows"))
    starts = settle(edges.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))),
                    "slice-starts")
    place = F.col("_before") + F.col("position") - F.col("_first")
    lists = (match_keys(slices, starts, [*keys, "slice"], "inner")
             .groupBy(*keys, (F.floor(place / size) + 1).alias("part"))
             .agg(F.sort_array(F.collect_list(order)).alias("times")))
    whole = match_keys(split.hot_keys.withColumnRenamed("key_rows", "blip_count"), lists, keys, "left")
    return result.unionByName(whole.select(
        *keys, F.coalesce("part", F.lit(1).cast("bigint")).alias("part"),
        F.coalesce("times", F.array().cast(lists.schema["times"].dataType)).alias("times"), "blip_count"))
