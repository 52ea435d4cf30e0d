"""Keys that hold too many rows for one task: found by count, then sorted over many tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.operators.ordering import settle_sorted
from fieldkit.session import settle

HOT_ROWS = 2_000_000
HOT_RIGHT = 10_000


class KeySplit(NamedTuple):
    """Rows of ordinary keys, rows of hot keys (None if there are none), and the hot keys."""

    cool: DataFrame
    hot: DataFrame | None
    hot_keys: DataFrame


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys``, where a null key equals a null key. The keys of ``left`` are kept."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = left.join(renamed, same, how)
    return joined.drop(*[f"_{k}" for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS,
              counts: DataFrame | None = None) -> KeySplit:
    """Separate the keys with more than ``hot_rows`` rows.

    The count combines on the map side, and at most ``rows / hot_rows`` keys can be hot. They
    are settled, so Catalyst sees their size and broadcasts them only where that is small.
    Settled ``counts`` (``keys, key_rows``) spare the pass where they are known.
    """
    if counts is None:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
        hot_keys = settle(counted.filter(F.col("key_rows") > hot_rows), "hot-keys")
    else:
        hot_keys = counts.filter(F.col("key_rows") > hot_rows)
    if hot_keys.isEmpty():
        return KeySplit(df, None, hot_keys)
    return KeySplit(match_keys(df, hot_keys, keys, "left_anti"),
                    match_keys(df, hot_keys, keys, "left_semi"), hot_keys)


def expand_copies(counted: DataFrame, columns: Sequence[str], copies: str,
                  chunk: int = 100_000) -> DataFrame:
    """One row per copy, numbered from 0 in ``copy``, from rows that stand for several.

    A row for more than ``chunk`` copies is first cut into chunks that are dealt out to tasks, so
    no task writes the whole group. ``counted`` is read twice and should be settled.
    """
    n, zero = F.col(copies), F.lit(0).cast("bigint")
    few = (counted.filter(n <= chunk)
           .select(*columns, F.explode(F.sequence(zero, n - 1)).alias("copy")))
    starts = F.sequence(zero, n - 1, F.lit(chunk).cast("bigint"))
    many = (counted.filter(n > chunk)
            .select(*columns, n.alias("_n"), F.explode(starts).alias("_from"))
            .repartition(*columns, "_from")
            .select(*columns, F.explode(F.sequence(
                F.col("_from"), F.least(F.col("_from") + chunk, F.col("_n")) - 1)).alias("copy")))
    return few.unionByName(many)


def number_copies(df: DataFrame, columns: Sequence[str], chunk: int = 100_000) -> DataFrame:
    """Equal rows told apart by a running ``copy`` number, whole groups of copies kept.

    Copies are counted before the shuffle.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return expand_copies(settle(counted, "copies"), columns, "_n", chunk)


def sliced(hot: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Hot rows sorted by key and ``order`` and cut into slices that each fit a task.

    Adds ``slice`` and ``position``; within a key, slices and positions follow ``order``.
    """
    rows = number_copies(hot.select(*keys, order), [*keys, order])
    return settle_sorted(rows, [*keys, order, "copy"])


def deal_salted(left: DataFrame, right: DataFrame, on: Sequence[str], hot_rows: int,
                hot_right: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with two columns more, and the columns to meet by; see ``salted_join`` for the cuts.

    Rows of keys that only one side has are left out. Equal rows are dealt alike, so they are not to be
    many. Keys are not null.
    """
    sizes = [side.groupBy(*on).agg(F.count(F.lit(1)).alias(n))
             for side, n in ((left, "_l"), (right, "_r"))]
    cuts = settle(sizes[0].join(sizes[1], list(on)).select(
        *on, F.ceil(F.col("_l") / hot_rows).alias("_ls"),
        F.ceil(F.col("_r") / hot_right).alias("_rs")), "cuts")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        salt = F.pmod(F.xxhash64(*side.columns), F.col(own))
        others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))
        return (side.join(cuts, list(on)).withColumn(f"{own}_no", salt)
                .withColumn(f"{other}_no", others).drop("_ls", "_rs"))

    return (dealt(left, "_ls", "_rs"), dealt(right, "_rs", "_ls"), [*on, "_ls_no", "_rs_no"])


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS,
                hot_right: int = HOT_RIGHT) -> DataFrame:
    """Inner equi join by shuffle in which a crowded key is dealt to many tasks on both sides.

    A key is cut into ``hot_rows`` rows of ``left`` and ``hot_right`` rows of ``right``, and each
    pair of cuts is a task's share; only such keys are salted, each by its own sizes. Both sides are
    read more than once and should be settled; rows of a side should differ from another, since the
    salt is a hash of the row.
    """
    sizes = [side.groupBy(*on).agg(F.count(F.lit(1)).alias(n))
             for side, n in ((left, "_l"), (right, "_r"))]
    salts = settle(match_keys(sizes[0], sizes[1], on, "inner").select(
        *on, F.ceil(F.col("_l") / hot_rows).alias("_ls"),
        F.ceil(F.col("_r") / hot_right).alias("_rs")).filter("_ls > 1 OR _rs > 1"), "salts")
    if salts.isEmpty():
        return left.join(right, list(on))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        salt = F.pmod(F.xxhash64(*side.columns), F.col(own))
        others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))
        return (match_keys(side, salts, on, "inner").withColumn(f"{own}_no", salt)
                .withColumn(f"{other}_no", others).drop("_ls", "_rs"))

    hot = dealt(left, "_ls", "_rs").join(dealt(right, "_rs", "_ls"), [*on, "_ls_no", "_rs_no"])
    cool = match_keys(left, salts.select(*on), on, "left_anti").join(right, list(on))
    return cool.unionByName(hot.drop("_ls_no", "_rs_no"))
