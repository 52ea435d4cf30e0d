"""Row position on distributed data, and what follows from it: pairing, splits and blocks."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkit.session import settle

# Layout of monotonically_increasing_id: partition number above 33 bits of row number.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


class Indexed(NamedTuple):
    """Rows with their position, and how many there are."""

    rows: DataFrame
    size: int


def settle_sorted(df: DataFrame, order: Sequence[str], slice_col: str = "slice",
                  position_col: str = "position") -> DataFrame:
    """Sort over all partitions and keep each row's partition number and place within it.

    The range sort splits the rows evenly whatever their distribution, as long as ``order``
    tells rows apart. Its bounds come from a sample, so the outcome is settled before use.
    """
    place = F.monotonically_increasing_id()
    ordered = df.orderBy(*order).withColumn("_place", place)
    return (settle(ordered, "sorted")
            .withColumn(slice_col, F.shiftright("_place", _ROW_BITS).cast("int"))
            .withColumn(position_col, F.col("_place").bitwiseAND(F.lit(_ROW_MASK)))
            .drop("_place"))


def with_row_index(df: DataFrame, order: Sequence[str], index: str = "row_idx") -> Indexed:
    """Number the rows 0, 1, 2, ... in the order of ``order``, which must identify a row.

    One range sort, then one offset per sorted partition is added; no window without a
    partition is needed. The offsets are one number per partition, so they are small.
    """
    ordered = settle_sorted(df, order, "_slice", "_position")
    sizes = (ordered.groupBy("_slice").agg((F.max("_position") + 1).alias("n"))
             .orderBy("_slice").collect())
    ends = list(accumulate(row["n"] for row in sizes))
    offsets = [(row["_slice"], end - row["n"]) for row, end in zip(sizes, ends)]
    starts = df.sparkSession.createDataFrame(offsets, "_slice int, _start bigint")
    rows = (ordered.join(F.broadcast(starts), "_slice")
            .withColumn(index, F.col("_start") + F.col("_position"))
            .drop("_slice", "_position", "_start"))
    return Indexed(rows, ends[-1] if ends else 0)


def running_total(df: DataFrame, order: Sequence[str], value: str,
                  column: str) -> tuple[DataFrame, int]:
    """Add the sum of ``value`` over the rows before each one, and give the sum over all rows.

    ``order`` must identify a row. One range sort; only one sum per sorted partition meets in one
    place, so no task sees all rows.
    """
    ordered = settle_sorted(df, order, "_slice", "_position")
    sums = ordered.groupBy("_slice").agg(F.sum(value).alias("n")).orderBy("_slice").collect()
    ends = list(accumulate(row["n"] for row in sums))
    starts = df.sparkSession.createDataFrame(
        [(row["_slice"], end - row["n"]) for row, end in zip(sums, ends)],
        "_slice int, _start_sum bigint")
    before = (Window.partitionBy("_slice").orderBy("_position")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (ordered.join(F.broadcast(starts), "_slice")
            .withColumn(column, F.col("_start_sum") + F.coalesce(F.sum(value).over(before), F.lit(0)))
            .drop("_slice", "_position", "_start_sum"))
    return rows, (ends[-1] if ends else 0)


def _with_offsets(rows: DataFrame, starts: DataFrame, place: Sequence[str], pieces: int,
                  few_pieces: int) -> DataFrame:
    """Add ``_before`` of the piece of a file that each row lies in, without moving the rows if it can be.

    A piece is named by a 64-bit hash, so an offset is 16 bytes and ``few_pieces`` of them go to all tasks.
    More pieces, or two of one name, are joined on the piece itself, as Catalyst chooses.
    """
    names = starts.select(F.xxhash64(*place).alias("_piece"), "_before")
    if pieces > few_pieces or names.select("_piece").distinct().count() < pieces:
        return rows.join(starts.select(*place, "_before"), list(place)).drop(*place)
    rows = rows.withColumn("_piece", F.xxhash64(*place)).drop(*place)
    return rows.join(F.broadcast(names), "_piece").drop("_piece")


def file_row_index(scan: DataFrame, index: str = "row_idx", few_pieces: int = 2_000_000) -> Indexed:
    """Number the rows of a direct file scan in the order they have in the files, without a sort.

    Spark may pack file splits into tasks in any order, but one task reads a split from front to
    back. So the rows are settled with their split and running number, and each split's offset is
    added, the sum of the sizes of the splits before it. The offsets of up to ``few_pieces`` splits
    are broadcast. Parquet needs no settled copy; see ``parquet_row_index``.
    """
    place = ["_file", "_start"]
    tagged = settle(scan.select(
        "*", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_within")), "file-rows")
    splits = tagged.groupBy(*place).agg(F.min("_within").alias("_first"),
                                        F.count(F.lit(1)).alias("_rows"))
    starts, size = running_total(splits, place, "_rows", "_before")
    # What is added to a running number: the rows before its split, less the split's first number.
    shifts = settle(starts.withColumn("_before", F.col("_before") - F.col("_first"))
                    .select(*place, "_before"), "file-offsets")
    rows = _with_offsets(tagged, shifts, place, shifts.count(), few_pieces)
    return Indexed(rows.withColumn(index, F.col("_before") + F.col("_within"))
                   .drop("_within", "_before"), size)


def parquet_row_index(scan: DataFrame, index: str = "row_idx",
                      few_pieces: int = 2_000_000) -> Indexed:
    """Number the rows of a direct Parquet scan by file path and place in the file.

    The scan itself knows a row's place, so nothing is sorted, copied or, up to ``few_pieces`` files,
    shuffled: a count per file, which reads no column, gives each file's offset. ``scan`` must be a plain
    read without filters. Rows of a table without files are none.
    """
    place = ["_file"]
    files = (scan.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file")
             .agg(F.count(F.lit(1)).alias("_rows")))
    starts, size = running_total(files, place, "_rows", "_before")
    offsets = settle(starts.select("_file", "_before"), "file-offsets")
    tagged = scan.select("*", F.col("_metadata.file_path").alias("_file"),
                         F.col("_metadata.row_index").alias("_within"))
    rows = _with_offsets(tagged, offsets, place, offsets.count(), few_pieces)
    return Indexed(rows.withColumn(index, F.col("_before") + F.col("_within"))
                   .drop("_within", "_before"), size)


def paired_rows(left: Indexed, right: Indexed, index: str = "row_idx") -> Indexed:
    """Join two tables row by row on their position; they must be equally long."""
    if left.size != right.size:
        raise ValueError(f"cannot pair {left.size} rows with {right.size}")
    return Indexed(left.rows.join(right.rows, index), left.size)


def tail_split(indexed: Indexed, held_out: float = 0.01, index: str = "row_idx",
               column: str = "part") -> DataFrame:
    """Label the last ``held_out`` share of the rows ``val`` and the others ``train``."""
    first = int(indexed.size * (1.0 - held_out))
    return indexed.rows.withColumn(
        column, F.when(F.col(index) >= F.lit(first), "val").otherwise("train"))


def block_of(index: Column, size: int, blocks: int) -> Column:
    """Block 1..``blocks`` of a position; the first ``size % blocks`` blocks hold one row more."""
    short, extra = divmod(size, blocks)
    border = extra * (short + 1)
    in_long = F.floor(index / F.lit(short + 1)) + 1
    if short == 0:
        return in_long.cast("int")
    in_short = F.floor((index - border) / F.lit(short)) + extra + 1
    return F.when(index < border, in_long).otherwise(in_short).cast("int")


def balanced_blocks(indexed: Indexed, blocks: int, index: str = "row_idx",
                    column: str = "block") -> DataFrame:
    """Split ordered rows into ``blocks`` runs whose sizes differ by at most one."""
    return indexed.rows.withColumn(column, block_of(F.col(index), indexed.size, blocks))


def block_halo(indexed: Indexed, blocks: int, index: str = "row_idx",
               column: str = "block") -> DataFrame:
    """Balanced blocks, each also given its neighbours' edge rows marked ``is_ghost``.

    A row is an edge where the row before or after it lies in another block. That follows from
    its own position, so the copies are made in place without a shuffle.
    """
    position = F.col(index)
    own = block_of(position, indexed.size, blocks)
    before = block_of(position - 1, indexed.size, blocks)
    after = block_of(position + 1, indexed.size, blocks)
    last = F.lit(indexed.size - 1)
    targets = F.array(
        F.struct(own.alias(column), F.lit(False).alias("is_ghost")),
        F.when((position > 0) & (before != own),
               F.struct(before.alias(column), F.lit(True).alias("is_ghost"))),
        F.when((position < last) & (after != own),
               F.struct(after.alias(column), F.lit(True).alias("is_ghost"))))
    return (indexed.rows.withColumn("_to", F.explode(F.array_compact(targets)))
            .select(*indexed.rows.columns, f"_to.{column}", "_to.is_ghost"))
