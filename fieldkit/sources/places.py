"""Where in their files the lines lie that do not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.functions.text import is_clean, number, parse_numbers, tokens
from fieldkit.operators.ordering import running_total
from fieldkit.session import settle
from fieldkit.sources.readers import BLIP_COLUMNS


def is_point(width: int, line: str = "value") -> Column:
    """Whether a line gives a point of ``width`` numbers."""
    return is_clean(parse_numbers(F.col(line)), width)


def is_blip(line: str = "value") -> Column:
    """Whether a line gives a blip."""
    return is_clean(F.transform(tokens(F.col(line)), number), len(BLIP_COLUMNS))


def reject_places(scan: DataFrame, good: Column, line: str = "value") -> DataFrame:
    """``file, line, row, range_start, range_length, value`` of each line that is not ``good``.

    ``line`` counts from 1 in its file, ``row`` over all files in the order of their paths; the range is the
    split of the file, in bytes, whose task reads the line. ``scan`` is a plain ``spark.read.text``. A
    test that gives null is failed. Empty lines count like others; no lines give no rows.

    Lines are parsed once. What is settled is a running number per line and the text of rejects alone;
    a count per split and the sum of those before it turn the running number into a place, so nothing is
    sorted but the splits.
    """
    split = ["_file", "_start"]
    bad = ~F.coalesce(good, F.lit(False))
    read = settle(scan.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_block_length").alias("range_length"),
        F.monotonically_increasing_id().alias("_within"), bad.alias("_bad"), F.col(line).alias("value"))
        .withColumn("value", F.when(F.col("_bad"), F.col("value"))), "line-places")
    splits = read.groupBy(*split).agg(F.min("_within").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    starts = settle(running_total(splits, split, "_rows", "_before")[0], "split-places")
    files = starts.groupBy("_file").agg(F.min("_before").alias("_file_before"))
    shifts = starts.join(files, "_file").drop("_rows")
    row = F.col("_before") + F.col("_within") - F.col("_first") + 1
    return read.filter("_bad").join(shifts, split).select(
        F.col("_file").alias("file"), (row - F.col("_file_before")).alias("line"), row.alias("row"),
        F.col("_start").alias("range_start"), "range_length", "value")
