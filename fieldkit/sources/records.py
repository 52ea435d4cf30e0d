"""Files of records of one length, such as labelled images of a byte per pixel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str, length: int,
                 split_bytes: int | None = None) -> DataFrame:
    """``record binary``: each ``length`` bytes of a file, or of the files of a folder.

    Files are cut into ranges at records, so one large file is read by many tasks; ``split_bytes`` bounds a
    range. Records stay in the JVM. A file whose size is no multiple of ``length`` fails the job that
    reads it; files with a header are not read.
    """
    if length < 1:
        raise ValueError("a record has at least one byte")
    context, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm
    settings = jvm.org.apache.hadoop.conf.Configuration(context.hadoopConfiguration())
    if split_bytes is not None:
        settings.set("mapreduce.input.fileinputformat.split.maxsize", str(max(split_bytes, length)))
    records = context.binaryRecords(path, length, settings)
    frame = spark._jsparkSession.createDataset(records, jvm.org.apache.spark.sql.Encoders.BINARY())
    return DataFrame(frame.toDF(), spark).toDF("record")


def bytes_of(record: Column, first: int, count: int) -> Column:
    """``count`` bytes from the ``first`` (1-based) on, as numbers from 0 to 255."""
    if count < 1:
        return F.array().cast("array<int>")
    return F.transform(F.sequence(F.lit(first), F.lit(first + count - 1)), lambda k: F.conv(
        F.hex(F.substring(record, k, F.lit(1))), 16, 10).cast("int"))


def read_image_records(spark: SparkSession, path: str, pixels: int, padding: int = 0,
                       split_bytes: int | None = None) -> DataFrame:
    """``label int, pixels array<int>`` from records of a label byte, the pixels, and unused bytes."""
    records = read_records(spark, path, 1 + pixels + padding, split_bytes)
    return records.select(F.element_at(bytes_of(F.col("record"), 1, 1), 1).alias("label"),
                          bytes_of(F.col("record"), 2, pixels).alias("pixels"))
