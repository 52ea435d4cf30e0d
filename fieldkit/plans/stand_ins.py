"""The inputs of the operators, derived from the provided tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber",
                 "l_partkey"]


@dataclass(frozen=True)
class Query:
    """A query on a folder of tables, and SQL for the same result where SQL can give it."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One provided table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def blips(spark: SparkSession, folder: str, frequency: str = "price") -> DataFrame:
    """Line items as blips; ``frequency`` is the price in thousands or the quantity."""
    items = table(spark, folder, "lineitem")
    heights = {"price": F.col("l_extendedprice") / 1000, "quantity": F.col("l_quantity")}
    return items.select(
        (F.col("l_discount") * 100).alias("ascension"),
        (F.col("l_tax") * 100).alias("declination"),
        F.datediff(F.col("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("double")
        .alias("time"),
        heights[frequency].alias("frequency"))


def blips_sql(frequency: str = "price") -> str:
    """The same blips in SQL, as a ``WITH`` member named ``blips``."""
    heights = {"price": "l_extendedprice/1000", "quantity": "l_quantity"}
    return f"""blips AS (SELECT l_discount*100 AS ascension, l_tax*100 AS declination,
      CAST(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS DOUBLE) AS time,
      {heights[frequency]} AS frequency FROM lineitem)"""


def rounded_sql(decimals: int, frequency: str = "price") -> str:
    """Blips with rounded coordinates, as ``WITH`` members ``blips`` and ``k``."""
    keys = ", ".join(f"round_even({k}, {decimals}) AS {k}"
                     for k in ("frequency", "ascension", "declination"))
    return f"{blips_sql(frequency)}, k AS (SELECT {keys}, time FROM blips)"


def zips(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as postal codes on a line through the site; nation 12 is the site itself."""
    step = F.col("n_nationkey") - 12
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("Zip"),
        (F.lit(42.3736) + F.lit(0.1) * step).alias("Lat"),
        (F.lit(-71.1097) + F.lit(0.12) * step).alias("Lng"))


ZIPS_SQL = """zips AS (SELECT n_nationkey AS zip,
  42.3736::DOUBLE + 0.1::DOUBLE*(n_nationkey-12) AS lat,
  -71.1097::DOUBLE + 0.12::DOUBLE*(n_nationkey-12) AS lng FROM nation)"""


def points(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as points in six dimensions, all double, with their return flag."""
    return table(spark, folder, "lineitem").select(
        *[F.col(c).cast("double").alias(c) for c in POINT_COLUMNS],
        F.col("l_returnflag").alias("label"))


POINTS_SQL = ("points AS (SELECT "
              + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in POINT_COLUMNS)
              + ", l_returnflag AS label FROM lineitem)")


BLOB_COLUMNS = [f"x{i}" for i in range(6)]
# Where the three groups of points lie.
_BLOB_CENTRES = {"A": [0, 0, 0, 0, 0, 0], "N": [100, 200, 0, 100, 200, 0],
                 "R": [200, 0, 100, 200, 0, 100]}
# What brings each point column to a width of about ten. The odd ones keep ranges off
# decimal ties, which SQL rounds by the scaled value and not by the exact one.
_BLOB_WIDTHS = [5, 9973, 0.01, 0.01, 1, 307]


def blobs(spark: SparkSession, folder: str) -> DataFrame:
    """The same points moved apart by return flag, so the best clustering is that of the flags."""
    flag = F.col("label")
    columns = []
    for i, (source, width) in enumerate(zip(POINT_COLUMNS, _BLOB_WIDTHS)):
        centre = F.lit(None).cast("double")
        for name, place in _BLOB_CENTRES.items():
            centre = F.when(flag == name, F.lit(float(place[i]))).otherwise(centre)
        columns.append((centre + F.col(source) / F.lit(float(width))).alias(BLOB_COLUMNS[i]))
    return points(spark, folder).select(*columns, "label")


def blobs_sql() -> str:
    """The same points in SQL, as ``WITH`` members ``points`` and ``blobs``."""
    columns = []
    for i, (source, width) in enumerate(zip(POINT_COLUMNS, _BLOB_WIDTHS)):
        cases = " ".join(f"WHEN '{name}' THEN {place[i]}.0::DOUBLE"
                         for name, place in _BLOB_CENTRES.items())
        columns.append(f"CASE label {cases} END + {source}/{float(width)}::DOUBLE"
                       f" AS {BLOB_COLUMNS[i]}")
    return f"{POINTS_SQL}, blobs AS (SELECT {', '.join(columns)}, label FROM points)"


def grid(spark: SparkSession, folder: str, value: str = "l_extendedprice") -> DataFrame:
    """Mean of a line item column per cell of discount and tax."""
    return (table(spark, folder, "lineitem")
            .groupBy(F.rint(F.col("l_discount") * 100).cast("bigint").alias("i"),
                     F.rint(F.col("l_tax") * 100).cast("bigint").alias("j"))
            .agg(F.avg(value).alias("v")))


def grid_sql(value: str = "l_extendedprice", name: str = "grid") -> str:
    """The same grid in SQL, as a ``WITH`` member."""
    return f"""{name} AS (SELECT CAST(round_even(l_discount*100, 0) AS BIGINT) AS i,
      CAST(round_even(l_tax*100, 0) AS BIGINT) AS j, avg({value}) AS v
      FROM lineitem GROUP BY ALL)"""


def experiments(spark: SparkSession, folder: str, status: str | None = None) -> DataFrame:
    """Line items as results of a grid of runs, the score being a mean price.

    Each status is a run of its own; without one, both come with their ``run``. The divisor keeps
    scores off decimal ties.
    """
    items = table(spark, folder, "lineitem")
    if status is not None:
        items = items.filter(F.col("l_linestatus") == status)
    run = [F.col("l_linestatus").alias("run")] if status is None else []
    return (items.groupBy(*run, F.col("l_discount").alias("Dropout1"), F.col("l_tax").alias("Dropout2"),
                          (F.col("l_quantity") / 1000).alias("Learning Rate"),
                          F.col("l_linenumber").alias("Batch Size"),
                          F.year("l_shipdate").alias("Epochs"))
            .agg((F.avg("l_extendedprice") / 199999).alias("Test Accuracy")))


def experiments_sql(name: str, status: str | None = None) -> str:
    """The same results in SQL, as a ``WITH`` member."""
    chosen = "" if status is None else f"WHERE l_linestatus = '{status}'"
    return f"""{name} AS (SELECT {"l_linestatus AS run, " if status is None else ""}l_discount AS "Dropout1", l_tax AS "Dropout2",
      l_quantity/1000 AS "Learning Rate", l_linenumber AS "Batch Size",
      CAST(year(l_shipdate) AS INTEGER) AS "Epochs", avg(l_extendedprice)/199999 AS "Test Accuracy"
      FROM lineitem {chosen} GROUP BY ALL)"""
