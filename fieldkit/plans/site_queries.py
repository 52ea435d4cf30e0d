"""Distances and site selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldkit.functions.scalars import great_circle_km
from fieldkit.operators.sites import drone_sites, orders_near
from fieldkit.plans.stand_ins import ZIPS_SQL, Query, table, zips


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("OrderId"), F.col("o_custkey").alias("CustomerId"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("CustomerId"), F.col("c_nationkey").alias("PostalCode"))
    return orders, customers, zips(spark, folder)


def _distances(spark: SparkSession, folder: str) -> DataFrame:
    """Both formulas for customers placed by nation and balance."""
    lat = F.lit(42.3736) + F.col("c_acctbal") / 2000
    lng = F.lit(-71.1097) + F.lit(0.12) * (F.col("c_nationkey") - 12)
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.round(great_circle_km(lat, lng), 3).alias("cosine_km"),
        F.round(great_circle_km(lat, lng, method="haversine"), 3).alias("haversine_km"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_km", F.round("distance_km", 3))


_COSINE = """6371 * acos(least(1.0::DOUBLE, greatest(-1.0::DOUBLE,
  cos(radians(42.3736::DOUBLE)) * cos(radians(lat)) * cos(radians(lng) - radians(-71.1097::DOUBLE))
  + sin(radians(42.3736::DOUBLE)) * sin(radians(lat)))))"""
_HAVERSINE = """2 * 6371 * asin(sqrt(sin((radians(lat) - radians(42.3736::DOUBLE))/2)**2
  + cos(radians(42.3736::DOUBLE)) * cos(radians(lat))
  * sin((radians(lng) - radians(-71.1097::DOUBLE))/2)**2))"""
_NEAR_SQL = f"""SELECT c_nationkey AS zip_code, lat AS latitude, lng AS longitude,
  COUNT(o_orderkey) AS order_count, round({_COSINE}, 3) AS distance_km
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN zips ON c_nationkey = zip
  GROUP BY c_nationkey, lat, lng HAVING {_COSINE} <= 100"""

QUERIES = {
    "great_circle": Query(
        _distances,
        f"""WITH placed AS (SELECT c_custkey, 42.3736::DOUBLE + c_acctbal/2000 AS lat,
        -71.1097::DOUBLE + 0.12::DOUBLE*(c_nationkey-12) AS lng FROM customer)
        SELECT c_custkey, round({_COSINE}, 3) AS cosine_km,
        round({_HAVERSINE}, 3) AS haversine_km FROM placed"""),
    "orders_near": Query(
        lambda s, d: _rounded(orders_near(*_tables(s, d))),
        f"WITH {ZIPS_SQL} {_NEAR_SQL}"),
    "drone_sites": Query(
        lambda s, d: _rounded(drone_sites(*_tables(s, d))),
        f"WITH {ZIPS_SQL} {_NEAR_SQL} ORDER BY order_count DESC, zip_code LIMIT 3"),
}
