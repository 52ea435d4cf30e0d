"""Choosing sites: orders per postal code within reach of a depot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkit.functions.scalars import SITE_LAT, SITE_LNG, great_circle_km
from fieldkit.session import settle

# A customer's id and postal code take some 40 bytes, so this is a broadcast of some 20 MB.
FEW_CUSTOMERS = 500_000


def orders_near(orders: DataFrame, customers: DataFrame, zips: DataFrame,
                radius_km: float = 100.0, site_lat: float = SITE_LAT,
                site_lng: float = SITE_LNG, few_customers: int = FEW_CUSTOMERS) -> DataFrame:
    """Orders per ``zip_code, latitude, longitude`` within ``radius_km`` of the site.

    Takes ``orders(OrderId, CustomerId)``, ``customers(CustomerId, PostalCode)`` and
    ``zips(Zip, Lat, Lng)``. Customers in reach are found first. If there are few of them, orders
    meet them by broadcast and are never shuffled. Beyond that, orders are counted per customer
    before the join, with map-side combining, so a customer with a large share of the orders is
    one row when it is shuffled. Places are joined to counts per postal code. A zip listed twice at
    the same place counts its orders twice, as a plain join would.
    """
    near = (zips.withColumn("distance_km", great_circle_km(F.col("Lat"), F.col("Lng"),
                                                           site_lat, site_lng))
            .filter(F.col("distance_km") <= radius_km)
            .groupBy("Zip", "Lat", "Lng", "distance_km")
            .agg(F.count(F.lit(1)).alias("_listed")))
    in_reach = settle(customers.join(near.select(F.col("Zip").alias("PostalCode")).distinct(),
                                     "PostalCode", "left_semi"), "in-reach")
    if in_reach.count() <= few_customers:
        met = orders.join(F.broadcast(in_reach), "CustomerId").withColumn(
            "_orders", F.when(F.col("OrderId").isNotNull(), 1).otherwise(0))
    else:
        met = in_reach.join(
            orders.groupBy("CustomerId").agg(F.count("OrderId").alias("_orders")), "CustomerId")
    per_zip = met.groupBy("PostalCode").agg(F.sum("_orders").alias("_orders"))
    return (per_zip.join(near, per_zip["PostalCode"] == near["Zip"])
            .select(F.col("PostalCode").alias("zip_code"), F.col("Lat").alias("latitude"),
                    F.col("Lng").alias("longitude"),
                    (F.col("_orders") * F.col("_listed")).alias("order_count"), "distance_km"))


def drone_sites(orders: DataFrame, customers: DataFrame, zips: DataFrame, top: int = 3,
                radius_km: float = 100.0, site_lat: float = SITE_LAT,
                site_lng: float = SITE_LNG) -> DataFrame:
    """The ``top`` places in reach with most orders; equal counts go by zip code and position."""
    return (orders_near(orders, customers, zips, radius_km, site_lat, site_lng)
            .orderBy(F.desc("order_count"), "zip_code", "latitude", "longitude").limit(top))
