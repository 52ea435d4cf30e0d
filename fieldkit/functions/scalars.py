"""Numeric column functions. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in km, the depot's position, the quarter turn of the edge profile.
EARTH_RADIUS_KM = 6371.0
SITE_LAT = 42.3736
SITE_LNG = -71.1097
QUARTER_TURN = 3.14159 / 2


# Names of cluster shapes.
POINT = "Point"
LINE = "Line"
FLAT = "Plane or Disk"
EVEN_SOLID = "Sphere or Cube/Cuboid"
UNEVEN_SOLID = "Ellipsoid or Rectangular Prism"
HIGHER = "Higher-dimensional shape"

# Fixed value: splits a double into two halves whose products are exact.
_SPLITTER = 134217729.0


def bucket(value: Column, decimals: int) -> Column:
    """Round to ``decimals`` (0 to 7) places: to the nearest, and exact halves to even.

    What counts as a half is the double's exact value, as in Python's ``round``: 2.675 lies below
    its tie and gives 2.67, where ``bround`` goes by the printed digits. Only double arithmetic is
    used, which is also cheaper per row than decimals. The scaled value can land on a half by its
    own rounding; then the part it lost, found exactly, tells the side. A negative zero comes out
    as 0.0, so equal keys also look the same.
    """
    if decimals == 0:
        return F.rint(value) + 0.0
    if not 0 < decimals <= 7:
        raise ValueError("decimals must be from 0 to 7")
    scale = F.lit(10.0 ** decimals)
    scaled = value * scale
    high = value * _SPLITTER - (value * _SPLITTER - value)
    lost = (high * scale - scaled) + (value - high) * scale
    below = F.floor(scaled)
    at_half = F.when(lost > 0, below + 1.0).when(lost < 0, below + 0.0).otherwise(F.rint(scaled))
    nearest = F.when(scaled - below == 0.5, at_half).otherwise(F.rint(scaled))
    return F.when(F.abs(scaled) < 2.0 ** 52, nearest / scale + 0.0).otherwise(value)


def great_circle_km(lat: Column, lng: Column, site_lat: float = SITE_LAT,
                    site_lng: float = SITE_LNG, method: str = "cosine") -> Column:
    """Distance in km from ``(lat, lng)`` in degrees to a fixed site.

    ``cosine`` is the spherical law of cosines with its argument held to [-1, 1], so a point on
    the site itself gives 0 and not NaN. ``haversine`` is more exact for short distances.
    """
    site_phi, site_lambda = F.radians(F.lit(site_lat)), F.radians(F.lit(site_lng))
    phi, lam = F.radians(lat), F.radians(lng)
    if method == "cosine":
        cosine = (F.sin(site_phi) * F.sin(phi)
                  + F.cos(site_phi) * F.cos(phi) * F.cos(lam - site_lambda))
        # greatest/least skip nulls, so a missing coordinate is kept out by hand
        held = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
        return F.when(cosine.isNotNull(), F.lit(EARTH_RADIUS_KM) * F.acos(held))
    if method == "haversine":
        half = (F.pow(F.sin((phi - site_phi) / 2), F.lit(2.0))
                + F.cos(site_phi) * F.cos(phi) * F.pow(F.sin((lam - site_lambda) / 2), F.lit(2.0)))
        held = F.least(F.lit(1.0), F.sqrt(half))
        return F.when(half.isNotNull(), F.lit(2 * EARTH_RADIUS_KM) * F.asin(held))
    raise ValueError(f"unknown method {method!r}")


def sine_profile(index: Column, length: int, peak: float = 100.0) -> Column:
    """Edge value of position ``index`` on an edge of ``length`` cells: a quarter sine wave."""
    return F.lit(peak) * F.sin(F.lit(QUARTER_TURN / length) * index)


def scale_array(values: Column, divisor: float = 255.0) -> Column:
    """Divide each element as a double, e.g. pixels into [0, 1]."""
    return F.transform(values, lambda x: x.cast("double") / F.lit(divisor))


def count_above(values: Column, threshold: float) -> Column:
    """How many elements are over ``threshold``; null for a null array."""
    kept = F.filter(values, lambda x: x.cast("double") > F.lit(threshold))
    return F.when(values.isNotNull(), F.size(kept))


def array_columns(values: Column, names: Sequence[str]) -> list[Column]:
    """One column per array element, meant for a single ``select``."""
    return [values.getItem(i).alias(name) for i, name in enumerate(names)]


def estimated_shape(dimensions: Column, ranges: Sequence[Column], rtol: float = 0.2,
                    atol: float = 1e-8) -> Column:
    """Name a cluster's shape from its count of primary dimensions and its first three ranges.

    A cluster with no measurable variance has a null count and is a "Point".
    """
    first = ranges[0]
    near_equal = F.lit(True)
    for other in ranges[1:3]:
        near_equal = near_equal & (F.abs(other - first) <= F.lit(atol) + F.lit(rtol) * F.abs(first))
    return (
        F.when(dimensions.isNull(), POINT)
        .when(dimensions == 1, LINE)
        .when(dimensions == 2, FLAT)
        .when((dimensions == 3) & near_equal, EVEN_SOLID)
        .when(dimensions == 3, UNEVEN_SOLID)
        .otherwise(HIGHER)
    )
