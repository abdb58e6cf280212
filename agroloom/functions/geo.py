"""Great-circle distances."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    h = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0))
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    )
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def half_chord(km: float) -> float:
    """sin(d / 2R): grows with the distance and needs no inverse sine to compare."""
    return math.sin(km / (2 * EARTH_KM))


def box_bounds(a: tuple[Column, ...], b: tuple[Column, ...]) -> tuple[Column, Column]:
    """Lower and upper bound of the half chord from any point of one box to any point of another.

    A box is its least and greatest latitude, then longitude; longitudes lie in [0, 360) and no box crosses their ends.
    """
    zero, half_turn = F.lit(0.0), F.lit(180.0)
    (south_a, north_a, west_a, east_a), (south_b, north_b, west_b, east_b) = a, b
    near_lat = F.greatest(zero, south_b - north_a, south_a - north_b)
    far_lat = F.greatest(north_b - south_a, north_a - south_b)
    # longitudes wrap: take the shorter way round between the edges that face each other
    turn = [F.least(F.abs(d), 360 - F.abs(d)) for d in (west_b - east_a, west_a - east_b)]
    overlap = (west_a <= east_b) & (west_b <= east_a)
    near_lon = F.when(overlap, zero).otherwise(F.least(*turn))
    around = F.least(*turn) + (east_a - west_a) + (east_b - west_b)
    far_lon = F.least(half_turn, F.greatest(east_b - west_a, east_a - west_b), around)

    def cosines(south, north):
        ends = [F.greatest(zero, F.cos(F.radians(c))) for c in (south, north)]
        return F.least(*ends), F.when((south <= 0) & (north >= 0), F.lit(1.0)).otherwise(F.greatest(*ends))

    (low_a, high_a), (low_b, high_b) = cosines(south_a, north_a), cosines(south_b, north_b)

    def arc(dlat, dlon, c):
        p, q = F.sin(F.radians(dlat) / 2), F.sin(F.radians(dlon) / 2)
        return F.sqrt(p * p + c * q * q)

    return arc(near_lat, near_lon, low_a * low_b), arc(far_lat, far_lon, high_a * high_b)
