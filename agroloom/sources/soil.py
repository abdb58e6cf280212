"""Soil horizon tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.functions.text import split_parts
from agroloom.operators.scale import null_safe_join


def soil_horizons(raw: DataFrame, locations: DataFrame, key: str = "id") -> DataFrame:
    """Mean properties per horizon with its lower depth and the coordinates of the location."""
    upper, lower = split_parts(F.col("label"), "-", 2)
    depths = raw.withColumns({"updep": upper, "lodep": lower})
    located = null_safe_join(depths, locations.select(key, "lat", "lon"), [key])
    means = [c for c in raw.columns if "mean" in c]
    return located.select(key, "lon", "lat", "updep", "lodep", *[F.col(c).alias(c.replace("mean", "")) for c in means])


def locations_from(lat: list[float], lon: list[float]) -> list[tuple[str, float, float]]:
    """Numbered locations from two lists of equal length."""
    if len(lat) != len(lon):
        raise ValueError("latitudes and longitudes differ in number")
    return [(str(i + 1), float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))]
