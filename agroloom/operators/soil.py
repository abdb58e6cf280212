"""Soil horizons to standard layers and header."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.functions.text import capitals
from agroloom.operators.merge import locate_points
from agroloom.operators.profile import drop_null_columns
from agroloom.operators.scale import null_safe_join


def format_soil(
    horizons: DataFrame,
    sites: DataFrame,
    mapping: list[dict],
    areas: DataFrame,
    key: str = "id",
    source: str = "ISRIC",
    year: int | None = None,
) -> dict[str, DataFrame]:
    """``SOL_Surface`` (one row per location) and ``SOL_Layers`` for all locations.

    ``mapping``: std_var, repo_var, conv_fct. ``sites``: key, site, trial_institution, lat, lon.
    ``areas``: country and ring, see :func:`locate_points`.
    """
    usable = [m for m in mapping if m["repo_var"] in horizons.columns]
    layers = horizons.select(
        key, *[(F.col(m["repo_var"]).try_cast("double") * F.lit(float(m["conv_fct"]))).alias(m["std_var"]) for m in usable]
    )
    layers = drop_null_columns(layers, keep=[key])
    depth = layers.groupBy(key).agg(F.max("SLB").alias("SOIL_DEPTH"))
    placed = locate_points(sites, areas, ["country"])
    made = F.lit(str(year)) if year else F.date_format(F.current_date(), "yyyy")
    header = null_safe_join(placed, depth, [key], "inner").select(
        key,
        F.concat(
            F.coalesce(F.substring(capitals(F.col("trial_institution")), 1, 2), F.lit("")),
            F.coalesce(F.substring(capitals(F.col("site")), 1, 2), F.lit("")),
            made,
            F.lpad(F.col(key).cast("string"), 2, "0"),
        ).alias("SOIL_ID"),
        F.lit(source).alias("SOIL_SOURCE"),
        capitals(F.col("site")).alias("SITE"),
        F.col("country").alias("COUNTRY"),
        F.lit("placeholder").alias("DESCRIPTION"),
        "SOIL_DEPTH",
        F.col("lat").alias("SOIL_LAT"),
        F.col("lon").alias("SOIL_LONG"),
        # fixed values: method codes of the model
        *[F.lit("IB001").alias(c) for c in ("SMHB", "SMPX", "SMKE")],
    )
    return {"SOL_Surface": header, "SOL_Layers": layers}
