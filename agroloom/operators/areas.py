"""Points in polygons: outlines with several parts and holes, also across the date line.

Each outline is covered by cells of a size that fits its extent. Cells that no segment touches are inside or outside as a whole;
only points in cells on the edge are tested against the outline, and there against the segments of their band of latitude alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroloom.operators.scale import null_safe_join
from agroloom.session import checkpointed, written

CELLS = 64  # cells across the larger extent of an outline
SMALLEST, LARGEST = -6, 2  # powers of two, in degrees, of the cell sizes


def _crosses(lon: Column, lat: Column, a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Whether a ray to the east from a point meets the segment a-b (1 or 0)."""
    spans = (a[1] > lat) != (b[1] > lat)
    cross = (b[0] - a[0]) * (lat - a[1]) / F.nullif(b[1] - a[1], F.lit(0.0)) + a[0]
    return F.when(spans & (lon < cross), 1).otherwise(0)


def inside_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd test of a point against a closed ring (array of struct lon, lat)."""

    def step(count: Column, i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i + 1)
        return count + _crosses(lon, lat, (a["lon"], a["lat"]), (b["lon"], b["lat"]))

    return F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), F.lit(0), step) % 2 == 1


def _inside(lon: Column, lat: Column, segments: Column) -> Column:
    met = F.aggregate(segments, F.lit(0), lambda n, s: n + _crosses(lon, lat, (s["x1"], s["y1"]), (s["x2"], s["y2"])))
    return met % 2 == 1


def _around(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def outline_segments(areas: DataFrame) -> DataFrame:
    """Segments (id, x1, y1, x2, y2) of the rings, and the extent of each outline (w, h).

    A ring runs on beyond 180 degrees where two of its points lie more than half the globe apart, and is laid down again one turn
    to the west or east, so that every point meets it at its own longitude. A ring around a pole is not supported.
    """
    points = areas.select("id", F.posexplode("rings").alias("r", "ring")).select("id", "r", F.posexplode("ring").alias("i", "p"))
    along = Window.partitionBy("id", "r").orderBy("i")
    lon = F.col("p.lon").cast("double")
    step = lon - F.lag(lon).over(along)
    points = points.withColumn("jump", F.when(step > 180, -360.0).when(step < -180, 360.0).otherwise(0.0))
    points = points.select("id", "r", "i", (lon + F.sum("jump").over(along)).alias("x1"), F.col("p.lat").cast("double").alias("y1"))
    ring = Window.partitionBy("id", "r")
    points = points.withColumns(
        {"x2": F.lead("x1").over(along), "y2": F.lead("y1").over(along), "low": F.min("x1").over(ring), "high": F.max("x1").over(ring)}
    )
    turns = F.filter(F.array(*[F.lit(t) for t in (-360.0, 0.0, 360.0)]), lambda t: (F.col("low") + t < 180) & (F.col("high") + t >= -180))
    laid = points.filter("x2 IS NOT NULL").withColumn("turn", F.explode(turns))
    return laid.select("id", (F.col("x1") + F.col("turn")).alias("x1"), "y1", (F.col("x2") + F.col("turn")).alias("x2"), "y2")


def cell_cover(areas: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cells of each outline (id, size, cy, cx, inside), its segments by band (id, size, cy, segments) and its extent (id, area).

    ``inside`` is null for a cell on the edge. A band holds the segments that reach into it: as many as the outline has there. Both are
    written to the shared folder, as the points are looked up in them several times.
    """
    lines = checkpointed(outline_segments(areas))
    y = F.array_sort(F.array("y1", "y2"))
    box = lines.groupBy("id").agg(
        (F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2"))).alias("w"), (F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("h")
    )
    # copies of a ring lie a turn apart and don't count as extent
    box = box.withColumn("w", F.pmod("w", F.lit(360.0)))
    extent = F.greatest("w", "h", F.lit(1e-9))
    power = F.least(F.greatest(F.ceil(F.log2(extent / CELLS)), F.lit(SMALLEST)), F.lit(LARGEST))
    sized = null_safe_join(lines, box.select("id", F.pow(F.lit(2.0), power).alias("size")), ["id"])
    banded = sized.withColumns({"y_lo": y[0], "y_hi": y[1]}).withColumn(
        "cy", F.explode(F.sequence(F.floor(F.col("y_lo") / F.col("size")), F.floor(F.col("y_hi") / F.col("size"))))
    )
    segments = written(banded.groupBy("id", "size", "cy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("segments")), "segments")

    def x_at(lat: Column) -> Column:
        return F.col("x1") + (lat - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))

    low, high = x_at(F.greatest("y_lo", F.col("cy") * F.col("size"))), x_at(F.least("y_hi", (F.col("cy") + 1) * F.col("size")))
    # a little wider than the segment, against rounding
    first = F.floor((F.coalesce(F.least(low, high), F.least("x1", "x2")) - 1e-9) / F.col("size"))
    last = F.floor((F.coalesce(F.greatest(low, high), F.greatest("x1", "x2")) + 1e-9) / F.col("size"))
    edges = checkpointed(banded.select("id", "size", "cy", F.explode(F.sequence(first, last)).alias("cx")).distinct())
    rows = edges.groupBy("id", "size", "cy").agg(F.collect_list("cx").alias("on_edge"))
    between = F.array_except(F.sequence(F.array_min("on_edge"), F.array_max("on_edge")), F.col("on_edge"))
    free = null_safe_join(rows, segments, ["id", "size", "cy"]).withColumn("cx", F.explode(between))
    middle = ((F.col("cx") + 0.5) * F.col("size"), (F.col("cy") + 0.5) * F.col("size"))
    whole = free.filter(_inside(*middle, F.col("segments"))).select("id", "size", "cy", "cx", F.lit(True).alias("inside"))
    cells = written(edges.withColumn("inside", F.lit(None).cast("boolean")).unionByName(whole), "cells")
    return cells, segments, box.select("id", (F.col("w") * F.col("h")).alias("__area"))


def locate_points(points: DataFrame, areas: DataFrame, columns: list[str], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Attributes of the area that holds each point.

    ``areas`` has ``rings`` (closed, arrays of struct lon, lat: parts and holes in any order, by the even-odd rule) or one ``ring``. Both
    sides meet on cells; of several areas the one with the smallest extent wins. Equal coordinates are looked up once.
    """
    named = areas if "rings" in areas.columns else areas.withColumn("rings", F.array("ring"))
    named = named.withColumn("id", F.xxhash64("rings"))
    outlines = named.select("id", "rings").dropDuplicates(["id"])
    cover, segments, extents = cell_cover(outlines)
    facts = null_safe_join(named.select("id", *columns), extents, ["id"])
    # nine powers of two at most
    sizes = sorted(r["size"] for r in cover.select("size").distinct().collect())
    spots = points.select(lon, lat).distinct().withColumn("__x", _around(F.col(lon).cast("double")))
    placed = spots.withColumn("size", F.explode(F.array(*[F.lit(x) for x in sizes]).cast("array<double>")))
    placed = placed.withColumns({"cx": F.floor(F.col("__x") / F.col("size")), "cy": F.floor(F.col(lat) / F.col("size"))})
    met = null_safe_join(placed, cover, ["size", "cy", "cx"], "inner")
    met = null_safe_join(met, segments, ["id", "size", "cy"])
    held = met.filter(F.coalesce(F.col("inside"), _inside(F.col("__x"), F.col(lat), F.col("segments"))))
    hits = null_safe_join(held.select(lon, lat, "id"), facts, ["id"], "inner")
    best = hits.groupBy(lon, lat).agg(F.min(F.struct("__area", *columns)).alias("b"))
    return null_safe_join(points, best.select(lon, lat, *[F.col("b")[c].alias(c) for c in columns]), [lon, lat])
