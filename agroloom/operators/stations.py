"""Stations near a site: all within a radius, or the nearest few that qualify.

Nothing here pairs every site with every station. Points meet on grid cells. The nearest search
packs neighbouring sites and narrows the station cells of a pack step by step, so a pack keeps a
handful of candidates however many stations crowd one place, and only packs are shuffled on the way.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroloom.functions.geo import EARTH_KM, box_bounds, half_chord, haversine_km
from agroloom.operators.scale import null_safe_join
from agroloom.session import written

LEAF_POINTS = 32  # station points a cell may hold before it is divided
PACK_SPOTS = 64  # the same for the places of sites; a pack is one row
PACK_POINTS = 512  # station points compared with a pack at a time, about
BOX = ["__lat0", "__lat1", "__lon0", "__lon1"]  # extent of a cell
SIDES = ["__south", "__north", "__west", "__east"]  # extent of a pack
MAX_DEPTH = 10  # a 50 km cell is then some centimetres wide
SPLIT = 4  # a cell side is cut in four, so a child is named by one hex digit
EPS = 2e-6 / (2 * EARTH_KM)  # two millimetres, as a half chord


def _step(radius_km: float) -> float:
    """Band height in degrees, slightly more than the radius."""
    return radius_km / 111.0


def _lon_step(band: Column, step: float) -> Column:
    """Cell width in degrees: the radius, seen from any point of the band or the next one,
    spans at most this difference in longitude. Polar bands are one cell."""
    edge = F.greatest(F.abs(band * step), F.abs((band + 1) * step)) + step
    half = math.sin(math.radians(step) / 2)
    ratio = F.lit(half) / F.cos(F.radians(F.least(edge, F.lit(89.0))))
    wide = F.lit(2 * 1.001) * F.degrees(F.asin(F.least(ratio, F.lit(1.0))))
    return F.when((edge >= 89) | (ratio >= 1), F.lit(360.0)).otherwise(F.least(wide, F.lit(360.0)))


def _home_cell(lat: Column, lon: Column, step: float) -> tuple[Column, Column]:
    band = F.floor(lat / step)
    return band, F.floor(F.pmod(lon, F.lit(360.0)) / _lon_step(band, step))


def _around(sites: DataFrame, step: float, lat: str = "lat", west: str = "lon", east: str = "lon") -> DataFrame:
    """Each site once for every grid cell the radius can reach: nine, some more at the date line.

    A site may also be a box within one cell, from ``west`` to ``east``.
    """
    rows = sites.withColumn("__band", F.explode(F.sequence(F.floor(F.col(lat) / step) - 1, F.floor(F.col(lat) / step) + 1)))
    rows = rows.withColumn("__w", _lon_step(F.col("__band"), step))
    rows = rows.withColumns(
        {
            "__n": F.ceil(F.lit(360.0) / F.col("__w")),
            "__first": F.floor(F.pmod(F.col(west), F.lit(360.0)) / F.col("__w")),
            "__last": F.floor(F.pmod(F.col(east), F.lit(360.0)) / F.col("__w")),
        }
    )
    # the last cell before the wrap is narrower, so look one further there; few cells are all taken
    first, last, n = F.col("__first"), F.col("__last"), F.col("__n")
    more = F.when((first < 2) | (last >= n - 2), F.lit(2)).otherwise(F.lit(1))
    reach = F.when(last - first + 5 >= n, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.sequence(first - more, last + more))
    rows = rows.withColumn("__d", F.explode(reach))
    return rows.withColumn("__cell", F.pmod(F.col("__d"), n)).drop("__d", "__w", "__n", "__first", "__last")


def stations_within(
    sites: DataFrame, stations: DataFrame, radius_km: float, by: list[str] = (), station: str = "station_id"
) -> DataFrame:
    """Every station within the radius with its distance (``dist_km``).

    ``sites`` and ``stations`` have ``lat`` and ``lon``; ``by`` columns must be equal.
    The output is the list of neighbours itself; use :func:`nearest_station` for the best one.
    """
    step = _step(radius_km)
    band, cell = _home_cell(F.col("lat"), F.col("lon"), step)
    right = stations.dropna(subset=["lat", "lon"]).select(
        *by, station, F.col("lat").alias("st_lat"), F.col("lon").alias("st_lon"), band.alias("__band"), cell.alias("__cell")
    )
    pairs = null_safe_join(_around(sites.dropna(subset=["lat", "lon"]), step), right, [*by, "__band", "__cell"], "inner")
    dist = haversine_km(F.col("lat"), F.col("lon"), F.col("st_lat"), F.col("st_lon"))
    return (
        pairs.filter(F.abs(F.col("lat") - F.col("st_lat")) <= step)
        .withColumn("dist_km", dist)
        .filter(F.col("dist_km") <= radius_km)
        .drop("__band", "__cell")
    )


def _at_depths(points: DataFrame, lat: str, lon: str, step: float, deepest: int) -> DataFrame:
    """Each point once per depth with the path of its cell (``__k``, ``__path``)."""
    band, cell = _home_cell(F.col(lat), F.col(lon), step)
    rows = points.withColumns({"__band": band, "__cell": cell})
    width = _lon_step(F.col("__band"), step)
    rows = rows.withColumns(
        {
            "__y": (F.col(lat) - F.col("__band") * step) / step,
            "__x": (F.pmod(F.col(lon), F.lit(360.0)) - F.col("__cell") * width) / width,
        }
    )

    def digit(k: int) -> Column:
        n = float(SPLIT**k)
        sub = F.pmod(F.floor(F.col("__y") * n), F.lit(SPLIT)) * SPLIT + F.pmod(F.floor(F.col("__x") * n), F.lit(SPLIT))
        return F.substring(F.lit("0145236789cdabef"), (sub + 1).cast("int"), F.lit(1))  # in order, four make a square

    full = F.concat(_home_path(), *[digit(k) for k in range(1, deepest + 1)])
    depths = F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("__k")
    named = rows.withColumn("__full", full).drop("__band", "__cell", "__y", "__x").select("*", depths)
    cut = F.expr(f"substring(__full, 1, length(__full) - {deepest} + __k)")
    return named.withColumn("__path", cut).drop("__full")


def _home_path() -> Column:
    return F.concat(F.col("__band").cast("string"), F.lit(":"), F.col("__cell").cast("string"), F.lit(":"))


def _cell_tree(
    points: DataFrame, by: list[str], lat: str, lon: str, step: float, deepest: int, most: int, shared: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Cells divided until they hold few points, and the points in packs of about ``most`` (``__items``).

    Cells are named by a path, ``band:column:`` plus one digit per division. Each cell has the
    exact extent of its points and its parent; cells below an undivided one do not exist. The
    counts of all depths come from one pass, and the tree is written once. A pack lies in one undivided
    cell; one with too many points at the last depth has several. With ``shared``, undivided cells of one
    parent share packs, which then stay as large where a division leaves few points to a cell; such a tree
    is there for the packs only and has no extents.
    """
    spread = _at_depths(points, lat, lon, step, deepest)
    turned = F.pmod(F.col(lon), F.lit(360.0))
    extent = [f(c).alias(b) for b, f, c in zip(BOX, (F.min, F.max) * 2, (lat, lat, turned, turned))]
    cells = spread.groupBy(*by, "__k", "__path").agg(F.count(F.lit(1)).alias("__n"), *([] if shared else extent))
    above = F.when(F.col("__k") > 0, F.expr("substring(__path, 1, length(__path) - 1)"))
    cells = cells.withColumns({"__parent": above, "__leaf": (F.col("__n") <= most) | (F.col("__k") == deepest)})
    divided = cells.filter(~F.col("__leaf")).select(*by, F.col("__path").alias("__parent"))
    inner = null_safe_join(cells.filter("__k > 0"), divided, [*by, "__parent"], "left_semi")
    tree = written(cells.filter("__k = 0").unionByName(inner), "cells")
    leaves = tree.filter("__leaf")
    joined = F.lit(shared) & (F.col("__n") <= most) & (F.col("__k") > 0)
    leaves = leaves.withColumns({"__home": F.when(joined, F.col("__parent")).otherwise(F.col("__path")), "__at": F.col("__k") - joined.cast("int")})
    if shared:  # a parent has sixteen cells at most, so its window is small
        before = Window.partitionBy(*by, "__home").orderBy("__path").rowsBetween(Window.unboundedPreceding, -1)
        leaves = leaves.withColumn("__first", F.floor(F.coalesce(F.sum("__n").over(before), F.lit(0)) / most))
    else:
        leaves = leaves.withColumn("__first", F.lit(0))
    # a point meets its undivided cell, at one of the depths that have any
    ends = tree.filter("__leaf").agg(F.min("__k").alias("low"), F.max("__k").alias("high")).first()
    named = spread.filter(F.col("__k").between(ends["low"], ends["high"])).drop("__k")
    owner = leaves.select(*by, "__path", "__home", "__at", "__first", F.ceil(F.col("__n") / most).alias("__packs"))
    owned = null_safe_join(named, owner, [*by, "__path"], "inner")
    items = [c for c in points.columns if c not in by]
    pack = (F.col("__first") + F.pmod(F.xxhash64(*items), F.col("__packs"))).alias("__pack")
    packs = owned.groupBy(*by, F.col("__home").alias("__path"), F.col("__at").alias("__k"), pack).agg(
        F.collect_list(F.struct(*items)).alias("__items")
    )
    return tree, packs


def _site_packs(spots: DataFrame, by: list[str], step: float, deepest: int) -> DataFrame:
    """The spots in packs of neighbours, with an id (``__g``) and the extent of each."""
    packs = _cell_tree(spots, by, "lat", "lon", step, deepest, PACK_SPOTS, shared=True)[1]

    def extent(of):
        every = F.transform("__items", of)
        return F.array_min(every), F.array_max(every)

    ends = [*extent(lambda s: s["lat"]), *extent(lambda s: F.pmod(s["lon"], F.lit(360.0)))]
    return written(packs.withColumns(dict(zip(SIDES, ends)) | {"__g": F.monotonically_increasing_id()}), "packs")


def _nearest_cells(packs: DataFrame, by: list[str], tree: DataFrame, deepest: int, step: float, radius_km: float, k: int) -> DataFrame:
    """The undivided cells that can hold one of the ``k`` nearest points of a spot of each pack (``__path``).

    Best first: a bound per pack, no less than the distance of the k-th nearest point of any of its spots, shrinks while the tree is
    descended, and cells that lie beyond it are left out. It is the farthest possible distance of the nearest cells that together hold ``k``
    points, so it can't lose any of them. All levels are one plan. ``__b`` deals the cells of a pack into parts of about ``PACK_POINTS`` points.
    """
    lo, hi = box_bounds(tuple(map(F.col, SIDES)), tuple(map(F.col, BOX)))
    packs = packs.select("__g", *by, "__path", "__k", *SIDES)
    # a first bound: the smallest cell around the pack that holds so many stations
    full = tree.filter(F.col("__n") >= k).select(*by, "__path", *BOX)
    depths = F.explode(F.sequence(F.lit(0), F.least(F.col("__k"), F.lit(deepest)))).alias("__j")
    upper = packs.select("*", depths).withColumn("__path", F.expr("substring(__path, 1, length(__path) - __k + __j)"))
    bound = null_safe_join(upper, full, [*by, "__path"], "inner").groupBy("__g").agg(F.min(hi).alias("__best"))
    packs = packs.drop("__path", "__k").join(bound, "__g", "left").fillna(half_chord(radius_km) + EPS, subset=["__best"])
    # what a cell is replaced by at the next level: its children, sixteen at most, or itself where it is not divided
    parts = tree.filter("__k > 0").select(*by, F.col("__parent").alias("__key"), "__path", "__n", *BOX)
    whole = tree.filter("__leaf").select(*by, F.col("__path").alias("__key"), "__path", "__n", *BOX)
    first = tree.filter("__k = 0").select(*by, F.col("__path").alias("__key"), "__path", "__n", *BOX)
    cand = _around(packs, step, "__south", "__west", "__east").withColumn("__key", _home_path()).drop("__band", "__cell")
    # a pack has a bounded number of candidate cells, so its window is small
    own = Window.partitionBy("__g")
    for depth in range(deepest + 1):
        below = first if depth == 0 else parts.unionByName(whole)
        reached = null_safe_join(cand, below, [*by, "__key"], "inner").drop("__key")
        limit = F.least(F.col("__best"), F.lit(half_chord(radius_km))) + EPS
        bounded = reached.withColumns({"__lo": lo, "__hi": hi}).filter(F.col("__lo") <= limit)
        held = bounded.withColumn("__held", F.sum("__n").over(own.orderBy("__hi")))
        best = F.least(F.min(F.when(F.col("__held") >= k, F.col("__hi"))).over(own), F.min("__best").over(own))
        kept = held.withColumn("__best", best).filter(F.col("__lo") <= F.col("__best") + EPS)
        cand = kept.select("__g", *by, *SIDES, F.col("__path").alias("__key"), "__best", "__held")
    return cand.select("__g", *by, F.col("__key").alias("__path"), F.floor(F.col("__held") / PACK_POINTS).alias("__b"))


def _in_reach(k: int) -> Column:
    """Those points of a row (``__points``) that can be among the ``k`` nearest of any spot of its pack."""

    def bounded(p: Column) -> Column:
        east = F.pmod(p["st_lon"], F.lit(360.0))
        lo, hi = box_bounds(tuple(map(F.col, SIDES)), (p["st_lat"], p["st_lat"], east, east))
        return F.struct(hi.alias("hi"), lo.alias("lo"), p.alias("p"))

    def kept(x: Column) -> Column:
        most = F.coalesce(F.get(x, F.lit(k - 1))["hi"], F.lit(1.0)) + EPS
        return F.transform(F.filter(x, lambda b: b["lo"] <= most), lambda b: b["p"])

    return F.flatten(_once(F.sort_array(F.transform("__points", bounded)), kept))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value in an array of one: inner functions then see the value, not the way it is computed."""
    return F.transform(F.array(value), use)


def _best(spot: Column, points: Column, station: str, radius_km: float, k: int) -> Column:
    """The ``k`` nearest of the points to a spot, in order."""
    far = F.transform(points, lambda p: F.struct(haversine_km(spot["lat"], spot["lon"], p["st_lat"], p["st_lon"]).alias("d"), p.alias("p")))

    def ranked(x: Column) -> Column:
        s = x["p"][station]
        return F.struct(F.round(x["d"], 6).alias("dist_km"), s.isNull().alias("none"), s.alias(station), x["p"]["st_lat"].alias("st_lat"), x["p"]["st_lon"].alias("st_lon"))

    near = F.filter(far, lambda x: x["d"] <= radius_km)
    return F.slice(F.sort_array(F.transform(near, ranked)), 1, k)


def nearest_stations(
    sites: DataFrame, stations: DataFrame, radius_km: float, k: int = 1, by: list[str] = (), station: str = "station_id"
) -> DataFrame:
    """The ``k`` nearest stations of every site within the radius, with ``dist_km`` and ``rank``; ties (to a millimetre) by
    station id.

    Sites without one are absent. Sites sharing coordinates are searched once, and neighbouring ones together. Crowded cells are divided
    until they hold few points, and a pack of sites follows only the cells that can hold one of the ``k`` nearest of its sites
    (:func:`_nearest_cells`), so its work does not grow with the number of stations in reach.
    """
    by = list(by)
    step = _step(radius_km)
    placed = stations.dropna(subset=["lat", "lon"]).select(*by, station, F.col("lat").alias("st_lat"), F.col("lon").alias("st_lon"))
    if k == 1:
        points = placed.groupBy(*by, "st_lat", "st_lon").agg(F.min(station).alias(station))
    else:  # of stations at one place only so many can be among the nearest
        here = Window.partitionBy(*by, "st_lat", "st_lon").orderBy(F.col(station).asc_nulls_last())
        points = placed.distinct().withColumn("__r", F.row_number().over(here)).filter(F.col("__r") <= k).drop("__r")
    tree, points = _cell_tree(points, by, "st_lat", "st_lon", step, MAX_DEPTH, LEAF_POINTS)
    deepest = tree.agg(F.max("__k").alias("k")).first()["k"] or 0
    spots = sites.select(*by, "lat", "lon").dropna(subset=["lat", "lon"]).distinct()
    packs = _site_packs(spots, by, step, min(deepest + 1, MAX_DEPTH))
    cells = _nearest_cells(packs, by, tree, deepest, step, radius_km, k)
    # the points that a pack is compared with, together on one row as far as that stays short
    met = null_safe_join(cells, points, [*by, "__path"], "inner").repartition("__g")
    some = F.floor(F.col("__pack") / (PACK_POINTS // LEAF_POINTS)).alias("__c")
    met = met.groupBy("__g", "__b", some).agg(F.flatten(F.collect_list("__items")).alias("__points"))
    pairs = packs.select("__g", *by, "__items", *SIDES).join(met, "__g")

    def searched(points: Column) -> Column:
        near = lambda s: _best(s, points, station, radius_km, k).alias("near")
        return F.transform("__items", lambda s: F.struct(s["lat"].alias("lat"), s["lon"].alias("lon"), near(s)))

    each = pairs.select("__g", *by, F.inline(F.flatten(_once(_in_reach(k), searched)))).filter(F.size("near") > 0)
    whole = F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k)
    nearest = each.groupBy("__g", *by, "lat", "lon").agg(whole.alias("__near")).drop("__g")
    out = null_safe_join(sites, nearest, [*by, "lat", "lon"], "inner").select("*", F.posexplode("__near").alias("__i", "__s"))
    return out.select(*sites.columns, *[f"__s.{c}" for c in (station, "dist_km", "st_lat", "st_lon")], (F.col("__i") + 1).alias("rank"))


def nearest_station(
    sites: DataFrame,
    stations: DataFrame,
    radius_km: float,
    by: list[str] = (),
    site: str = "site_id",
    station: str = "station_id",
) -> DataFrame:
    """The nearest station of every site within the radius; see :func:`nearest_stations`."""
    return nearest_stations(sites, stations, radius_km, 1, by, station).drop("rank")
