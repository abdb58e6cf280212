"""Nearest stations, pruned archive, long series, outlines, units, long lists and comparison by checksums."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from agroloom.functions.units import conversion
from agroloom.operators import weather
from agroloom.operators.areas import cell_cover, locate_points
from agroloom.operators.nesting import joined_text, numbered_items, text_pieces
from agroloom.operators.quality import compare_by_checksum, compare_tables
from agroloom.operators.stations import PACK_SPOTS, _site_packs, _step, nearest_stations


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def crowd(seed=1):
    """Stations of which a third lie within metres and many at one place; some at the date line and near the pole."""
    rnd = random.Random(seed)
    points = [(i, 50 + rnd.random() * 0.0005, 10 + rnd.random() * 0.0005) for i in range(400)]
    points += [(400 + i, 50.0002, 10.0002) for i in range(60)]
    points += [(500 + i, rnd.uniform(48, 52), rnd.uniform(8, 12)) for i in range(500)]
    points += [(1100 + i, rnd.uniform(-1, 1), rnd.choice((179.9, -179.9)) + rnd.uniform(-0.1, 0.1)) for i in range(80)]
    points += [(1300 + i, rnd.uniform(89, 90), rnd.uniform(-180, 180)) for i in range(40)]
    points = [(i, a, b - 360 if b >= 180 else b + 360 if b < -180 else b) for i, a, b in points]
    sites = [(i, rnd.uniform(49, 51), rnd.uniform(9, 11)) for i in range(40)] + [(100 + i, 50.0001 + i / 1e5, 10.0003) for i in range(10)]
    sites += [(200 + i, rnd.uniform(-1, 1), rnd.choice((179.95, -179.95))) for i in range(10)] + [(300 + i, 89.7, 40.0 * i) for i in range(5)]
    return points, sites


@pytest.mark.parametrize("k", [1, 10, 70])
def test_k_nearest_equals_brute_force(spark, k):
    points, sites = crowd()
    want = set()
    for s, a, b in sites:
        found = sorted((round(d, 6), i) for i, c, e in points if (d := km(a, b, c, e)) <= 60)
        want |= {(s, i, n + 1) for n, (_, i) in enumerate(found[:k])}
    stations = spark.createDataFrame(points, "station_id int, lat double, lon double")
    got = nearest_stations(spark.createDataFrame(sites, "site_id int, lat double, lon double"), stations, 60, k)
    have = {(r["site_id"], r["station_id"], r["rank"]) for r in got.collect()}
    # distances that round to the same millimetre may tie either way in the last bit
    assert len(have) == len(want) and len(have ^ want) <= 0.01 * len(want)


def shuffled_rows(plan, seen=None):
    """Rows written by the exchanges of an executed plan, each counted once."""
    seen = set() if seen is None else seen
    name, total = plan.getClass().getSimpleName(), 0
    if name == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan(), seen)
    if name.endswith("QueryStageExec"):
        return shuffled_rows(plan.plan(), seen)
    if name == "ReusedExchangeExec":
        return shuffled_rows(plan.child(), seen)
    if name == "ShuffleExchangeExec":
        if plan.id() in seen:
            return 0
        seen.add(plan.id())
        total = plan.metrics().apply("shuffleRecordsWritten").value()
    return total + sum(shuffled_rows(plan.children().apply(i), seen) for i in range(plan.children().size()))


@pytest.mark.parametrize("k", [1, 3])
def test_neighbouring_sites_are_searched_together(spark, k):
    """Sites along one shore of many stations: the result of all pairs, while a site itself is shuffled a few times only."""
    rnd = random.Random(7)
    points = [(i, rnd.uniform(50, 50.6), rnd.uniform(10, 10.9)) for i in range(1500)]
    sites = [(i, rnd.uniform(50.2, 50.3), rnd.uniform(9.7, 10.1)) for i in range(1200)] + [(2000 + i, 50.25, 10.00001 + i * 1e-9) for i in range(300)]
    want = set()
    for s, a, b in sites:
        found = sorted((round(d, 6), i) for i, c, e in points if abs(a - c) < 0.3 and (d := km(a, b, c, e)) <= 30)
        want |= {(s, i, n + 1) for n, (_, i) in enumerate(found[:k])}
    asked, stations = (spark.createDataFrame(x, f"{n} int, lat double, lon double") for x, n in ((sites, "site_id"), (points, "station_id")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = nearest_stations(asked, stations, 30, k)
        have = {(r["site_id"], r["station_id"], r["rank"]) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(have) == len(want) and len(have ^ want) <= 0.01 * len(want)
    assert shuffled_rows(got._jdf.queryExecution().executedPlan()) < 25 * len(sites)


def test_sparse_cells_share_packs(spark):
    """Sites of which a division leaves few to a cell make packs as large as others; each is in one pack, with the result of all pairs."""
    rnd = random.Random(11)
    kinds = ("a", None)
    sites = [(i, kinds[i % 2], rnd.uniform(50.001, 50.269), rnd.uniform(10, 10.4)) for i in range(3000)]
    sites += [(4000 + i, "a", 50.1 + i * 1e-9, 10.2) for i in range(300)] + [(5000 + i, None, 52.0 + i, 10.2) for i in range(5)]
    points = [(i, kinds[i % 2], rnd.uniform(50, 50.3), rnd.uniform(9.9, 10.5)) for i in range(400)]
    asked = spark.createDataFrame(sites, "site_id int, kind string, lat double, lon double")
    packs = _site_packs(asked.drop("site_id"), ["kind"], _step(30), 3).collect()
    held = [(p["kind"], s["lat"], s["lon"]) for p in packs for s in p["__items"]]
    assert sorted(held, key=str) == sorted((s[1:] for s in sites), key=str)
    assert max(len(p["__items"]) for p in packs) < 2 * PACK_SPOTS and len(packs) < 2 * len(sites) / PACK_SPOTS
    for p in packs:
        lats, lons = zip(*[(s["lat"], s["lon"]) for s in p["__items"]])
        assert (p["__south"], p["__north"], p["__west"], p["__east"]) == (min(lats), max(lats), min(lons), max(lons))
    got = nearest_stations(asked, spark.createDataFrame(points, "station_id int, kind string, lat double, lon double"), 30, 2, ["kind"])
    have = {(r["site_id"], r["station_id"], r["rank"]) for r in got.collect()}
    want = set()
    for s, kind, a, b in sites:
        found = sorted((round(d, 6), i) for i, k, c, e in points if k == kind and abs(a - c) < 0.3 and (d := km(a, b, c, e)) <= 30)
        want |= {(s, i, n + 1) for n, (_, i) in enumerate(found[:2])}
    assert len(have) == len(want) and len(have ^ want) <= 0.01 * len(want)


def test_no_stations(spark):
    none = spark.createDataFrame([], "station_id int, lat double, lon double")
    assert nearest_stations(spark.createDataFrame([(1, 1.0, 2.0)], "site_id int, lat double, lon double"), none, 60, 3).count() == 0


def test_archive_is_pruned(spark, tmp_path):
    data = [
        (s, v, dt.datetime(y, m, d, 12), float(s + m))
        for s in range(6) for v in ("TT_TU", "R1", "unknown") for y in range(1995, 2001) for m, d in ((1, 1), (6, 15), (12, 31)) if (s, y, m) != (2, 1997, 1)
    ]
    readings = spark.createDataFrame(data, "station_id int, var string, ts timestamp, value double")
    path = str(tmp_path / "archive")
    weather.write_archive(readings, path, files=2)
    edges = spark.read.parquet(f"{path}/edges")
    assert edges.count() == 6 * 2 * 6 - 2
    chosen = spark.createDataFrame([(1, 1997, "air_temperature"), (3, 1998, "precipitation")], "station_id int, year int, variable string")
    got = weather.archive_readings(spark.read.parquet(f"{path}/readings"), chosen)
    assert got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "year" in filters and "1997" in filters and "air_temperature" in filters


def test_weather_from_the_archive(spark, tmp_path):
    from test_plans import station_fixture

    stations, readings = station_fixture(spark)
    wanted = spark.createDataFrame([(7, 51.0, 12.0, 2000), (7, 51.0, 12.0, 2001), (8, 40.0, 0.0, 2000)], "site_id int, lat double, lon double, year int")
    mapping, params = [m for m in weather.STATION_MAP if m["std_var"].startswith("T")], [weather.STATION_PARAMS[0]]
    path = str(tmp_path / "archive")
    weather.write_archive(readings, path, params)
    plain, kept = weather.get_weather(wanted, stations, readings, mapping, params), weather.archive_weather(path, wanted, stations, mapping, params)
    for part in ("data", "header", "stations", "comments"):
        assert rows(kept[part]) == rows(plain[part].select(*kept[part].columns))


@pytest.fixture
def small_parts(spark):
    """Spark puts small partitions together; here they stay apart."""
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least, "1KB")
    yield
    spark.conf.unset(least)


@pytest.mark.parametrize("rule, position, single", [(1, "row", "null"), (2, "row", "fill"), (1, "day", "fill"), (2, "day", "null")])
def test_long_series_equal_the_window(spark, rule, position, single, small_parts):
    rnd = random.Random(3)
    day = dt.date(1950, 1, 1)
    data = [("hot", day + dt.timedelta(2 * i), rnd.random() if rnd.random() < 0.1 else None, None) for i in range(4000)]
    data += [(g, day + dt.timedelta(i), float(i) if i in on else None, i) for g, on in (("one", {5}), ("none", set()), ("ends", {0, 29}), (None, {3, 4})) for i in range(30)]
    df = spark.createDataFrame(data, "g string, day date, v double, w int").repartition(7)
    whole = weather.impute(df, ["g"], "day", ["v", "w"], rule, position, single)
    parts = weather.impute_long(df, ["g"], "day", ["v", "w"], rule, position, single)
    assert rows(parts.withColumn("v", F.round("v", 9))) == rows(whole.withColumn("v", F.round("v", 9)))


def test_a_long_series_is_filled_in_several_tasks(spark, small_parts):
    df = spark.range(40_000).select(F.lit("one").alias("g"), F.col("id").alias("at"), F.when(F.col("id") % 1999 == 7, F.col("id").cast("double")).alias("v"))
    from agroloom.operators.scale import range_parts

    sizes = range_parts(df, [F.col("g").asc(), F.col("at").asc()]).groupBy("__part").count().collect()
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 20_000
    filled = weather.impute_long(df, ["g"], "at", ["v"])
    inner = filled.where("at BETWEEN 7 AND 37988")
    assert inner.where(F.abs(F.col("v") - F.col("at")) > 1e-6).count() == 0 and filled.where("v IS NULL").count() == 0


def star(rnd, x, y, size, n):
    """A closed ring of n corners around a point, longitudes in [-180, 180)."""
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(x + size * rnd.uniform(0.3, 1) * math.cos(t), y + size * rnd.uniform(0.3, 1) * math.sin(t)) for t in angles]
    return [((a + 180) % 360 - 180, b) for a, b in [*ring, ring[0]]]


def in_rings(rings, x, y):
    """Even-odd test with every ring laid out from its first corner, at all turns."""
    odd = False
    for ring in rings:
        flat = [ring[0]]
        for a, b in ring[1:]:
            flat.append((a - 360 * round((a - flat[-1][0]) / 360), b))
        for turn in (-360, 0, 360):
            for (x1, y1), (x2, y2) in zip(flat, flat[1:]):
                if (y1 > y) != (y2 > y) and x + turn < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                    odd = not odd
    return odd


def test_outlines_equal_brute_force(spark):
    rnd = random.Random(5)
    areas = []
    for i in range(12):
        x, y = (rnd.uniform(-170, 170), rnd.uniform(-60, 60)) if i % 3 else (rnd.choice((179.5, -179.5)), rnd.uniform(-60, 60))
        size = rnd.choice((0.05, 1, 8, 25))
        rings = [star(rnd, x, y, size, 40), star(rnd, x, y, size * 0.25, 15), star(rnd, x + 2.5 * size, y, size, 7)]
        areas.append((f"A{i}", rings, x, y, size))
    spots = [((x + rnd.uniform(-4, 4) * s + 180) % 360 - 180, y + rnd.uniform(-1.2, 1.2) * s) for _, _, x, y, s in areas for _ in range(150)]
    df = spark.createDataFrame([(n, [[{"lon": a, "lat": b} for a, b in ring] for ring in rings]) for n, rings, *_ in areas], "name string, rings array<array<struct<lon:double,lat:double>>>")
    points = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spots)], "id int, lon double, lat double")
    inside = {(n, i) for n, rings, *_ in areas for i, (a, b) in enumerate(spots) if in_rings(rings, a, b)}
    for n in ("A0", "A1", "A5"):  # across the date line, large and small
        one = locate_points(points, df.where(F.col("name") == n), ["name"])
        assert {r["id"] for r in one.where("name IS NOT NULL").collect()} == {i for m, i in inside if m == n}
    assert len(inside) > 300
    every = {r["id"]: r["name"] for r in locate_points(points, df, ["name"]).collect()}
    assert {i for i, n in every.items() if n} == {i for _, i in inside} and all((n, i) in inside for i, n in every.items() if n)
    cover, segments, _ = cell_cover(df.withColumn("id", F.col("name")).select("id", "rings"))
    kinds = {r["inside"]: r["count"] for r in cover.groupBy("inside").count().collect()}
    assert kinds[True] > 0 and segments.agg(F.max(F.size("segments"))).first()[0] < 60


UNITS = [
    ("kg ha-1", "g/m2", 0.1, 0.0), ("g m^-2 d^-1", "kg/(ha d)", 10.0, 0.0), ("mmol/l", "mol m-3", 1.0, 0.0), ("J/cm2", "MJ m-2", 0.01, 0.0), ("W m-2", "MJ/m2/d", 0.0864, 0.0),
    ("degree_C", "degree_F", 1.8, 32.0), ("K", "degC", 1.0, -273.15), ("°C d", "K h", 24.0, 0.0), ("m³ m⁻³", "%", 100.0, 0.0), ("10^3 kg", "t", 1.0, 0.0), ("kg.ha-1", "t/ha", 0.001, 0.0),
    ("ug/g", "mg kg-1", 1.0, 0.0), ("l/(m2 d)", "mm/d", 1.0, 0.0), ("µmol m-2 s-1", "mol m-2 d-1", 0.0864, 0.0), ("kg*m**2/s^2", "J", 1.0, 0.0), ("number/m2", "number/ha", 1e4, 0.0),
    ("min", "s", 60.0, 0.0), ("dt/ha", "kg/ha", 100.0, 0.0), ("hPa", "bar", 0.001, 0.0), ("kg/(m s)^2", "kg m-2 s-2", 1.0, 0.0), ("anything", "anything", 1.0, 0.0),
]


@pytest.mark.parametrize("source, target, factor, zero", UNITS)
def test_units(source, target, factor, zero):
    scale, offset = conversion(source, target)
    assert scale == pytest.approx(factor, rel=1e-12) and offset == pytest.approx(zero, abs=1e-9)
    back, shift = conversion(target, source)
    assert back * scale == pytest.approx(1) and back * offset + shift == pytest.approx(0, abs=1e-9)


@pytest.mark.parametrize("source, target", [("kg", "m"), ("furlong", "m"), ("kg/", "kg"), ("(kg", "kg"), ("kg)", "kg"), ("", "kg"), (None, "kg"), ("kg ha-1", "kg"), ("kg^", "kg"), ("/", "1")])
def test_units_without_conversion(source, target):
    with pytest.raises(ValueError):
        conversion(source, target)


def test_long_lists_equal_the_cells(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"), (F.col("id") * 37 % 1000).alias("v"))
    df = df.withColumn("v", F.when(F.col("v") != 5, F.concat(F.lit("t"), "v")))
    whole = {r["g"]: r["text"] for r in joined_text(df, ["g"], "v").collect()}
    pieces = text_pieces(df, ["g"], "v", most=100).collect()
    got = {}
    for r in sorted(pieces, key=lambda r: (r["g"], r["piece"])):
        got[r["g"]] = got.get(r["g"], "") + r["text"]
    assert got == whole and max(r["text"].count(";") for r in pieces) <= 100
    items = numbered_items(df, ["v"], ["v"], ["g"])
    for g in ("hot", "1"):
        mine = sorted((r["number"], r["v"]) for r in items.where(F.col("g") == g).collect())
        assert [n for n, _ in mine] == list(range(1, len(mine) + 1))
        assert [v for _, v in mine] == sorted((v for _, v in mine), key=lambda v: (v is None, v or ""))


def test_checksums_equal_the_full_comparison(spark):
    a = spark.range(5000).select("id", (F.col("id") % 13).alias("x"), (F.col("id") / 7).alias("y"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("z"))
    b = a.where("id % 501 <> 7").select("id", F.when(F.col("id") % 97 == 3, F.col("x") + 3).otherwise(F.col("x")).cast("double").alias("x"), (F.col("y") + 0.001).alias("y"),
                                        F.when(F.col("id") % 211 == 1, "other").otherwise(F.col("z")).alias("z"))
    for other, digits in ((b, 2), (b, {"y": 4}), (a, 0), (a.limit(0), 0)):
        want = compare_tables(a, other, ["id"], digits)
        assert rows(compare_by_checksum(a, other, ["id"], digits, bits=6)) == rows(want)


def test_checksums_with_a_hot_key(spark):
    """Rows of a key are paired one by one, and equal ones before all others."""
    a = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 100).alias("v"))
    assert {r["n_differ"] for r in compare_by_checksum(a, a.repartition(5), ["k"]).collect()} == {0}
    more = a.unionByName(a.where("k = 0").limit(1))
    got = compare_by_checksum(a, more, ["k"]).first()
    assert (got["n_matched"], got["n_one_side"]) == (3000, 1)
