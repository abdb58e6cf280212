"""Hot groups, crowded places and plan shapes."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from agroloom.operators import scale
from agroloom.operators.merge import inside_ring, locate_points
from agroloom.operators.stations import nearest_station, stations_within


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def hot(spark, n=6000):
    """A third of the rows in one group, nulls among the keys."""
    k = F.col("id")
    return spark.range(n).select(
        "id", F.when(k % 3 == 0, F.lit("hot")).when(k % 17 != 0, (k % 40).cast("string")).alias("g"), ((k * 7919) % 1009).alias("v")
    )


def test_row_numbers_of_a_hot_group(spark):
    df = hot(spark)
    order = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    window = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long"))
    assert rows(scale.row_numbers(df, ["g"], order, "n", spread=True)) == rows(window)


def test_dense_ids_in_parts(spark):
    df = hot(spark)
    whole = df.withColumn("n", F.dense_rank().over(Window.partitionBy("g").orderBy(F.col("v").asc_nulls_last())).cast("long"))
    assert rows(scale.dense_ids(df, ["v"], "n", ["g"], spread=True)) == rows(whole)
    world = df.withColumn("n", F.dense_rank().over(Window.orderBy(F.col("g").asc_nulls_last(), "v")).cast("long"))
    assert rows(scale.dense_ids(df, ["g", "v"], "n")) == rows(world)


def test_hot_key_join_is_split(spark):
    """The join back to a table aggregated on the same key keeps the shape the skew rule can split."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200_000, numPartitions=16).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("g"), F.rand(1).alias("v")
        )
        out = scale.null_safe_join(df, df.groupBy("g").agg(F.max("v").alias("top")), ["g"])
        assert out.filter("top >= v").count() == 200_000
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def km(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def places(kind, rng):
    if kind == "crowd":  # most stations within a few hundred metres, copies among them
        pts = [(51 + rng.random() * 0.004, 12 + rng.random() * 0.004) for _ in range(150)]
        pts += [pts[0]] * 20 + [(51 + rng.uniform(-2, 2), 12 + rng.uniform(-2, 2)) for _ in range(60)]
        return pts, [(51 + rng.uniform(-1, 1), 12 + rng.uniform(-1, 1)) for _ in range(60)] + [pts[5]] * 3
    if kind == "date line":
        return [(rng.uniform(-5, 5), (179 + rng.uniform(0, 2) + 180) % 360 - 180) for _ in range(80)], [
            (rng.uniform(-5, 5), (179 + rng.uniform(0, 2) + 180) % 360 - 180) for _ in range(60)
        ]
    if kind == "pole":
        return [(rng.uniform(86, 90), rng.uniform(-180, 180)) for _ in range(80)], [(rng.uniform(86, 90), rng.uniform(-180, 180)) for _ in range(40)]
    return [(rng.uniform(-60, 80), rng.uniform(-180, 180)) for _ in range(400)], [(rng.uniform(-60, 80), rng.uniform(-180, 180)) for _ in range(150)]


@pytest.mark.parametrize("kind, radius", [("crowd", 50), ("date line", 120), ("pole", 200), ("world", 500)])
def test_stations_against_all_pairs(spark, kind, radius):
    rng = random.Random(kind)
    st, si = places(kind, rng)
    stations = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(st)], "station_id int, lat double, lon double")
    sites = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(si)], "site_id int, lat double, lon double")
    pairs = {(i, j): km(*a, *b) for i, a in enumerate(si) for j, b in enumerate(st)}
    near = {p for p, d in pairs.items() if d <= radius}
    assert {(r["site_id"], r["station_id"]) for r in stations_within(sites, stations, radius).collect()} == near
    want = {}
    for i in range(len(si)):
        inside = [(round(pairs[i, j], 6), j) for j in range(len(st)) if (i, j) in near]
        if inside:
            want[i] = min(inside)[1]
    got = {r["site_id"]: r["station_id"] for r in nearest_station(sites, stations, radius).collect()}
    assert got == want


def test_points_in_rings(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]  # a notch at the top
    areas = spark.createDataFrame([("big", ring), ("small", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)])], "name string, ring array<struct<lon:double,lat:double>>")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 3.0), (3, 3.5, 0.5), (4, 9.0, 9.0), (5, None, None)], "id int, lon double, lat double")
    got = {r["id"]: r["name"] for r in locate_points(points, areas, ["name"]).collect()}
    assert got == {1: "small", 2: None, 3: "big", 4: None, 5: None}
    inside = points.select(inside_ring(F.col("lon"), F.col("lat"), F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in ring])))
    assert [r[0] for r in inside.collect()][:4] == [True, False, True, False]


def test_pushed_filters(spark, sf):
    from agroloom.operators.columns import within_years

    df = spark.read.parquet(f"{sf}/orders.parquet")
    plan = within_years(df, "o_orderdate", 1996, 1997).select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in plan
