"""Daily aggregation, gap filling, station choice and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.operators import weather as w
from agroloom.operators.merge import locate_points
from agroloom.operators.phenology import estimate_phenology
from agroloom.operators.scale import null_safe_join
from agroloom.operators.soil import format_soil
from agroloom.operators.stations import nearest_station, nearest_stations, stations_within
from agroloom.queries import Tables, query
from agroloom.session import scratch_path
from agroloom.sources.files import read_archive
from agroloom.sources.soil import soil_horizons

EVENT_MAP = [
    {"std_var": "SRAD", "repo_var": "value", "agg_fun": "sum", "conv_fct": 0.01},
    {"std_var": "TMAX", "repo_var": "value", "agg_fun": "max", "conv_fct": 1.0},
    {"std_var": "TMIN", "repo_var": "value", "agg_fun": "min", "conv_fct": 1.0},
    {"std_var": "TMEAN", "repo_var": "value", "agg_fun": "mean", "conv_fct": 1.0},
]


def text_day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


@query("""
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS W_DATE, round(sum(value) * 0.01, 6) AS SRAD,
           max(value) AS TMAX, min(value) AS TMIN, round(avg(value), 10) AS TMEAN
    FROM events GROUP BY 1, 2
""")
def daily_weather_agg(t: Tables) -> DataFrame:
    daily = w.daily_weather(t.events, "ts", EVENT_MAP, ["event_type"])
    return daily.select(
        "event_type", text_day("W_DATE"), F.round("SRAD", 6).alias("SRAD"), "TMAX", "TMIN", F.round("TMEAN", 10).alias("TMEAN")
    )


@query("""
    WITH e AS (SELECT *, CASE WHEN event_id % 97 <> 0 THEN value END AS v FROM events)
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS W_DATE,
           coalesce(round(CASE WHEN count(v) = count(*) THEN sum(v) * 0.01 END, 10), -99) AS SRAD,
           coalesce(CASE WHEN count(v) = count(*) THEN max(v) END, -99) AS TMAX,
           coalesce(CASE WHEN count(v) = count(*) THEN min(v) END, -99) AS TMIN,
           coalesce(round(CASE WHEN count(v) = count(*) THEN avg(v) END, 10), -99) AS TMEAN
    FROM e GROUP BY 1, 2
""")
def daily_poison_nulls(t: Tables) -> DataFrame:
    gappy = t.events.withColumn("value", F.when(F.col("event_id") % 97 != 0, F.col("value")))
    daily = w.daily_weather(gappy, "ts", EVENT_MAP, ["event_type"])
    cols = ["SRAD", "TMAX", "TMIN", "TMEAN"]
    return daily.select("event_type", text_day("W_DATE"), *[F.coalesce(F.round(c, 10), F.lit(-99.0)).alias(c) for c in cols])


@query("""
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, min(value) AS TMIN, max(value) AS TMAX,
           round(avg(value), 10) AS TMEAN
    FROM (SELECT user_id, ts, CASE WHEN event_id % 97 <> 0 THEN value END AS value FROM events)
    GROUP BY 1, 2 HAVING count(value) > 0
""")
def sensor_daily_stats(t: Tables) -> DataFrame:
    gappy = t.events.withColumn("value", F.when(F.col("event_id") % 97 != 0, F.col("value")))
    stats = w.daily_stats(gappy, "ts", "value", ["user_id"]).filter("TMIN IS NOT NULL")
    return stats.select("user_id", text_day("day"), "TMIN", "TMAX", F.round("TMEAN", 10).alias("TMEAN"))


_GAPPY_SQL = """
    WITH d AS (SELECT event_type, ts::DATE AS day, avg(value) AS raw FROM events GROUP BY 1, 2),
    g AS (SELECT event_type, day, CASE WHEN (day(day) * 7) % 5 <> 0 THEN raw END AS v,
                 row_number() OVER (PARTITION BY event_type, year(day) ORDER BY day) AS i FROM d),
    s AS (SELECT *,
            last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS i0,
            last_value(v IGNORE NULLS) OVER a AS v0,
            first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i1,
            first_value(v IGNORE NULLS) OVER b AS v1
          FROM g WINDOW
            a AS (PARTITION BY event_type, year(day) ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            b AS (PARTITION BY event_type, year(day) ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
"""
_LINE_SQL = "CASE WHEN v IS NOT NULL THEN v WHEN v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * (i - i0) / (i1 - i0)"


def gappy_days(t: Tables) -> DataFrame:
    """Daily means with every fifth day blank."""
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    return daily.withColumns(
        {"v": F.when((F.dayofmonth("day") * 7) % 5 != 0, F.col("v")), "year": F.year("day")}
    )


@query(
    _GAPPY_SQL
    + f"""SELECT event_type, strftime(day, '%Y-%m-%d') AS day,
            round({_LINE_SQL} ELSE coalesce(v0, v1) END, 10) AS v FROM s"""
)
def impute_linear(t: Tables) -> DataFrame:
    full = w.impute(gappy_days(t), ["event_type", "year"], "day", ["v"])
    return full.select("event_type", text_day("day"), F.round("v", 10).alias("v"))


@query(
    _GAPPY_SQL
    + f"""SELECT event_type, strftime(day, '%Y-%m-%d') AS day,
            coalesce(round({_LINE_SQL} END, 10), -99) AS v FROM s"""
)
def impute_inner(t: Tables) -> DataFrame:
    inner = w.impute(gappy_days(t), ["event_type", "year"], "day", ["v"], rule=1, position="day")
    return inner.select("event_type", text_day("day"), F.coalesce(F.round("v", 10), F.lit(-99.0)).alias("v"))


@query("""
    WITH o AS (SELECT o_orderstatus AS station, o_orderkey AS spot, CASE WHEN o_orderkey % 5 > 1 AND (o_orderkey // 400) % 3 > 0 THEN o_totalprice END AS v FROM orders),
    g AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY spot) AS i FROM o),
    s AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS i0, last_value(v IGNORE NULLS) OVER a AS v0,
                 first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i1, first_value(v IGNORE NULLS) OVER b AS v1
          FROM g WINDOW a AS (PARTITION BY station ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        b AS (PARTITION BY station ORDER BY spot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT station, spot, CAST(floor(1000 * CASE WHEN v IS NOT NULL THEN v WHEN v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * (i - i0) / (i1 - i0)
                                   ELSE coalesce(v0, v1) END + 0.5) AS BIGINT) AS v FROM s
""")
def impute_long_series(t: Tables) -> DataFrame:
    """Three series of all orders, each far longer than a year, with gaps of one to hundreds of rows."""
    at = F.col("o_orderkey")
    known = (at % 5 > 1) & (F.floor(at / 400) % 3 > 0)
    rows = t.orders.select(F.col("o_orderstatus").alias("station"), at.alias("spot"), F.when(known, F.col("o_totalprice")).alias("v"))
    return w.impute_long(rows, ["station"], "spot", ["v"]).withColumn("v", F.floor(1000 * F.col("v") + 0.5))


_PRICE_DAYS = """
    WITH d AS (SELECT o_orderstatus AS station, o_orderdate::DATE AS day, max(o_totalprice) / 9973 AS hi,
                      min(o_totalprice) / 9973 AS lo FROM orders GROUP BY 1, 2)
"""


def price_days(t: Tables) -> DataFrame:
    """Order prices as daily temperatures of three stations."""
    return t.orders.groupBy(F.col("o_orderstatus").alias("station"), F.to_date("o_orderdate").alias("W_DATE")).agg(
        (F.max("o_totalprice") / 9973).alias("TMAX"), (F.min("o_totalprice") / 9973).alias("TMIN")
    )


@query(
    _PRICE_DAYS
    + """, m AS (SELECT station, year(day) AS year, month(day) AS mo, avg((hi + lo) / 2) AS a,
                        sum((hi + lo) / 2) AS s, count(*) AS n FROM d GROUP BY 1, 2, 3)
    SELECT station, year, round(sum(s) / sum(n), 9) AS TAV, round((max(a) - min(a)) / 2, 9) AS AMP FROM m GROUP BY 1, 2
"""
)
def annual_summary(t: Tables) -> DataFrame:
    yearly = w.annual_summary(price_days(t).withColumn("year", F.year("W_DATE")), ["station", "year"])
    return yearly.select("station", "year", F.round("TAV", 9).alias("TAV"), F.round("AMP", 9).alias("AMP"))


@query(
    _PRICE_DAYS
    + """SELECT station, year(day) AS year, month(day) AS month, round(avg((hi + lo) / 2), 9) AS mean_temp,
                round(sum(lo), 4) AS total_rain FROM d GROUP BY 1, 2, 3"""
)
def monthly_climate(t: Tables) -> DataFrame:
    days = price_days(t).select(
        "station", F.year("W_DATE").alias("year"), "W_DATE", ((F.col("TMAX") + F.col("TMIN")) / 2).alias("TMEAN"),
        F.col("TMIN").alias("RAIN"),
    )
    out = w.monthly_climate(days, ["station", "year"])
    return out.select("station", "year", "month", F.round("mean_temp", 9).alias("mean_temp"), F.round("total_rain", 4).alias("total_rain"))


# --- distances -----------------------------------------------------------------------------------

def spread(key: str, table_step: int) -> tuple[Column, Column]:
    """Coordinates derived from a key: irregular, so that distances do not tie by symmetry."""
    k = F.col(key)
    return (
        (47 + F.pmod(k * (7919 + table_step), F.lit(8009)) / 1000).alias("lat"),
        (6 + F.pmod(k * (6101 + table_step), F.lit(9001)) / 1000).alias("lon"),
    )


def _spread_sql(key: str, step: int) -> str:
    return f"47 + ({key} * {7919 + step}) % 8009 / 1000 AS lat, 6 + ({key} * {6101 + step}) % 9001 / 1000 AS lon"


_HAV = """2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(p.lat - s.lat) / 2), 2)
    + cos(radians(s.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - s.lon) / 2), 2))))"""


@query(f"""
    WITH s AS (SELECT c_custkey AS site_id, {_spread_sql('c_custkey', 0)} FROM customer),
    p AS (SELECT s_suppkey AS station_id, {_spread_sql('s_suppkey', 2)} FROM supplier),
    d AS (SELECT site_id, station_id, round({_HAV}, 6) AS dist_km FROM s, p)
    SELECT site_id, station_id, dist_km FROM d WHERE dist_km <= 50
    QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY dist_km, station_id) = 1
""")
def nearest_station_50km(t: Tables) -> DataFrame:
    sites = t.customer.select(F.col("c_custkey").alias("site_id"), *spread("c_custkey", 0))
    stations = t.supplier.select(F.col("s_suppkey").alias("station_id"), *spread("s_suppkey", 2))
    return nearest_station(sites, stations, 50).select("site_id", "station_id", "dist_km")


@query(f"""
    WITH s AS (SELECT n_nationkey AS site_id, {_spread_sql('n_nationkey', 5)} FROM nation),
    p AS (SELECT s_suppkey AS station_id, {_spread_sql('s_suppkey', 2)} FROM supplier),
    d AS (SELECT site_id, station_id, {_HAV} AS km FROM s, p)
    SELECT site_id, station_id, round(km, 6) AS dist_km FROM d WHERE km <= 150
""")
def stations_in_radius(t: Tables) -> DataFrame:
    sites = t.nation.select(F.col("n_nationkey").cast("long").alias("site_id"), *spread("n_nationkey", 5))
    stations = t.supplier.select(F.col("s_suppkey").alias("station_id"), *spread("s_suppkey", 2))
    near = stations_within(sites, stations, 150)
    return near.select("site_id", "station_id", F.round("dist_km", 6).alias("dist_km"))


@query(f"""
    WITH s AS (SELECT c_custkey AS site_id, {_spread_sql('c_custkey', 0)} FROM customer),
    p AS (SELECT s_suppkey AS station_id, {_spread_sql('s_suppkey', 2)} FROM supplier),
    d AS (SELECT site_id, station_id, round({_HAV}, 6) AS dist_km FROM s, p WHERE {_HAV} <= 300)
    SELECT site_id, station_id, dist_km, CAST(row_number() OVER (PARTITION BY site_id ORDER BY dist_km, station_id) AS INTEGER) AS rank FROM d QUALIFY rank <= 10
""")
def ten_nearest_suppliers(t: Tables) -> DataFrame:
    """The ten nearest suppliers of every customer within 300 km."""
    sites = t.customer.select(F.col("c_custkey").alias("site_id"), *spread("c_custkey", 0))
    stations = t.supplier.select(F.col("s_suppkey").alias("station_id"), *spread("s_suppkey", 2))
    return nearest_stations(sites, stations, 300, 10).select("site_id", "station_id", "dist_km", "rank")


@query(f"""
    WITH v AS (SELECT * FROM (VALUES ('air_temperature', 400), ('precipitation', 200)) x(variable, radius)),
    s AS (SELECT c_custkey AS site_id, CASE c_custkey % 3 WHEN 0 THEN DATE '1994-03-01' WHEN 1 THEN DATE '1996-06-01' ELSE DATE '1997-07-01' END AS d, {_spread_sql('c_custkey', 0)} FROM customer),
    p AS (SELECT s_suppkey AS station_id, make_date((1993 + s_suppkey % 5)::INT, 1, 1) AS start_date, {_spread_sql('s_suppkey', 2)} FROM supplier),
    near AS (SELECT site_id, station_id, variable, round({_HAV}, 6) AS dist_km FROM s, p, v WHERE start_date <= d AND {_HAV} <= radius)
    SELECT site_id, variable, station_id, dist_km FROM near QUALIFY row_number() OVER (PARTITION BY site_id, variable ORDER BY dist_km, station_id) <= 3
""")
def three_nearest_valid_suppliers(t: Tables) -> DataFrame:
    """The three nearest suppliers of every customer that are open on the customer's date, for each variable's radius."""
    days = F.array(*[F.lit(d).cast("date") for d in ("1994-03-01", "1996-06-01", "1997-07-01")])
    sites = t.customer.select(
        F.col("c_custkey").alias("site_id"), F.get(days, (F.col("c_custkey") % 3).cast("int")).alias("min_date"), *spread("c_custkey", 0)
    )
    stations = t.supplier.select(
        F.col("s_suppkey").alias("station_id"), F.explode(F.array(*[F.lit(p["variable"]) for p in PARAMS])).alias("variable"), F.lit("hourly").alias("res"),
        F.make_date((1993 + F.col("s_suppkey") % 5).cast("int"), F.lit(1), F.lit(1)).alias("start_date"), F.lit("2009-12-31").cast("date").alias("end_date"),
        *spread("s_suppkey", 2),
    )
    found = w.find_stations(sites, stations, PARAMS, nearest=3)
    return found.select("site_id", "variable", "station_id", "dist_km")


PARAMS = [
    {"variable": "air_temperature", "max_radius": 400, "res": ["hourly"], "repo_vars": ["TT_TU"]},
    {"variable": "precipitation", "max_radius": 200, "res": ["daily", "hourly"], "repo_vars": ["R1"]},
]
WEATHER_MAP = [m for m in w.STATION_MAP if m["repo_var"] in ("TT_TU", "R1")]

# nations are the stations, their suppliers' shipments the readings, regions the sites
_STATION_SQL = f"""
    WITH st AS (SELECT n_nationkey AS station_id, n_name AS name, n_nationkey * 10.0 AS elev,
                       make_date(1995 + n_nationkey % 3, 1, 1) AS start_date, {_spread_sql('n_nationkey', 5)} FROM nation),
    si AS (SELECT r_regionkey AS site_id, {_spread_sql('(r_regionkey + 3)', 11)} FROM region),
    rd AS (SELECT s_nationkey AS station_id, CASE WHEN l_linenumber % 2 = 1 THEN 'air_temperature' ELSE 'precipitation' END AS variable,
                  l_shipdate::DATE AS day, l_quantity AS v
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
    cov AS (SELECT station_id, variable, year(day) AS year FROM rd GROUP BY 1, 2, 3
            HAVING bool_or(strftime(day, '%m%d') = '0101') AND bool_or(strftime(day, '%m%d') = '1231')),
    wanted AS (SELECT site_id, lat, lon, year FROM si, (SELECT DISTINCT year(o_orderdate) AS year FROM orders)),
    pairs AS (SELECT s.site_id, s.year, cov.variable, p.station_id, p.name, p.elev, p.lat, p.lon, round({_HAV}, 6) AS dist_km
              FROM wanted s JOIN cov USING (year) JOIN st p ON p.station_id = cov.station_id
              WHERE p.start_date <= make_date(s.year, 1, 1)),
    best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY site_id, year, variable ORDER BY dist_km, station_id) = 1),
    chosen AS (SELECT * FROM best WHERE dist_km <= CASE WHEN variable = 'precipitation' THEN 200 ELSE 400 END)
"""


def station_inputs(t: Tables) -> dict[str, DataFrame]:
    kinds = F.explode(F.array(*[F.lit(p["variable"]) for p in PARAMS])).alias("variable")
    stations = t.nation.select(
        F.col("n_nationkey").alias("station_id"),
        kinds,
        F.lit("hourly").alias("res"),
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") * 10.0).alias("elev"),
        F.make_date(1995 + F.col("n_nationkey") % 3, F.lit(1), F.lit(1)).alias("start_date"),
        F.lit("2009-12-31").cast("date").alias("end_date"),
        *spread("n_nationkey", 5),
    )
    sites = t.region.withColumn("k", F.col("r_regionkey") + 3).select(F.col("r_regionkey").alias("site_id"), *spread("k", 11))
    years = t.orders.select(F.year("o_orderdate").alias("year")).distinct()
    # the calendar years of the orders: a handful of numbers
    every = years.agg(F.collect_set("year")).scalar()
    wanted = sites.withColumn("years", every).select("site_id", "lat", "lon", F.explode("years").alias("year"))
    var = F.when(F.col("l_linenumber") % 2 == 1, "TT_TU").otherwise("R1")
    readings = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("station_id"), var.alias("var"), F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("value")
    )
    return {"wanted": wanted, "stations": stations, "readings": readings}


@query(
    _STATION_SQL
    + "SELECT site_id, year, variable, station_id, dist_km FROM chosen"
)
def chosen_stations(t: Tables) -> DataFrame:
    got = w.get_weather(**station_inputs(t), mapping=WEATHER_MAP, params=PARAMS)["stations"]
    return got.select("site_id", "year", "variable", "station_id", "dist_km")


@query(f"""
    WITH v AS (SELECT * FROM (VALUES ('air_temperature', 400), ('precipitation', 200)) x(variable, radius)),
    s AS (SELECT r_regionkey AS site_id, {_spread_sql('(r_regionkey + 3)', 11)} FROM region),
    p AS (SELECT n_nationkey AS station_id, make_date(1995 + n_nationkey % 3, 1, 1) AS start_date, {_spread_sql('n_nationkey', 5)} FROM nation),
    d AS (SELECT site_id, station_id, start_date, {_HAV} AS km FROM s, p)
    SELECT site_id, variable, station_id, round(km, 6) AS dist_km FROM d, v WHERE km <= radius AND start_date <= DATE '1996-06-01'
""")
def station_candidates(t: Tables) -> DataFrame:
    inputs = station_inputs(t)
    sites = inputs["wanted"].select("site_id", "lat", "lon").distinct().withColumn("min_date", F.lit("1996-06-01").cast("date"))
    got = w.find_stations(sites, inputs["stations"], PARAMS)
    return got.select("site_id", "variable", "station_id", F.round("dist_km", 6).alias("dist_km"))


@query(f"""
    WITH v AS (SELECT * FROM (VALUES ('air_temperature', 400), ('precipitation', 200)) x(variable, radius)),
    s AS (SELECT r_regionkey AS site_id, {_spread_sql('(r_regionkey + 3)', 11)} FROM region),
    p AS (SELECT n_nationkey AS station_id, make_date(1995 + n_nationkey % 3, 1, 1) AS start_date, {_spread_sql('n_nationkey', 5)} FROM nation),
    d AS (SELECT site_id, station_id, start_date, round({_HAV}, 6) AS km FROM s, p),
    c AS (SELECT site_id, variable, station_id, km AS dist_km FROM d, v WHERE km <= radius AND start_date <= DATE '1996-06-01')
    SELECT * FROM c QUALIFY dense_rank() OVER (PARTITION BY site_id, variable ORDER BY dist_km, station_id) <= 3
""")
def three_nearest_stations(t: Tables) -> DataFrame:
    inputs = station_inputs(t)
    sites = inputs["wanted"].select("site_id", "lat", "lon").distinct().withColumn("min_date", F.lit("1996-06-01").cast("date"))
    got = w.find_stations(sites, inputs["stations"], PARAMS, nearest=3)
    return got.select("site_id", "variable", "station_id", F.round("dist_km", 6).alias("dist_km"))


def moved_stations(t: Tables) -> DataFrame:
    """Stations that moved at the end of 1995, each period in two resolutions (one of them listed twice)."""
    stations = station_inputs(t)["stations"].drop("start_date", "end_date", "res")
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).cast("date").alias("start_date"), F.lit(b).cast("date").alias("end_date"), F.lit(m).alias("move"), F.lit(r).alias("res"))
        for a, b, m in (("1990-01-01", "1995-12-31", 0.0), ("1996-01-01", "2009-12-31", 0.3)) for r in ("hourly", "hourly", "daily")
    ])).alias("x")
    return stations.select("*", rows).select(*stations.columns, "x.*").withColumn("lat", F.col("lat") + F.col("move")).drop("move")


_MOVED_SQL = _STATION_SQL + f""",
    place AS (SELECT station_id, lat + move AS lat, lon, start_date, end_date FROM (SELECT station_id, lat, lon FROM st),
              (VALUES (DATE '1990-01-01', DATE '1995-12-31', 0.0::DOUBLE), (DATE '1996-01-01', DATE '2009-12-31', 0.3)) x(start_date, end_date, move)),
    near AS (SELECT s.site_id, s.year, cov.variable, p.station_id, p.lat AS st_lat, round({_HAV}, 6) AS dist_km
             FROM wanted s JOIN cov USING (year) JOIN place p ON p.station_id = cov.station_id AND s.year BETWEEN year(p.start_date) AND year(p.end_date)),
    nearest AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY site_id, year, variable ORDER BY dist_km, station_id) = 1)
"""


@query(_MOVED_SQL + """SELECT site_id, year, variable, station_id, round(st_lat, 6) AS st_lat, dist_km FROM nearest
    WHERE dist_km <= CASE WHEN variable = 'precipitation' THEN 200 ELSE 400 END""")
def chosen_moved_stations(t: Tables) -> DataFrame:
    inputs = station_inputs(t) | {"stations": moved_stations(t)}
    got = w.get_weather(**inputs, mapping=WEATHER_MAP, params=PARAMS)["stations"]
    return got.select("site_id", "year", "variable", "station_id", F.round("st_lat", 6).alias("st_lat"), "dist_km")


@query(f"""
    WITH v AS (SELECT * FROM (VALUES ('air_temperature', 400, 'hourly'), ('precipitation', 200, 'hourly'), ('precipitation', 200, 'daily')) x(variable, radius, res)),
    s AS (SELECT r_regionkey AS site_id, {_spread_sql('(r_regionkey + 3)', 11)} FROM region),
    p AS (SELECT station_id, lat + 0.3 AS lat, lon FROM (SELECT n_nationkey AS station_id, {_spread_sql('n_nationkey', 5)} FROM nation)),
    d AS (SELECT site_id, station_id, {_HAV} AS km FROM s, p)
    SELECT site_id, variable, station_id, res, round(km, 6) AS dist_km FROM d, v WHERE km <= radius
""")
def moved_station_candidates(t: Tables) -> DataFrame:
    sites = station_inputs(t)["wanted"].select("site_id", "lat", "lon").distinct().withColumn("min_date", F.lit("1996-06-01").cast("date"))
    got = w.find_stations(sites, moved_stations(t), PARAMS)
    return got.select("site_id", "variable", "station_id", "res", F.round("dist_km", 6).alias("dist_km"))


_DAILY_SQL = (
    _STATION_SQL
    + """, daily AS (SELECT station_id, variable, day, year(day) AS year, max(v) AS hi, min(v) AS lo, avg(v) AS mean, sum(v) AS total
               FROM rd GROUP BY 1, 2, 3),
    j AS (SELECT c.site_id, c.year, d.day,
                 max(CASE WHEN c.variable = 'air_temperature' THEN hi END) AS TMAX,
                 max(CASE WHEN c.variable = 'air_temperature' THEN lo END) AS TMIN,
                 max(CASE WHEN c.variable = 'air_temperature' THEN mean END) AS TMEAN,
                 max(CASE WHEN c.variable = 'precipitation' THEN total END) AS RAIN
          FROM chosen c JOIN daily d USING (station_id, variable, year) GROUP BY 1, 2, 3),
    l AS (SELECT site_id, year, day, u.name AS name, u.v AS v FROM j,
               LATERAL (VALUES ('TMAX', TMAX), ('TMIN', TMIN), ('TMEAN', TMEAN), ('RAIN', RAIN)) u(name, v)),
    g AS (SELECT *, row_number() OVER (PARTITION BY site_id, year, name ORDER BY day) AS i,
                 count(v) OVER (PARTITION BY site_id, year, name) AS n FROM l),
    s AS (SELECT *,
            last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER a AS i0, last_value(v IGNORE NULLS) OVER a AS v0,
            first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS i1, first_value(v IGNORE NULLS) OVER b AS v1
          FROM g WINDOW
            a AS (PARTITION BY site_id, year, name ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            b AS (PARTITION BY site_id, year, name ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    f AS (SELECT site_id, year, day, name, CASE WHEN v IS NOT NULL THEN v WHEN n < 2 THEN NULL
            WHEN v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * (i - i0) / (i1 - i0)
            ELSE coalesce(v0, v1) END AS v FROM s),
    wide AS (SELECT site_id, year, day, max(CASE WHEN name = 'TMAX' THEN v END) AS TMAX, max(CASE WHEN name = 'TMIN' THEN v END) AS TMIN,
                    max(CASE WHEN name = 'TMEAN' THEN v END) AS TMEAN, max(CASE WHEN name = 'RAIN' THEN v END) AS RAIN
             FROM f GROUP BY 1, 2, 3)
"""
)


@query(
    _DAILY_SQL
    + """SELECT site_id, year AS "Year", strftime(day, '%Y-%m-%d') AS W_DATE, coalesce(round(TMAX, 10), -99) AS TMAX,
        coalesce(round(TMIN, 10), -99) AS TMIN, coalesce(round(TMEAN, 10), -99) AS TMEAN, coalesce(round(RAIN, 10), -99) AS RAIN FROM wide"""
)
def site_weather_daily(t: Tables) -> DataFrame:
    data = w.get_weather(**station_inputs(t), mapping=WEATHER_MAP, params=PARAMS)["data"]
    cols = ["TMAX", "TMIN", "TMEAN", "RAIN"]
    return data.select("site_id", "Year", text_day("W_DATE"), *[F.coalesce(F.round(c, 10), F.lit(-99.0)).alias(c) for c in cols])


@query(
    _DAILY_SQL
    + """, tm AS (SELECT site_id, year, month(day) AS mo, avg((TMAX + TMIN) / 2) AS a, sum((TMAX + TMIN) / 2) AS s,
                         count((TMAX + TMIN) / 2) AS n FROM wide GROUP BY 1, 2, 3),
    ta AS (SELECT site_id, year, sum(s) / sum(n) AS TAV, (max(a) - min(a)) / 2 AS TAMP FROM tm GROUP BY 1, 2)
    SELECT c.site_id, c.year AS "Year",
           round(CASE WHEN min(station_id) = max(station_id) THEN max(lat) ELSE avg(lat) END, 6) AS WST_LAT,
           round(CASE WHEN min(station_id) = max(station_id) THEN max(lon) ELSE avg(lon) END, 6) AS WST_LONG,
           round(CASE WHEN min(station_id) = max(station_id) THEN max(elev) ELSE avg(elev) END, 6) AS WST_ELEV,
           coalesce(round(max(TAV), 10), -99) AS TAV, coalesce(round(max(TAMP), 10), -99) AS TAMP, 2.0::DOUBLE AS REFHT, 2.0::DOUBLE AS WNDHT
    FROM chosen c LEFT JOIN ta ON c.site_id = ta.site_id AND c.year = ta.year GROUP BY 1, 2
"""
)
def site_weather_header(t: Tables) -> DataFrame:
    head = w.get_weather(**station_inputs(t), mapping=WEATHER_MAP, params=PARAMS)["header"]
    return head.select(
        "site_id", "Year", *[F.round(c, 6).alias(c) for c in ("WST_LAT", "WST_LONG", "WST_ELEV")],
        *[F.coalesce(F.round(c, 10), F.lit(-99.0)).alias(c) for c in ("TAV", "TAMP")], "REFHT", "WNDHT",
    )


@query(
    _STATION_SQL
    + """SELECT site_id, year, station_id,
        string_agg(variable, ', ' ORDER BY variable) || ': Station ' || station_id || ' - ' || name || '; ELEV = '
        || printf('%.0f', elev) || ' m' AS comment
    FROM chosen GROUP BY site_id, year, station_id, name, elev"""
)
def station_sentences(t: Tables) -> DataFrame:
    got = w.get_weather(**station_inputs(t), mapping=WEATHER_MAP, params=PARAMS)["comments"]
    # coordinates and distance print differently in SQL; the compared part is cut out
    short = F.regexp_replace("comment", r" \([^;]*; ELEV = (\d+)\.0 m\).*$", "; ELEV = $1 m")
    return got.select("site_id", "year", "station_id", short.alias("comment"))


@query(
    _DAILY_SQL
    + """SELECT site_id, year AS "Year", strftime(day, '%Y-%m-%d') AS W_DATE, coalesce(round(TMAX, 10), -99) AS TMAX,
        coalesce(round(TMIN, 10), -99) AS TMIN, coalesce(round(TMEAN, 10), -99) AS TMEAN, coalesce(round(RAIN, 10), -99) AS RAIN FROM wide WHERE year >= 1996"""
)
def archive_weather_daily(t: Tables) -> DataFrame:
    """Weather from an archive in folders by year and variable, of which the years before 1996 are never opened."""
    inputs, path = station_inputs(t), scratch_path(t.spark, "archive")
    w.write_archive(inputs["readings"], path, PARAMS)
    wanted = inputs["wanted"].where("year >= 1996")
    data = w.archive_weather(path, wanted, inputs["stations"], WEATHER_MAP, PARAMS)["data"]
    cols = ["TMAX", "TMIN", "TMEAN", "RAIN"]
    return data.select("site_id", "Year", text_day("W_DATE"), *[F.coalesce(F.round(c, 10), F.lit(-99.0)).alias(c) for c in cols])


# --- archive, soil, phenology --------------------------------------------------------------------

@query("""
    SELECT l_suppkey AS station_id, year(l_shipdate) AS year, count(*) AS n, round(sum(l_quantity), 2) AS total
    FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 1997 GROUP BY 1, 2
""")
def archive_years(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "archive")
    landed = t.lineitem.select(
        F.col("l_suppkey").alias("station_id"), F.col("l_shipdate").alias("ts"), F.col("l_quantity").alias("value"), F.year("l_shipdate").alias("year")
    )
    landed.write.partitionBy("year").parquet(path)
    got = read_archive(t.spark, path, ["station_id", "year", "value"], 1996, 1997)
    return got.groupBy("station_id", "year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


def nation_areas(t: Tables) -> DataFrame:
    """Nations as neighbouring quadrangles, five by five, with a slanted western and eastern edge."""
    k = F.col("n_nationkey")
    x = 6 + (k % 5) * 2.0
    y = 46 + F.floor(k / 5) * 2.0

    def corner(px: Column, py: Column) -> Column:
        return F.struct(px.cast("double").alias("lon"), py.cast("double").alias("lat"))

    ring = F.array(corner(x, y), corner(x + 2, y), corner(x + 2.5, y + 2), corner(x + 0.5, y + 2), corner(x, y))
    return t.nation.select(F.col("n_name").alias("country"), ring.alias("ring"))


@query(f"""
    WITH p AS (SELECT s_suppkey, {_spread_sql('s_suppkey', 2)} FROM supplier),
    a AS (SELECT n_name, 6 + (n_nationkey % 5) * 2.0 AS x, 46 + (n_nationkey // 5) * 2.0 AS y FROM nation)
    SELECT s_suppkey, coalesce(max(n_name), '-') AS country FROM p LEFT JOIN a
      ON lat >= y AND lat < y + 2 AND lon >= x + (lat - y) / 4 AND lon < x + 2 + (lat - y) / 4 GROUP BY 1
""")
def country_of_point(t: Tables) -> DataFrame:
    points = t.supplier.select("s_suppkey", *spread("s_suppkey", 2))
    got = locate_points(points, nation_areas(t), ["country"])
    return got.select("s_suppkey", F.coalesce("country", F.lit("-")).alias("country"))


def region_areas(t: Tables) -> DataFrame:
    """Regions as a square with a hole, and a second square that lies across the date line."""

    def square(x: Column, y: Column, side: float, west: float = 0.0) -> Column:
        corners = ((0.0, 0.0), (side, 0.0), (side, side), (0.0, side), (0.0, 0.0))
        turned = [F.when(x + dx + west >= 180, x + dx + west - 360).otherwise(x + dx + west) for dx, _ in corners]
        return F.array(*[F.struct(px.cast("double").alias("lon"), (y + dy).cast("double").alias("lat")) for px, (_, dy) in zip(turned, corners)])

    k = F.col("r_regionkey")
    x, y = 6 + k * 1.5, F.lit(48.0) + k
    rings = F.array(square(x, y, 3.0), square(x + 1, y + 1, 1.0), square(F.lit(0.0), y, 2.0, 179.0))
    return t.region.select(F.col("r_name").alias("region"), k.alias("k"), rings.alias("rings"))


@query(f"""
    WITH s AS (SELECT c_custkey, {_spread_sql('c_custkey', 0)} FROM customer),
    p AS (SELECT c_custkey, lat, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN 172 + lon >= 180 THEN lon - 188 ELSE 172 + lon END ELSE lon END AS lon FROM s),
    r AS (SELECT r_regionkey AS k, r_name, 6 + r_regionkey * 1.5 AS x, 48.0 + r_regionkey AS y FROM region),
    hit AS (SELECT c_custkey, r_name, k FROM p, r
            WHERE (lat >= y AND lat < y + 3 AND lon >= x AND lon < x + 3 AND NOT (lat >= y + 1 AND lat < y + 2 AND lon >= x + 1 AND lon < x + 2))
               OR (lat >= y AND lat < y + 2 AND (lon >= 179 OR lon < -179)))
    SELECT p.c_custkey, coalesce(arg_min(r_name, k), '-') AS region FROM p LEFT JOIN hit ON p.c_custkey = hit.c_custkey GROUP BY 1
""")
def region_of_customer(t: Tables) -> DataFrame:
    """Customers in outlines with holes and parts, some of them across the date line; of several the smallest region key counts."""
    k, (lat, lon) = F.col("c_custkey"), spread("c_custkey", 0)
    far = F.when(lon + 172 >= 180, lon - 188).otherwise(lon + 172)
    points = t.customer.select("c_custkey", lat, F.when(k % 3 == 0, far).otherwise(lon).alias("lon"))
    got = locate_points(points, region_areas(t).select("rings", "k", "region"), ["k", "region"])
    return got.select("c_custkey", F.coalesce("region", F.lit("-")).alias("region"))


SOIL_MAP = [
    {"std_var": "SLB", "repo_var": "lodep", "conv_fct": 1.0},
    {"std_var": "SLCL", "repo_var": "clay", "conv_fct": 0.1},
    {"std_var": "SLOC", "repo_var": "soc", "conv_fct": 0.01},
]


def soil_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Parts as horizons of the nations: part type and size give depth and properties."""
    raw = t.part.select(
        (F.col("p_partkey") % 25).cast("string").alias("id"),
        F.concat((F.col("p_size") * 5 - 5).cast("string"), F.lit("-"), (F.col("p_size") * 5).cast("string")).alias("label"),
        F.col("p_retailprice").alias("claymean"),
        F.col("p_size").alias("socmean"),
    )
    sites = t.nation.select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("site"), F.lit("Test Farm").alias("trial_institution"), *spread("n_nationkey", 5)
    )
    return raw, sites


@query("""
    SELECT (p_partkey % 25)::VARCHAR AS id, (p_size * 5)::DOUBLE AS "SLB", round(p_retailprice * 0.1, 6) AS "SLCL",
           round((p_size * 0.01)::DOUBLE, 6) AS "SLOC" FROM part
""")
def soil_layers(t: Tables) -> DataFrame:
    raw, sites = soil_inputs(t)
    layers = format_soil(soil_horizons(raw, sites), sites, SOIL_MAP, nation_areas(t), year=2024)["SOL_Layers"]
    return layers.select("id", "SLB", F.round("SLCL", 6).alias("SLCL"), F.round("SLOC", 6).alias("SLOC"))


@query(f"""
    WITH p AS (SELECT n_nationkey, n_name, {_spread_sql('n_nationkey', 5)} FROM nation),
    a AS (SELECT n_name AS country, 6 + (n_nationkey % 5) * 2.0 AS x, 46 + (n_nationkey // 5) * 2.0 AS y FROM nation),
    d AS (SELECT p_partkey % 25 AS k, max(p_size * 5)::DOUBLE AS depth FROM part GROUP BY 1)
    SELECT n_nationkey::VARCHAR AS id,
           'TF' || substr(regexp_replace(n_name, '[^A-Z]', '', 'g'), 1, 2) || '2024' || lpad(n_nationkey::VARCHAR, 2, '0') AS "SOIL_ID",
           coalesce(country, '-') AS "COUNTRY", depth AS "SOIL_DEPTH"
    FROM p JOIN d ON k = n_nationkey
    LEFT JOIN a ON lat >= y AND lat < y + 2 AND lon >= x + (lat - y) / 4 AND lon < x + 2 + (lat - y) / 4
""")
def soil_header(t: Tables) -> DataFrame:
    raw, sites = soil_inputs(t)
    head = format_soil(soil_horizons(raw, sites), sites, SOIL_MAP, nation_areas(t), year=2024)["SOL_Surface"]
    return head.select("id", "SOIL_ID", F.coalesce("COUNTRY", F.lit("-")).alias("COUNTRY"), "SOIL_DEPTH")


@query("""
    WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y, c_nationkey AS k, o_orderpriority AS p, o_orderdate::DATE AS d,
                      o_orderkey % 3 = 0 AS known FROM orders JOIN customer ON o_custkey = c_custkey),
    e AS (SELECT o_orderkey, p, known, CASE WHEN known THEN d
            WHEN p LIKE '1%' OR p LIKE '3%' THEN make_date(y, 1, 1) + (199 + k)::INT
            WHEN p LIKE '2%' THEN make_date(y, 1, 1) + (249 + k)::INT END AS m FROM o)
    SELECT o_orderkey, coalesce(strftime(m, '%Y-%m-%d'), '-') AS "MDAT",
           coalesce(strftime(m - CASE WHEN p LIKE '2%' AND NOT known THEN 50 ELSE 40 END, '%Y-%m-%d'), '-') AS "ADAT" FROM e
""")
def phenology_dates(t: Tables) -> DataFrame:
    crop = F.create_map(*[F.lit(x) for x in ("1-URGENT", "WHT", "2-HIGH", "MAZ", "3-MEDIUM", "BAR", "4-NOT SPECIFIED", "SBT", "5-LOW", "RAP")])
    summary = null_safe_join(
        t.orders, t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), ["o_custkey"]
    ).select(
        "o_orderkey", F.year("o_orderdate").alias("Year"), "c_nationkey", F.try_element_at(crop, F.col("o_orderpriority")).alias("CRID"),
        F.when(F.col("o_orderkey") % 3 == 0, F.to_date("o_orderdate")).alias("MDAT"),
    )
    kinds = F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.lit(i).alias("i"), F.lit(d).alias("d"))
        for c, d in (("Winter_Wheat", 200), ("Maize", 250)) for i in ("Rainfed", "Irrigated")
    ])).alias("x")
    calendar = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), kinds).select(
        "c_nationkey", F.col("x.c").alias("calendar_crop"), F.col("x.i").alias("irrigation"), (F.col("x.d") + F.col("c_nationkey")).alias("maturity_doy")
    )
    out = estimate_phenology(summary, calendar, ["c_nationkey"])
    day = {c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("-")).alias(c) for c in ("MDAT", "ADAT")}
    return out.select("o_orderkey", *day.values())
