"""Daily weather from sub-daily station readings: aggregate, choose stations, fill, summarise."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroloom.functions.aggregates import aggregate
from agroloom.functions.dates import archive_period
from agroloom.operators.columns import within_years
from agroloom.operators.profile import NUMBERS
from agroloom.operators.scale import null_safe_join, range_parts
from agroloom.operators.stations import nearest_station, nearest_stations, stations_within
from agroloom.session import checkpointed


def _rows(names: tuple[str, ...], rows: list[tuple]) -> list[dict]:
    return [dict(zip(names, r)) for r in rows]


_MAP = ("std_var", "repo_var", "agg_fun", "conv_fct")

# Station archive to standard weather variables. The order of the sources of one
# variable is their priority. Radiation comes in J/cm2, wind in m/s.
STATION_MAP = _rows(
    _MAP,
    [
        ("SRAD", "FG", "sum", 0.01),
        ("SRAD", "FG_LBERG", "sum", 0.01),
        ("SRAD", "FG_STRAHL", "identity", 0.01),
        ("TMAX", "TT_TU", "max", 1.0),
        ("TMIN", "TT_TU", "min", 1.0),
        ("TMEAN", "TT_TU", "mean", 1.0),
        ("RAIN", "R1", "sum", 1.0),
        ("RAIN", "RS", "identity", 1.0),
        ("TDEW", "TT", "mean", 1.0),
        ("WIND", "F", "mean", 86.4),
        ("PARD", None, None, None),
        ("EVAP", None, None, None),
        ("RHAVD", "RF_STD", "mean", 1.0),
    ],
)

# Satellite product to standard weather variables.
SATELLITE_MAP = _rows(
    _MAP,
    [
        ("SRAD", "ALLSKY_SFC_SW_DWN", "sum", 1.0),
        ("TMAX", "T2M", "max", 1.0),
        ("TMIN", "T2M", "min", 1.0),
        ("RAIN", "PRECTOTCORR", "sum", 1.0),
        ("TDEW", "T2MDEW", "mean", 1.0),
        ("WIND", "WS2M", "mean", 86.4),
        ("PARD", "ALLSKY_SFC_PAR_TOT", "sum", 0.01656),
        ("EVAP", None, None, None),
        ("RHAVD", "RH2M", "mean", 1.0),
    ],
)

# Standard name -> name in the model files.
MODEL_NAMES = {"W_DATE": "DATE", "TDEW": "DEWP", "PARD": "PAR", "RHAVD": "RHUM"}

# Variable, search radius in km, resolutions in use, archive variables.
STATION_PARAMS = [
    {"variable": "air_temperature", "max_radius": 50, "res": ["hourly"], "repo_vars": ["TT_TU"]},
    {"variable": "precipitation", "max_radius": 10, "res": ["daily", "hourly"], "repo_vars": ["R1", "RS"]},
    {"variable": "solar_radiation", "max_radius": 50, "res": ["daily", "hourly"], "repo_vars": ["FG", "FG_LBERG", "FG_STRAHL"]},
    {"variable": "dewpoint", "max_radius": 20, "res": ["hourly"], "repo_vars": ["TT"]},
    {"variable": "relative_humidity", "max_radius": 20, "res": ["hourly"], "repo_vars": ["RF_STD"]},
    {"variable": "wind_speed", "max_radius": 20, "res": ["hourly"], "repo_vars": ["F"]},
]


def _targets(mapping: list[dict]) -> dict[str, list[dict]]:
    out: dict[str, list[dict]] = {}
    for m in mapping:
        out.setdefault(m["std_var"], []).append(m)
    return out


def _first_source(exprs: list[Column], name: str) -> Column:
    return (F.coalesce(*exprs) if exprs else F.lit(None).cast("double")).alias(name)


def daily_weather(
    readings: DataFrame, ts: str, mapping: list[dict], by: list[str], date: str = "W_DATE", nulls: str = "poison"
) -> DataFrame:
    """Daily values of wide readings (one column per archive variable), one grouped pass.

    A target with several sources takes the first that has a value; one without a source is
    a null column.
    """
    day = F.to_date(ts).alias(date)
    exprs = []
    for target, sources in _targets(mapping).items():
        usable = [m for m in sources if m["repo_var"] in readings.columns]
        exprs.append(
            _first_source(
                [aggregate(F.col(m["repo_var"]), m["agg_fun"], nulls) * F.lit(float(m["conv_fct"])) for m in usable],
                target,
            )
        )
    return readings.filter(F.col(ts).isNotNull()).groupBy(*by, day).agg(*exprs)


def daily_from_long(
    readings: DataFrame,
    mapping: list[dict],
    by: list[str],
    ts: str = "ts",
    var: str = "var",
    value: str = "value",
    date: str = "W_DATE",
    nulls: str = "poison",
) -> DataFrame:
    """Daily values of long readings (variable, value), all variables in one grouped pass."""
    exprs = []
    for target, sources in _targets(mapping).items():
        parts = [
            aggregate(F.col(value), m["agg_fun"], nulls, where=F.col(var) == m["repo_var"]) * F.lit(float(m["conv_fct"]))
            for m in sources
            if m["repo_var"]
        ]
        exprs.append(_first_source(parts, target))
    return readings.filter(F.col(ts).isNotNull()).groupBy(*by, F.to_date(ts).alias(date)).agg(*exprs)


def daily_stats(readings: DataFrame, ts: str, value: str, by: list[str], day: str = "day") -> DataFrame:
    """Daily minimum, maximum and mean of a sensor, missing readings skipped."""
    return readings.groupBy(*by, F.to_date(ts).alias(day)).agg(
        F.min(value).alias("TMIN"), F.max(value).alias("TMAX"), F.avg(value).alias("TMEAN")
    )


def impute(
    df: DataFrame, by: list[str], date: str, columns: list[str] | None = None, rule: int = 2, position: str = "row", single: str = "null"
) -> DataFrame:
    """Linear interpolation of numeric columns inside a group, e.g. a station year.

    ``rule=2`` gives the ends the nearest value, ``rule=1`` leaves them null. Positions are row
    numbers by date, or day numbers with ``position="day"``. A column with one value stays as
    it is unless ``single="fill"``.

    ``by`` and ``date`` together must be unique; with the year in ``by`` a group has 366 rows at
    most, which is what lets a window do this at any number of stations.
    """
    cols = columns or [f.name for f in df.schema if f.name not in [*by, date] and isinstance(f.dataType, NUMBERS)]
    ahead = Window.partitionBy(*by).orderBy(F.col(date).asc())
    back = Window.partitionBy(*by).orderBy(F.col(date).desc())
    spot = F.row_number().over(ahead) if position == "row" else F.datediff(F.col(date), F.lit("1970-01-01"))
    out = df.withColumn("__i", spot)

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(c).cast("double").alias("v")))

    # both frames grow row by row, so the cost is linear in the group
    out = out.withColumns(
        {f"__p_{c}": F.last(known(c), ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, 0)) for c in cols}
        | {f"__q_{c}": F.last(known(c), ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)) for c in cols}
        | {f"__n_{c}": F.count(c).over(Window.partitionBy(*by)) for c in cols}
    )

    def filled(c: str) -> Column:
        p, q = F.col(f"__p_{c}"), F.col(f"__q_{c}")
        line = p["v"] + (q["v"] - p["v"]) * (F.col("__i") - p["i"]) / (q["i"] - p["i"])
        inner = F.when(p.isNotNull() & q.isNotNull(), line)
        value = F.coalesce(inner, p["v"], q["v"]) if rule == 2 else inner
        enough = F.lit(True) if single == "fill" else F.col(f"__n_{c}") > 1
        return F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(enough, value)

    helpers = [f"__{k}_{c}" for c in cols for k in "pqn"]
    return out.withColumns({c: filled(c) for c in cols}).drop("__i", *helpers).select(*df.columns)


def impute_long(
    df: DataFrame, by: list[str], date: str, columns: list[str] | None = None, rule: int = 2, position: str = "row", single: str = "null"
) -> DataFrame:
    """As :func:`impute`, for groups of any length: one station with ten million rows fills in several tasks.

    The rows lie in range partitions of (``by``, ``date``). Each partition fills what lies between its own known points and is summarised, per
    group, by its rows and its first and last known point of every column; the last point before a partition and the first one behind it are
    carried over these summaries, a row per group and partition, and settle the gaps at its ends. ``by`` and ``date`` together must
    be unique.
    """
    by = list(by)
    cols = columns or [f.name for f in df.schema if f.name not in [*by, date] and isinstance(f.dataType, NUMBERS)]
    parts = range_parts(df, [F.col(c).asc_nulls_last() for c in [*by, date]])
    ahead = Window.partitionBy(*by, "__part").orderBy(F.col(date).asc_nulls_last())
    spot = F.row_number().over(ahead) if position == "row" else F.datediff(F.col(date), F.lit("1970-01-01"))
    placed = parts.withColumn("__i", spot.cast("long"))

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(c).cast("double").alias("v")))

    ends = {f"__a_{c}": F.min_by(known(c), F.when(F.col(c).isNotNull(), F.col("__i"))) for c in cols}
    ends |= {f"__b_{c}": F.max_by(known(c), F.when(F.col(c).isNotNull(), F.col("__i"))) for c in cols}
    counts = {f"__n_{c}": F.count(c) for c in cols}
    summary = placed.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__rows"), *[v.alias(k) for k, v in {**ends, **counts}.items()])
    # a row per group and partition: few, however long the group
    order = Window.partitionBy(*by).orderBy("__part")
    before, behind = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    offset = F.coalesce(F.sum("__rows").over(before), F.lit(0)) if position == "row" else F.lit(0)
    summary = summary.withColumn("__off", offset.cast("long"))

    def moved(p: str) -> Column:
        """An end point with its position in the whole group."""
        return F.when(F.col(p).isNotNull(), F.struct((F.col(f"{p}.i") + F.col("__off")).alias("i"), F.col(f"{p}.v").alias("v")))

    summary = summary.withColumns({p: moved(p) for p in ends})
    carried = {f"__p_{c}": F.last(f"__b_{c}", ignorenulls=True).over(before) for c in cols}
    carried |= {f"__q_{c}": F.first(f"__a_{c}", ignorenulls=True).over(behind) for c in cols}
    carried |= {f"__t_{c}": F.sum(f"__n_{c}").over(Window.partitionBy(*by)) for c in cols}
    edges = summary.withColumns(carried).select(*by, "__part", "__off", *carried)
    rows = null_safe_join(placed, edges, [*by, "__part"]).withColumn("__i", F.col("__i") + F.col("__off"))
    back = Window.partitionBy(*by, "__part").orderBy(F.col(date).desc_nulls_first())
    to_here = Window.unboundedPreceding, 0

    def filled(c: str) -> Column:
        p = F.coalesce(F.last(known(c), ignorenulls=True).over(ahead.rowsBetween(*to_here)), F.col(f"__p_{c}"))
        q = F.coalesce(F.last(known(c), ignorenulls=True).over(back.rowsBetween(*to_here)), F.col(f"__q_{c}"))
        line = p["v"] + (q["v"] - p["v"]) * (F.col("__i") - p["i"]) / (q["i"] - p["i"])
        inner = F.when(p.isNotNull() & q.isNotNull(), line)
        value = F.coalesce(inner, p["v"], q["v"]) if rule == 2 else inner
        enough = F.lit(True) if single == "fill" else F.col(f"__t_{c}") > 1
        return F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(enough, value)

    out = rows.withColumns({f"__f_{c}": filled(c) for c in cols})
    return out.select(*[F.col(f"__f_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def annual_summary(daily: DataFrame, by: list[str], date: str = "W_DATE", high: str = "TMAX", low: str = "TMIN") -> DataFrame:
    """Mean temperature (``TAV``) and half the range of the monthly means (``AMP``).

    Sums and counts go up from month to year, so the rows are grouped once.
    """
    mean = (F.col(high) + F.col(low)) / 2
    monthly = daily.groupBy(*by, F.month(date).alias("__mo")).agg(F.sum(mean).alias("s"), F.count(mean).alias("n"))
    of_month = F.try_divide(F.col("s"), F.col("n"))
    return monthly.groupBy(*by).agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("TAV"), ((F.max(of_month) - F.min(of_month)) / 2).alias("AMP")
    )


def monthly_climate(daily: DataFrame, by: list[str], date: str = "W_DATE", temp: str = "TMEAN", rain: str = "RAIN") -> DataFrame:
    """Mean temperature and total rain per month."""
    return daily.groupBy(*by, F.month(date).alias("month")).agg(F.avg(temp).alias("mean_temp"), F.sum(rain).alias("total_rain"))


def coverage(readings: DataFrame, by: list[str], ts: str = "ts") -> DataFrame:
    """(by, year) with readings on both January 1 and December 31."""
    day = F.date_format(ts, "MMdd")
    edge = readings.withColumn("__md", day).filter(F.col("__md").isin("0101", "1231"))
    return (
        edge.groupBy(*by, F.year(ts).alias("year"))
        .agg(F.bool_or(F.col("__md") == "0101").alias("a"), F.bool_or(F.col("__md") == "1231").alias("b"))
        .filter("a AND b")
        .select(*by, "year")
    )


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def choose_stations(
    wanted: DataFrame,
    stations: DataFrame,
    covered: DataFrame,
    params: list[dict] = STATION_PARAMS,
    today: Column | None = None,
) -> DataFrame:
    """The nearest station per site, year and variable that is valid and has data all year.

    ``wanted``: site_id, lat, lon, year; ``stations``: station_id, variable, res, lat, lon,
    start_date, end_date and, if the archive is split by age, per (historical or recent, blank
    counts as historical); ``covered``: station_id, variable, year. Without a usable station the
    site, year and variable are absent.
    """
    radius = _lookup({p["variable"]: float(p["max_radius"]) for p in params})
    allowed = _lookup({f"{p['variable']}/{r}": True for p in params for r in p["res"]})
    usable = stations.filter(F.coalesce(F.try_element_at(allowed, F.concat_ws("/", "variable", "res")), F.lit(False)))
    period = [c for c in ("per",) if c in usable.columns]
    spans = usable.select("station_id", "variable", "lat", "lon", "start_date", "end_date", *period)
    on = null_safe_join(covered, spans, ["station_id", "variable"], "inner")
    first, last = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    fits = (F.col("start_date") <= first) & (F.col("end_date") >= last)
    if "per" in usable.columns:
        fits = fits & (F.coalesce(F.nullif("per", F.lit("")), F.lit("historical")) == archive_period(first, today))
    # a moved station stands where it stood in the period that covers the year; of several rows the longest, then latest
    place = F.max_by(F.struct("lat", "lon"), F.struct(F.date_diff("end_date", "start_date"), "end_date", "lat", "lon"))
    candidates = on.filter(fits).groupBy("station_id", "variable", "year").agg(place.alias("p")).select("station_id", "variable", "year", "p.lat", "p.lon")
    names = F.array(*[F.lit(p["variable"]) for p in params])
    asked = wanted.select("site_id", "lat", "lon", "year").distinct().withColumn("variable", F.explode(names))
    best = nearest_station(asked, candidates, max(p["max_radius"] for p in params), ["variable", "year"])
    return best.filter(F.col("dist_km") <= F.try_element_at(radius, F.col("variable")))


def valid_on(stations: DataFrame, on_date: Column, today: Column | None = None) -> Column:
    """Whether a station's period covers a date and, if the archive is split by age, is the part that holds it."""
    valid = (F.col("start_date") <= on_date) & (F.col("end_date") >= on_date)
    if "per" in stations.columns:
        age = F.coalesce(F.nullif("per", F.lit("")), F.lit("historical"))
        valid = valid & (age == archive_period(on_date, today))
    return valid


def on_dates(stations: DataFrame, asked: DataFrame, on_date: str) -> DataFrame:
    """Stations with every asked date in their period: both meet on the years that a period covers."""
    years = F.sequence(F.year("start_date"), F.greatest(F.year("start_date"), F.year("end_date")))
    spans = stations.withColumn("__year", F.explode(years))
    days = asked.withColumn("__year", F.year(on_date))
    met = spans.join(days, "__year").drop("__year")
    return met.filter((F.col("start_date") <= F.col(on_date)) & (F.col("end_date") >= F.col(on_date)))


def find_stations(
    sites: DataFrame, stations: DataFrame, params: list[dict] = STATION_PARAMS, on_date: str = "min_date", today: Column | None = None, nearest: int | None = None
) -> DataFrame:
    """All stations of each variable within its radius and resolution that are valid on a date.

    ``sites``: site_id, lat, lon and the date; the columns of ``stations`` are those of
    :func:`choose_stations`. ``nearest`` limits the output to the places of that many stations per site, date and variable, found by
    a search that looks at no others; without it every station in reach is listed, which grows with both tables.
    """
    parts = []
    for p in params:
        own = stations.filter((F.col("variable") == p["variable"]) & F.col("res").isin(p["res"]))
        if nearest is None:
            # a place is searched once, then meets the periods and resolutions of its station there
            near = stations_within(sites, own.select("station_id", "lat", "lon").distinct(), p["max_radius"], station="station_id")
            rest = own.distinct().withColumnsRenamed({"lat": "st_lat", "lon": "st_lon"})
            found = null_safe_join(near, rest, ["station_id", "st_lat", "st_lon"], "inner")
            parts.append(found.filter(valid_on(stations, F.col(on_date), today)))
            continue
        # a station stands where it stands on the date; the dates in use are few next to the sites
        asked = checkpointed(sites.select(on_date).distinct())
        dated = on_dates(own.distinct(), asked, on_date).filter(valid_on(stations, F.col(on_date), today))
        places = dated.select(on_date, "station_id", "lat", "lon").distinct()
        near = nearest_stations(sites, places, p["max_radius"], nearest, [on_date]).drop("rank")
        rest = dated.withColumnsRenamed({"lat": "st_lat", "lon": "st_lon"})
        parts.append(null_safe_join(near, rest, [on_date, "station_id", "st_lat", "st_lon"], "inner"))
    return reduce(DataFrame.unionByName, parts)


def tagged_variable(params: list[dict] = STATION_PARAMS, var: str = "var") -> Column:
    """The variable that an archive name belongs to, null if none does."""
    return F.try_element_at(_lookup({v: p["variable"] for p in params for v in p["repo_vars"]}), F.col(var))


def write_archive(
    readings: DataFrame, path: str, params: list[dict] = STATION_PARAMS, files: int = 8, station: str = "station_id", ts: str = "ts"
) -> None:
    """Station readings in folders by year and variable, and beside them which station has which year as a whole.

    A folder holds ``files`` files at most, each with a share of its stations in order of station and time, so a reader skips
    folders by the years and variables that it wants, and row groups by station. ``edges`` keeps the result of :func:`coverage`, so
    choosing stations reads no reading.
    """
    rows = readings.withColumns({"year": F.year(ts), "variable": tagged_variable(params)}).filter("variable IS NOT NULL AND year IS NOT NULL")
    share = F.pmod(F.xxhash64(station), F.lit(files))
    placed = rows.withColumn("__share", share).repartition("year", "variable", "__share").sortWithinPartitions("year", "variable", station, ts)
    placed.drop("__share").write.partitionBy("year", "variable").parquet(f"{path}/readings")
    kept = readings.sparkSession.read.parquet(f"{path}/readings")
    coverage(kept, [station, "variable"], ts).write.parquet(f"{path}/edges")


def archive_readings(archive: DataFrame, chosen: DataFrame) -> DataFrame:
    """Readings of the chosen stations, years and variables; only the folders of chosen years and variables are listed and read.

    ``chosen`` (station_id, year, variable; kept) is a small table: its distinct years and variables, no more than the archive has
    folders, become the partition filter.
    """
    served = chosen.select("station_id", "variable", "year").distinct()
    years: dict[str, list[int]] = {}
    for r in served.select("variable", "year").distinct().collect():
        years.setdefault(r["variable"], []).append(r["year"])
    wanted = [(F.col("variable") == v) & F.col("year").isin(sorted(ys)) for v, ys in sorted(years.items())]
    pruned = archive.filter(reduce(lambda x, y: x | y, wanted, F.lit(False)))
    return pruned.join(served, ["station_id", "variable", "year"], "left_semi")


def archive_weather(
    path: str, wanted: DataFrame, stations: DataFrame, mapping: list[dict] = STATION_MAP, params: list[dict] = STATION_PARAMS, nulls: str = "poison"
) -> dict[str, DataFrame]:
    """As :func:`get_weather` from an archive that :func:`write_archive` wrote: stations are chosen by its kept edge days, and its
    readings are scanned once, in the chosen folders only."""
    spark = wanted.sparkSession
    archive = spark.read.parquet(f"{path}/readings")
    chosen = checkpointed(choose_stations(wanted, stations, spark.read.parquet(f"{path}/edges"), params))
    return site_weather(chosen, stations, archive_readings(archive, chosen), mapping, nulls)


def get_weather(
    wanted: DataFrame,
    stations: DataFrame,
    readings: DataFrame,
    mapping: list[dict] = STATION_MAP,
    params: list[dict] = STATION_PARAMS,
    nulls: str = "poison",
) -> dict[str, DataFrame]:
    """Daily weather, header and station choice for all sites and years in one plan.

    ``readings``: station_id, var (archive name), ts, value. Only those of stations in reach and of wanted years are looked at (the
    range of years reaches the scan), and only those of a chosen station, variable and year are aggregated, once for all the sites that
    it serves. The choice, one row per site, year and variable, is written to the checkpoint folder.
    """
    span = wanted.agg(F.min("year").alias("first"), F.max("year").alias("last")).first()
    if span["first"] is not None:
        readings = within_years(readings, "ts", int(span["first"]), int(span["last"]))
    tagged = readings.withColumn("variable", tagged_variable(params)).filter("variable IS NOT NULL")
    tagged = tagged.withColumn("year", F.year("ts")).join(wanted.select("year").distinct(), "year", "left_semi")
    places = stations.select("station_id", "lat", "lon").distinct()
    spots = wanted.select("lat", "lon").distinct()
    reach = stations_within(spots, places, max(p["max_radius"] for p in params)).select("station_id").distinct()
    tagged = tagged.join(reach, "station_id", "left_semi")
    chosen = checkpointed(choose_stations(wanted, stations, coverage(tagged, ["station_id", "variable"]), params))
    served = chosen.select("station_id", "variable", "year").distinct()
    used = tagged.join(served, ["station_id", "variable", "year"], "left_semi")
    return site_weather(chosen, stations, used, mapping, nulls)


def site_weather(chosen: DataFrame, stations: DataFrame, used: DataFrame, mapping: list[dict], nulls: str) -> dict[str, DataFrame]:
    """Weather of the sites from the readings of their chosen stations."""
    daily = daily_from_long(used, mapping, ["station_id", "variable"], nulls=nulls).withColumn("year", F.year("W_DATE"))
    picked = chosen.select("site_id", "year", "station_id", "variable")
    rows = null_safe_join(picked, daily, ["station_id", "variable", "year"], "inner")
    names = list(_targets(mapping))
    # each variable group fills its own columns, so the maximum is the one value there is
    merged = rows.groupBy("site_id", "year", "W_DATE").agg(*[F.max(n).alias(n) for n in names])
    filled = impute(merged, ["site_id", "year"], "W_DATE", names)
    summary = annual_summary(filled, ["site_id", "year"])
    facts = stations.groupBy("station_id", "variable").agg(
        F.min(F.struct("name", "elev")).alias("f")
    ).select("station_id", "variable", "f.name", "f.elev")
    described = null_safe_join(chosen, facts, ["station_id", "variable"])
    return {
        "data": filled.withColumnRenamed("year", "Year"),
        "header": weather_header(described, summary),
        "stations": described,
        "comments": station_comments(described),
    }


def weather_header(described: DataFrame, summary: DataFrame) -> DataFrame:
    """One header per site and year: the station's coordinates, or the mean over the variables."""

    def place(c: str) -> Column:
        one = F.min("station_id") == F.max("station_id")
        return F.when(one, F.max(c)).otherwise(F.avg(c))

    head = described.groupBy("site_id", "year").agg(
        place("st_lat").alias("WST_LAT"), place("st_lon").alias("WST_LONG"), place("elev").alias("WST_ELEV")
    )
    return (
        null_safe_join(head, summary, ["site_id", "year"])
        .withColumnsRenamed({"AMP": "TAMP", "year": "Year"})
        .withColumns({"REFHT": F.lit(2.0), "WNDHT": F.lit(2.0)})
    )


def station_comments(described: DataFrame) -> DataFrame:
    """One sentence per station of a site and year, naming its variables."""
    group = ["site_id", "year", "station_id", "name", "st_lat", "st_lon", "elev", F.round("dist_km", 1).alias("km")]
    # the variables of a station are a handful of fixed names
    named = described.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_set("variable")), ", ").alias("vars"))
    text = F.format_string(
        "%s: Station %s - %s (%s %s; ELEV = %s m); Distance from site: %s km",
        *[F.col(c).cast("string") for c in ("vars", "station_id", "name", "st_lat", "st_lon", "elev", "km")],
    )
    return named.select("site_id", "year", "station_id", text.alias("comment"))


def to_model_names(daily: DataFrame) -> DataFrame:
    return daily.withColumnsRenamed(MODEL_NAMES)
