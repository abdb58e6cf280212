"""Yearly sections, conformed tables and fixed-width lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroloom.operators.columns import drop_empty_rows
from agroloom.operators.mapping import code_lookup, map_data
from agroloom.operators.scale import dense_ids, null_safe_join
from agroloom.operators.weather import daily_weather, to_model_names
from agroloom.plans import export as ex
from agroloom.plans import templates as tpl
from agroloom.plans.sections import mid_elevation
from agroloom.queries import Tables, query
from agroloom.queries.trials import BASE_SQL, base, trial_bundle
from agroloom.session import scratch_path
from agroloom.sources import reports

BY = ["experiment_id"]


@query("""
    SELECT l_orderkey, l_linenumber, printf('%6.0f', l_quantity) || printf('%12.2f', l_extendedprice) || lpad(l_returnflag, 6, ' ')
        || CASE WHEN l_linenumber = 7 THEN '   -99' ELSE printf('%6d', l_linenumber) END AS line FROM lineitem
""")
def fixed_width_lines(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("no", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")))
    formats = {"l_quantity": "%6.0f", "l_extendedprice": "%12.2f", "l_returnflag": "%6s", "no": "%6s"}
    return rows.select("l_orderkey", "l_linenumber", ex.print_line(formats).alias("line"))


@query("""
    WITH d AS (SELECT o_orderstatus AS experiment_id, o_orderdate::DATE AS day, count(*) AS n, max(o_custkey) AS hi, min(o_custkey) AS lo FROM orders GROUP BY 1, 2)
    SELECT experiment_id, year(day) AS "Year",
           strftime(day, '%y%j') || printf('%6.1f', n::DOUBLE) || printf('%6.1f', hi::DOUBLE) || printf('%6.1f', lo::DOUBLE) || repeat('   -99', 6) AS line FROM d
    UNION ALL SELECT experiment_id, year(day), '@DATE  SRAD  TMAX  TMIN  RAIN  DEWP  WIND   PAR  EVAP  RHUM' FROM (SELECT DISTINCT experiment_id, make_date(year(day), 1, 1) AS day FROM d)
""")
def weather_file(t: Tables) -> DataFrame:
    raw = t.orders.select(F.col("o_orderstatus").alias("experiment_id"), F.col("o_orderdate").alias("ts"), F.col("o_custkey").cast("double").alias("v"), F.lit(1.0).alias("one"))
    rules = [("SRAD", "one", "sum"), ("TMAX", "v", "max"), ("TMIN", "v", "min"), ("RAIN", None, None), ("TDEW", None, None)]
    mapping = [{"std_var": s, "repo_var": r, "agg_fun": a, "conv_fct": 1.0} for s, r, a in rules]
    daily = to_model_names(daily_weather(raw, "ts", mapping, BY).withColumn("Year", F.year("W_DATE")))
    lines = ex.text_lines(ex.build_weather(daily, BY), tpl.WEATHER_FORMATS, [*BY, "Year"], ["DATE"], 0)
    path = scratch_path(t.spark, "weather")
    ex.write_text(lines, path, [*BY, "Year"])
    back = t.spark.read.text(path)
    return back.select("experiment_id", F.col("Year").cast("long").alias("Year"), F.col("value").alias("line"))


_SECTIONS_SQL = f"""
    WITH {BASE_SQL}, n AS (SELECT DISTINCT experiment_id, y, f2, trt FROM base)
"""


def section_tables(t: Tables) -> dict[str, DataFrame]:
    """Treatments, fertilizers and cultivars of the trials in model names, ids over all years."""
    b = base(t)
    key = [F.col("experiment_id"), F.col("y").alias("Year")]
    number = (F.col("y") - 1990) * 4 + F.col("f2")
    return {
        "TREATMENTS": b.select(*key, F.col("trt").alias("N"), F.concat(F.lit("T"), F.col("trt").cast("string")).alias("TNAME"), number.alias("MF"), F.lit(None).cast("double").alias("CU")).distinct(),
        "CULTIVARS": b.select(*key, (F.col("y") - 1980).alias("C"), F.lit("WH").alias("CR"), F.lit("IB9999").alias("INGENO")).distinct(),
        "FERTILIZERS": b.select(
            *key, number.alias("F"), F.date_format(F.make_date("y", F.lit(4), F.col("f2").cast("int")), "yyyy-MM-dd").alias("FDATE"), F.lit("FE041").alias("FMCD"),
            (F.col("f2") * 50).alias("FAMN"), F.lit(None).cast("string").alias("FACD"),
        ).distinct(),
        "FIELDS": b.select("experiment_id", F.lit(1).alias("L"), F.lit("IB00000001").alias("ID_SOIL")).distinct(),
        "PLANTING_DETAILS": b.select(*key, F.lit(1).alias("P"), F.date_format(F.make_date("y", F.lit(3), F.lit(20)), "yyyy-MM-dd").alias("PDATE")).distinct(),
        "OBSERVED_Summary": b.select(*key, F.col("trt").alias("TRTNO")).distinct(),
    }


def management(t: Tables) -> dict[str, DataFrame]:
    yearly = ex.split_by_year(section_tables(t), BY)
    return ex.build_management(yearly, BY)[0]


@query(
    _SECTIONS_SQL
    + """SELECT experiment_id, y AS "Year", trt::DOUBLE AS "N", 'T' || trt AS "TNAME", f2::DOUBLE AS "MF", 0.0::DOUBLE AS "CU", 1.0::DOUBLE AS "R", 0.0::DOUBLE AS "MH", 1.0::DOUBLE AS "SM" FROM n"""
)
def yearly_treatments(t: Tables) -> DataFrame:
    return management(t)["TREATMENTS"].select(*BY, F.col("Year").cast("long").alias("Year"), "N", "TNAME", "MF", "CU", "R", "MH", "SM")


@query(
    _SECTIONS_SQL
    + """, f AS (SELECT DISTINCT experiment_id, y, f2 FROM n), s AS (SELECT DISTINCT experiment_id, y FROM n)
    SELECT experiment_id, y AS "Year", '' AS line FROM s
    UNION ALL SELECT experiment_id, y, '*FERTILIZERS (INORGANIC)' FROM s
    UNION ALL SELECT experiment_id, y, '@F FDATE  FMCD  FACD  FDEP  FAMN  FAMP  FAMK  FAMC  FAMO  FOCD FERNAME' FROM s
    UNION ALL SELECT experiment_id, y, printf('%2d', f2::INT) || ' ' || strftime(make_date(y::INT, 4, f2::INT), '%y%j') || ' FE041   -99   -99' || printf('%6d', (f2 * 50)::INT)
        || repeat('   -99', 5) || ' -99' FROM f"""
)
def fertilizer_block(t: Tables) -> DataFrame:
    section = management(t)["FERTILIZERS"]
    lines = ex.management_lines({"FERTILIZERS": section}, [*BY, "Year"])
    return lines.select("experiment_id", F.col("Year").cast("long").alias("Year"), "line")


_PIPELINE_MAP = [
    dict(zip(("table_name", "column_header", "column_unit", "std_header", "std_unit", "code_mappings"), r))
    for r in [
        ("FERTILIZERS", "FE_ID", "", "F", "text", ""),
        ("FERTILIZERS", "DUENGUNG__Termin", "date", "FDATE", "date", ""),
        ("FERTILIZERS", "DUENGUNG__Menge", "g/m2", "FAMN", "kg/ha", ""),
        ("FERTILIZERS", "DUENGEMITTEL__Mittel", "", "FMCD", "code", "list('fert1: FE041', 'fert2: FE005')"),
    ]
]


@query(
    f"""WITH {BASE_SQL}, f AS (SELECT DISTINCT experiment_id, y, f1, f2 FROM base), s AS (SELECT DISTINCT experiment_id, y FROM base)
    SELECT experiment_id, y AS "Year", '*EXP.DETAILS: Trial ' || experiment_id AS line FROM s
    UNION ALL SELECT experiment_id, y, '' FROM s
    UNION ALL SELECT experiment_id, y, '*FERTILIZERS (INORGANIC)' FROM s
    UNION ALL SELECT experiment_id, y, '@F FDATE  FMCD  FACD  FDEP  FAMN  FAMP  FAMK  FAMC  FAMO  FOCD FERNAME' FROM s
    UNION ALL SELECT experiment_id, y, printf('%2d', ((f2 - 1) * 2 + f1)::INT) || ' ' || strftime(make_date(y::INT, 4, (f2 + 1)::INT), '%y%j')
        || CASE f1 WHEN 1 THEN ' FE041' ELSE ' FE005' END || '   -99   -99' || printf('%6d', (f2 * 500)::INT) || repeat('   -99', 5) || ' -99' FROM f"""
)
def trial_file(t: Tables) -> DataFrame:
    """From undocumented tables to the lines of the management file."""
    got = trial_bundle(t)
    numbered = dense_ids(got["DUENGUNG"], ["Year", "DUENGUNG__Menge", "DUENGEMITTEL__Mittel"], "FE_ID", BY)
    codes = t.spark.createDataFrame([m for m in _PIPELINE_MAP if m["std_unit"] == "code"])
    lookup = code_lookup(codes.select("table_name", "std_header", "code_mappings"))
    mapped = map_data(numbered, "FERTILIZERS", _PIPELINE_MAP, lookup, keep_unmapped=False, exempt=[*BY, "Year"])
    section, _ = ex.build_management(ex.split_by_year({"FERTILIZERS": mapped}, BY), BY)
    years = section["FERTILIZERS"].select(*BY, "Year").distinct()
    titles = null_safe_join(years, got["HEADER"].select(*BY, "EXP_DETAILS"), BY)
    lines = ex.management_lines({"FERTILIZERS": section["FERTILIZERS"]}, [*BY, "Year"], titles)
    path = scratch_path(t.spark, "trial")
    ex.write_text(lines, path, [*BY, "Year"])
    return t.spark.read.text(path).select("experiment_id", F.col("Year").cast("long").alias("Year"), F.col("value").alias("line"))


@query(
    _SECTIONS_SQL
    + """, s AS (SELECT DISTINCT experiment_id, e, y FROM base), l AS (SELECT DISTINCT experiment_id, e, y, block FROM base)
    SELECT experiment_id, y AS "Year", '' AS line FROM s
    UNION ALL SELECT experiment_id, y, '*FIELDS' FROM s
    UNION ALL SELECT experiment_id, y, '@L ID_FIELD WSTA....  FLSA  FLOB  FLDT  FLDD  FLDS  FLST SLTX  SLDP  ID_SOIL    FLNAME' FROM s
    UNION ALL SELECT experiment_id, y, printf('%2d', block::INT) || ' -99      SEDE    ' || repeat('   -99', 6) || ' -99    -99  IB00000001 -99' FROM l
    UNION ALL SELECT experiment_id, y, '@L ...........XCRD ...........YCRD .....ELEV .............AREA .SLEN .FLWR .SLAS FLHST FHDUR' FROM s
    UNION ALL SELECT experiment_id, y, printf('%2d', block::INT) || lpad(printf('%.6f', 12.41893 + e / 100000 + block / 1000000), 16, ' ')
        || lpad(printf('%.6f', 51.40188 + e / 100000), 16, ' ') || lpad(printf('%.1f', 100.5 + block), 10, ' ') || lpad('-99', 18, ' ') || repeat('   -99', 5) FROM l"""
)
def fields_block(t: Tables) -> DataFrame:
    b = base(t)
    e, block = F.col("e"), F.col("block")
    fields = b.select(
        "experiment_id", block.cast("double").alias("L"), F.lit("SEDE").alias("WSTA"), F.lit("IB00000001").alias("ID_SOIL"),
        (12.41893 + e / 100000 + block / 1000000).alias("XCRD"), (51.40188 + e / 100000).alias("YCRD"), (100.5 + block).alias("ELEV"),
    ).distinct()
    section = ex.build_management({"TREATMENTS": section_tables(t)["TREATMENTS"], "FIELDS": fields}, BY)[0]["FIELDS"]
    lines = ex.management_lines({"FIELDS": section}, [*BY, "Year"])
    return lines.select("experiment_id", F.col("Year").cast("long").alias("Year"), "line")


@query(
    _SECTIONS_SQL
    + """, s AS (SELECT DISTINCT experiment_id, y FROM base), k AS (SELECT unnest([
        '', '*SIMULATION CONTROLS',
        '@N GENERAL     NYERS NREPS START SDATE RSEED SNAME                     SMODEL  ', ' 1 GE              1     1     S   -99  2150 -99                       -99',
        '@N OPTIONS     WATER NITRO SYMBI PHOSP POTAS DISES  CHEM  TILL   CO2', ' 1 OP              N     N     N     N     N     N     N     N     M',
        '@N METHODS     WTHER INCON LIGHT EVAPO INFIL PHOTO HYDRO NSWIT MESOM MESEV MESOL', ' 1 ME              M     M     E     R     S     L     R     1     G     R     2',
        '@N MANAGEMENT  PLANT IRRIG FERTI RESID HARVS', ' 1 MA              R     N     N     N     M',
        '@N OUTPUTS     FNAME OVVEW SUMRY FROPT GROUT CAOUT WAOUT NIOUT MIOUT DIOUT VBOSE CHOUT OPOUT FMOPT',
        ' 1 OU              N     Y     Y     1     N     N     N     N     N     N     N     N     N     A',
        '@N PLANTING    PFRST PLAST PH2OL PH2OU PH2OD PSTMX PSTMN', ' 1 PL            -99   -99   -99   -99   -99   -99   -99',
        '@N IRRIGATION  IMDEP ITHRL ITHRU IROFF IMETH IRAMT IREFF', ' 1 IR            -99   -99   -99   -99   -99   -99   -99',
        '@N NITROGEN    NMDEP NMTHR NAMNT NCODE NAOFF', ' 1 NI            -99   -99   -99   -99   -99',
        '@N RESIDUES    RIPCN RTIME RIDEP', ' 1 RE            -99   -99   -99',
        '@N HARVEST     HFRST HLAST HPCNP HPCNR', ' 1 HA            -99   -99   -99   -99',
        '@N SIMDATES    ENDAT    SDUR   FODAT  FSTRYR  FENDYR FWFILE           FONAME', ' 1 SI            -99     -99     -99     -99     -99 -99              -99'
    ]) AS line)
    SELECT experiment_id, y AS "Year", line FROM s, k"""
)
def controls_block(t: Tables) -> DataFrame:
    lines = ex.management_lines({"SIMULATION_CONTROLS": management(t)["SIMULATION_CONTROLS"]}, [*BY, "Year"])
    return lines.select("experiment_id", F.col("Year").cast("long").alias("Year"), "line")


_ORDERS_SQL = """
    WITH o AS (SELECT o_orderstatus AS experiment_id, year(o_orderdate) AS y, o_orderkey AS k, o_custkey AS trt, strftime(o_orderdate, '%y%j') AS day, o_totalprice AS p FROM orders),
    s AS (SELECT DISTINCT experiment_id, y FROM o),
"""


@query(
    _ORDERS_SQL
    + """r AS (SELECT *, printf('%6d', trt) || lpad(day, 6, ' ') || printf('%6d', round(p, 0)::BIGINT) || printf('%9d', k) || printf('%6.2f', round(p, 2)) AS line FROM o),
    l AS (SELECT experiment_id, y, '*EXP. DATA (T): Trial ' || experiment_id AS line, 1 AS pos FROM s UNION ALL SELECT experiment_id, y, '', 2 FROM s
          UNION ALL SELECT experiment_id, y, '@TRTNO  DATE  CDAD ORDER_NO  LAID', 3 FROM s
          UNION ALL SELECT experiment_id, y, line, 3 + row_number() OVER (PARTITION BY experiment_id, y ORDER BY trt, day, round(p, 0), k) FROM r)
    SELECT experiment_id, y AS "Year", pos, line FROM l"""
)
def series_file(t: Tables) -> DataFrame:
    """The printed time series with all columns, lines in typed order; the position tells the order in the file."""
    observed = t.orders.select(
        F.col("o_orderstatus").alias("experiment_id"), F.year("o_orderdate").alias("Year"), F.col("o_custkey").alias("TRTNO"), F.to_date("o_orderdate").alias("DATE"),
        F.round("o_totalprice", 0).alias("CDAD"), F.col("o_orderkey").alias("ORDER_NO"), F.round("o_totalprice", 2).alias("LAID"),
    )
    scopes = observed.select(*BY, "Year").distinct().withColumn("EXP_DETAILS", F.concat(F.lit("Trial "), "experiment_id"))
    series = ex.build_series(observed, BY).select(*BY, "Year", "TRTNO", "DATE", "CDAD", "ORDER_NO", "LAID")
    lines = ex.observed_lines(series, tpl.SERIES_FORMATS, [*BY, "Year"], scopes, "T")
    place = Window.partitionBy(*BY, "Year").orderBy("block_no", "kind", "sort")
    return lines.select("experiment_id", F.col("Year").cast("long").alias("Year"), F.row_number().over(place).cast("long").alias("pos"), "line")


@query(
    _ORDERS_SQL
    + """r AS (SELECT *, printf('%6d', trt) || lpad(day, 6, ' ') || CASE WHEN y % 2 = 0 THEN printf('%6d', round(p, 0)::BIGINT) ELSE '' END || printf('%9d', k) AS line FROM o),
    l AS (SELECT experiment_id, y, '*EXP. DATA (T): Trial ' || experiment_id AS line, 1 AS pos FROM s UNION ALL SELECT experiment_id, y, '', 2 FROM s
          UNION ALL SELECT experiment_id, y, '@TRTNO  DATE' || CASE WHEN y % 2 = 0 THEN '  CDAD' ELSE '' END || ' ORDER_NO', 3 FROM s
          UNION ALL SELECT experiment_id, y, line, 3 + row_number() OVER (PARTITION BY experiment_id, y ORDER BY trt, day, CASE WHEN y % 2 = 0 THEN round(p, 0) END, k) FROM r)
    SELECT experiment_id, y AS "Year", pos, line FROM l"""
)
def series_file_by_year(t: Tables) -> DataFrame:
    """The printed time series when a column has values in every second year only: it is absent in the files of the others."""
    observed = t.orders.select(
        F.col("o_orderstatus").alias("experiment_id"), F.year("o_orderdate").alias("Year"), F.col("o_custkey").alias("TRTNO"), F.to_date("o_orderdate").alias("DATE"),
        F.when(F.year("o_orderdate") % 2 == 0, F.round("o_totalprice", 0)).alias("CDAD"), F.col("o_orderkey").alias("ORDER_NO"), F.lit(None).cast("double").alias("LAID"),
    )
    scopes = observed.select(*BY, "Year").distinct().withColumn("EXP_DETAILS", F.concat(F.lit("Trial "), "experiment_id"))
    series = ex.build_series(observed, BY).select(*BY, "Year", "TRTNO", "DATE", "CDAD", "ORDER_NO", "LAID")
    lines = ex.observed_lines(series, tpl.SERIES_FORMATS, [*BY, "Year"], scopes, "T")
    place = Window.partitionBy(*BY, "Year").orderBy("block_no", "kind", "sort")
    return lines.select("experiment_id", F.col("Year").cast("long").alias("Year"), F.row_number().over(place).cast("long").alias("pos"), "line")


@query(
    """
    WITH d AS (SELECT o_orderstatus AS experiment_id, o_orderdate::DATE AS day, count(*) AS n, max(o_custkey) AS hi, min(o_custkey) AS lo FROM orders GROUP BY 1, 2),
    s AS (SELECT DISTINCT experiment_id, year(day) AS y FROM d),
    h AS (SELECT experiment_id, y, unnest([
        '*WEATHER: Site ' || experiment_id, '! air: Station 1', '! rain: Station 2', '', '@ INSI      LAT     LONG  ELEV   TAV   AMP REFHT WNDHT',
        '  SEDE   51.371   12.358   128  10.5  10.9   2.0   2.0', '', '@DATE  SRAD  TMAX  TMIN  RAIN  DEWP  WIND   PAR  EVAP  RHUM']) AS line,
        generate_subscripts([1, 2, 3, 4, 5, 6, 7, 8], 1) AS pos FROM s)
    SELECT experiment_id, y AS "Year", pos, line FROM h
    UNION ALL SELECT experiment_id, year(day), 8 + row_number() OVER (PARTITION BY experiment_id, year(day) ORDER BY day),
        strftime(day, '%y%j') || printf('%6.1f', n::DOUBLE) || printf('%6.1f', hi::DOUBLE) || printf('%6.1f', lo::DOUBLE) || repeat('   -99', 6) FROM d
"""
)
def weather_station_file(t: Tables) -> DataFrame:
    """A whole weather file: title, comments, station block and days."""
    days = t.orders.groupBy(F.col("o_orderstatus").alias("experiment_id"), F.to_date("o_orderdate").alias("DATE")).agg(
        F.count(F.lit(1)).cast("double").alias("SRAD"), F.max("o_custkey").cast("double").alias("TMAX"), F.min("o_custkey").cast("double").alias("TMIN")
    ).withColumn("Year", F.year("DATE"))
    scopes = days.select(*BY, "Year").distinct()
    numbers = {"LAT": 51.371, "LONG": 12.358, "ELEV": 128.0, "TAV": 10.5, "AMP": 10.9, "REFHT": 2.0, "WNDHT": 2.0}
    header = scopes.select(*BY, "Year", F.concat(F.lit("Site "), "experiment_id").alias("SITE"), F.lit("SEDE").alias("INSI"), *[F.lit(v).alias(c) for c, v in numbers.items()])
    comments = scopes.withColumn("comment", F.explode(F.array(F.lit("rain: Station 2"), F.lit("air: Station 1"))))
    lines = ex.weather_lines(ex.build_weather(days, BY), header, comments, [*BY, "Year"])
    place = Window.partitionBy(*BY, "Year").orderBy("block_no", "kind", "sort")
    return lines.select("experiment_id", F.col("Year").cast("long").alias("Year"), F.row_number().over(place).cast("long").alias("pos"), "line")


@query(
    _SECTIONS_SQL
    + """SELECT DISTINCT experiment_id, y AS "Year", 1.0::DOUBLE AS "N", 'GE' AS "GENERAL", 'N' AS "WATER", 2150.0::DOUBLE AS "RSEED", 'SI' AS "SIMDATES",
        'SEDE' || lpad((y % 100)::VARCHAR, 2, '0') || '01.WHX' AS file_name FROM n"""
)
def default_controls(t: Tables) -> DataFrame:
    controls = management(t)["SIMULATION_CONTROLS"]
    name = ex.file_name(F.lit("SEDE"), F.col("Year"), "WHX").alias("file_name")
    return controls.select(*BY, F.col("Year").cast("long").alias("Year"), "N", "GENERAL", "WATER", "RSEED", "SIMDATES", name)


@query("""
    WITH k AS (SELECT p_partkey // 8 AS soil, list(p_partkey::DOUBLE ORDER BY p_partkey) AS slb, list(p_retailprice ORDER BY p_partkey) AS slll FROM part GROUP BY 1)
    SELECT 'S' || soil AS "PEDON", 'SITE' AS "SITE", len(slb) AS n_layers, slb[1] AS first_depth, slll[len(slll)] AS last_value FROM k
""")
def soil_file(t: Tables) -> DataFrame:
    soil = F.concat(F.lit("S"), F.floor(F.col("p_partkey") / 8).cast("string")).alias("PEDON")
    layers = t.part.select(soil, F.col("p_partkey").cast("double").alias("SLB"), F.col("p_retailprice").alias("SLLL"))
    header = layers.select("PEDON", F.lit("SITE").alias("SITE"), F.lit("Family").alias("SCS FAMILY")).distinct()
    got = ex.build_soil(header, layers, ["PEDON"])
    return got.select(
        "PEDON", "SITE", F.size("SLB").cast("long").alias("n_layers"), F.col("SLB")[0].alias("first_depth"), F.element_at("SLLL", -1).alias("last_value")
    )


@query("""
    SELECT p_type AS kind, 'S' || (p_partkey // 8) AS profile_id, p_partkey::DOUBLE AS "SLB", p_size / 100 AS "SLLL" FROM part
""")
def soil_text_round_trip(t: Tables) -> DataFrame:
    soil = F.concat(F.lit("S"), F.floor(F.col("p_partkey") / 8).cast("string")).alias("PEDON")
    layers = t.part.select("p_type", soil, F.col("p_partkey").cast("double").alias("SLB"), (F.col("p_size") / 100).alias("SLLL"))
    header = layers.select("p_type", "PEDON", F.lit("Family").alias("SCS FAMILY")).distinct()
    built = ex.build_soil(header, layers, ["p_type", "PEDON"])
    # many profiles share a file: the profile leads the order of its lines
    lines = ex.soil_lines(built, ["p_type", "PEDON"])
    path = scratch_path(t.spark, "soil")
    ex.write_text(lines, path, ["p_type"], ["PEDON", "block_no", "kind", "sort"])
    sections = reports.read_sections(t.spark, f"{path}/*", "*S").select("title", "body", F.regexp_extract("title", r"^(\d+)", 1).alias("no"))
    rows = reports.fields_as(reports.section_rows(sections.filter("no <> ''")), {"SLB": "double", "SLLL": "double"})
    back = rows.filter("SLB IS NOT NULL").select(F.concat(F.lit("S"), "no").alias("profile_id"), "SLB", "SLLL")
    kinds = t.part.select(F.col("p_partkey").cast("double").alias("SLB"), F.col("p_type").alias("kind"))
    return back.join(kinds, "SLB").select("kind", "profile_id", "SLB", "SLLL")


@query("""
    SELECT o_orderstatus AS experiment_id, year(o_orderdate) AS "Year", o_custkey AS "TRTNO", strftime(o_orderdate, '%y%j') AS "MDAT", o_totalprice AS "HWAH", o_orderpriority FROM orders
""")
def summary_codes(t: Tables) -> DataFrame:
    observed = t.orders.select(
        F.col("o_orderstatus").alias("experiment_id"), F.year("o_orderdate").alias("Year"), F.col("o_custkey").alias("TRTNO"), F.to_date("o_orderdate").alias("MDAT"),
        F.col("o_totalprice").alias("HWAH"), "o_orderpriority",
    )
    return ex.build_summary(observed, BY)


@query("""
    SELECT o_orderstatus AS experiment_id, year(o_orderdate) AS "Year", strftime(o_orderdate, '%y%j') AS "DATE", o_custkey AS "TRTNO", o_totalprice AS "CDAD", o_totalprice / 2 AS "LAID" FROM orders
""")
def series_codes(t: Tables) -> DataFrame:
    observed = t.orders.select(
        F.col("o_orderstatus").alias("experiment_id"), F.year("o_orderdate").alias("Year"), F.col("o_custkey").alias("TRTNO"), F.to_date("o_orderdate").alias("DATE"),
        F.col("o_totalprice").alias("CDAD"), (F.col("o_totalprice") / 2).alias("LAID"),
    )
    return ex.build_series(observed, BY)


@query("""
    SELECT p_partkey, (p_size + 1)::DOUBLE AS "FLELE" FROM part WHERE p_partkey % 5 <> 0
""")
def field_elevation(t: Tables) -> DataFrame:
    fields = t.part.select("p_partkey", F.when(F.col("p_partkey") % 5 != 0, F.col("p_size")).alias("low"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_size") + 2).alias("high"))
    return mid_elevation(drop_empty_rows(fields, ["low", "high"]), "low", "high").select("p_partkey", "FLELE")


@query(
    f"""WITH {BASE_SQL} SELECT DISTINCT experiment_id, y AS "Year", f2::DOUBLE AS "F", f2 * 50.0::DOUBLE AS "FAMN" FROM base"""
)
def section_folders(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sections")
    ex.write_sections({"FERTILIZERS": management(t)["FERTILIZERS"]}, path, BY)
    back = t.spark.read.parquet(f"{path}/FERTILIZERS")
    return back.select("experiment_id", F.col("Year").cast("long").alias("Year"), "F", "FAMN")
