"""Dictionary mapping of headers, codes and units; templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.functions import dates
from agroloom.functions.text import capitals, site_code, split_parts
from agroloom.functions.units import convert_unit
from agroloom.operators.columns import conform, standardize_names, upper_names, within_years
from agroloom.operators.mapping import code_lookup, map_codes, map_data, read_mapping, unit_errors
from agroloom.operators.scale import null_safe_join
from agroloom.plans.bundle import balance, climate, crop_assessment
from agroloom.plans.templates import SECTIONS
from agroloom.queries import Tables, query

_COLS = ("table_name", "column_header", "column_unit", "std_header", "std_unit", "code_mappings")
PRIORITY_CODES = "list('1-URGENT: U', 'c(2-HIGH, 3-MEDIUM): M', '5-LOW: 1')"
DICTIONARY = [
    dict(zip(_COLS, r))
    for r in [
        ("LINES", "l_quantity", "t/ha", "yield", "kg/ha", ""),
        ("LINES", "l_extendedprice", "g", "mass", "kg", ""),
        ("LINES", "l_discount", "degree_C", "temp", "degree_F", ""),
        ("LINES", "l_returnflag", "", "flag", "text", ""),
        ("LINES", "l_comment", "", "comment", "text", ""),
        ("ORDERS", "o_orderpriority", "", "priority", "code", PRIORITY_CODES),
        ("ORDERS", "o_orderstatus", "", "status", "code", "1"),
        ("ORDERS", "o_totalprice", "dt/ha", "yield", "t/ha", ""),
        ("ORDERS", "o_clerk", "", "", "text", ""),
    ]
]


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity * 1000 AS yield, round(l_extendedprice / 1000, 6) AS mass,
           round(l_discount * 9 / 5 + 32, 6) AS temp, l_returnflag AS flag FROM lineitem
""")
def mapped_lines(t: Tables) -> DataFrame:
    mapped = map_data(t.lineitem, "LINES", DICTIONARY, keep_unmapped=False, exempt=["l_orderkey", "l_linenumber"], distinct=False)
    return mapped.withColumns({"yield": F.round("yield", 6), "mass": F.round("mass", 6), "temp": F.round("temp", 6)})


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity * 1000 AS yield, round(l_extendedprice / 1000, 6) AS mass, round(l_discount * 9 / 5 + 32, 6) AS temp,
           l_returnflag AS flag, l_partkey, l_suppkey, l_tax, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem
""")
def mapped_lines_kept(t: Tables) -> DataFrame:
    """All columns stay, the unmapped ones under their own names."""
    mapped = map_data(t.lineitem, "LINES", DICTIONARY, distinct=False)
    out = mapped.withColumns({"yield": F.round("yield", 6), "mass": F.round("mass", 6), "temp": F.round("temp", 6), "l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd")})
    return out.select("l_orderkey", "l_linenumber", "yield", "mass", "temp", "flag", "l_partkey", "l_suppkey", "l_tax", "l_linestatus", "l_shipdate")


@query("""
    SELECT p_partkey, p_size % 3 = 1 AS wrong FROM part
""")
def unknown_units(t: Tables) -> DataFrame:
    """Every part as a mapping row; those with units of another kind are reported."""
    unit = F.get(F.array(F.lit("g"), F.lit("furlong"), F.lit("t")), (F.col("p_size") % 3).cast("int"))
    rows = t.part.select(F.col("p_partkey").cast("string").alias("column_header"), unit.alias("column_unit"), F.lit("kg").alias("std_unit"), F.lit("x").alias("std_header"))
    wrong = [(int(m["column_header"]),) for m in unit_errors(read_mapping(rows))]
    found = t.spark.createDataFrame(wrong, "p_partkey long").withColumn("wrong", F.lit(True))
    return null_safe_join(t.part.select("p_partkey"), found, ["p_partkey"]).fillna(False)


# source unit, target unit, factor and zero of the conversion, in the spellings that datasets use
COMPOUND_UNITS = [
    ("kg ha-1", "g/m2", 0.1, 0.0), ("g m^-2 d^-1", "kg/(ha d)", 10.0, 0.0), ("mmol/l", "mol m-3", 1.0, 0.0), ("hPa", "bar", 0.001, 0.0),
    ("W m-2", "MJ/m2/d", 0.0864, 0.0), ("m³ m⁻³", "%", 100.0, 0.0), ("°F", "degree_C", 5 / 9, -160 / 9), ("kg ha-1", "kg", None, None),
]


@query(f"""
    WITH u AS (SELECT * FROM (VALUES {", ".join(f"({i}, {'NULL' if f is None else repr(f)}::DOUBLE, {'NULL' if z is None else repr(z)}::DOUBLE)" for i, (_, _, f, z) in enumerate(COMPOUND_UNITS))}) x(i, f, z))
    SELECT l_orderkey, l_linenumber, l_partkey % 8 AS unit, coalesce(round(l_quantity * f + z, 6), -1) AS value FROM lineitem JOIN u ON l_partkey % 8 = i
""")
def compound_units(t: Tables) -> DataFrame:
    """Quantities in products and powers of units; a pair of other dimensions has no value."""

    def converted(source: str, target: str) -> Column:
        try:
            return convert_unit(F.col("l_quantity"), source, target)
        except ValueError:
            return F.lit(-1.0)

    unit = F.col("l_partkey") % 8
    values = [F.when(unit == i, converted(a, b)) for i, (a, b, _, _) in enumerate(COMPOUND_UNITS)]
    return t.lineitem.select("l_orderkey", "l_linenumber", unit.alias("unit"), F.round(F.coalesce(*values), 6).alias("value"))


@query("""
    SELECT DISTINCT o_custkey, coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'M' WHEN '3-MEDIUM' THEN 'M'
        WHEN '5-LOW' THEN '5-LOW' END, '-') AS priority, o_orderstatus AS status, round(o_totalprice / 10, 6) AS yield FROM orders
""")
def mapped_orders(t: Tables) -> DataFrame:
    codes = t.spark.createDataFrame([m for m in DICTIONARY if m["std_unit"] == "code"])
    lookup = code_lookup(codes.select("table_name", "std_header", "code_mappings"))
    mapped = map_data(t.orders, "ORDERS", DICTIONARY, lookup, keep_unmapped=False, exempt=["o_custkey"])
    return mapped.select("o_custkey", F.coalesce("priority", F.lit("-")).alias("priority"), "status", F.round("yield", 6).alias("yield"))


@query("""
    SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN p_partkey % 4 <> 0 THEN p_brand || '/' || p_partkey END, '-') AS code
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def joined_codes(t: Tables) -> DataFrame:
    # a lookup as large as a table is joined
    lookup = t.part.filter(F.col("p_partkey") % 4 != 0).select(
        F.lit("code").alias("std_header"), F.col("p_partkey").cast("string").alias("source"), F.concat("p_brand", F.lit("/"), F.col("p_partkey").cast("string")).alias("target")
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("code"))
    return map_codes(rows, lookup, ["code"]).fillna("-", subset=["code"])


@query("""
    WITH m AS (SELECT p_brand, 'list(''' || string_agg(DISTINCT p_type, ''', ''' ORDER BY p_type) || ': X'')' AS code_mappings FROM part GROUP BY 1)
    SELECT p_brand, p_type AS source, CASE WHEN p_type = max(p_type) OVER (PARTITION BY p_brand) THEN 'X' ELSE '-' END AS target
    FROM (SELECT DISTINCT p_brand, p_type FROM part)
""")
def parsed_codes(t: Tables) -> DataFrame:
    lists = t.part.groupBy("p_brand").agg(
        F.concat(F.lit("list('"), F.array_join(F.array_sort(F.collect_set("p_type")), "', '"), F.lit(": X')")).alias("code_mappings")
    )
    return code_lookup(lists).fillna("-", subset=["target"])


@query("""
    SELECT p_partkey::DOUBLE AS "F", p_type AS "FMCD", p_size::DOUBLE AS "FDEP", p_retailprice AS "FAMN", -99.0::DOUBLE AS "FAMP", '-' AS "FACD",
           p_name AS "FERNAME", strftime(DATE '2000-01-01' + p_size, '%Y-%m-%d') AS "FDATE"
    FROM part
""")
def conformed_fertilizers(t: Tables) -> DataFrame:
    raw = t.part.select(
        F.col("p_partkey").alias("F"), F.col("p_type").alias("FMCD"), F.col("p_size").cast("string").alias("FDEP"), F.col("p_retailprice").alias("FAMN"),
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), "p_size"), "yyyy-MM-dd").alias("FDATE"), F.col("p_name").alias("FERNAME"), "p_brand",
    )
    shaped = conform(raw, SECTIONS["FERTILIZERS"], {"FAMP": -99.0, "FACD": "-"})
    return shaped.select("F", "FMCD", "FDEP", "FAMN", "FAMP", "FACD", "FERNAME", F.date_format("FDATE", "yyyy-MM-dd").alias("FDATE"))


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%y%j') AS code, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
""")
def doy_codec(t: Tables) -> DataFrame:
    coded = t.orders.select("o_orderkey", dates.to_doy(F.col("o_orderdate")).alias("code"))
    return coded.withColumn("day", F.date_format(dates.from_doy(F.col("code")), "yyyy-MM-dd"))


@query("""
    SELECT o_orderkey, month(o_orderdate) AS month, strftime(o_orderdate - INTERVAL 18 MONTH, '%Y-%m-%d') AS earlier,
           year(o_orderdate) % 4 = 0 AND (year(o_orderdate) % 100 <> 0 OR year(o_orderdate) % 400 = 0) AS leap,
           CASE WHEN o_orderdate <= DATE '1997-01-01' THEN 'historical' ELSE 'recent' END AS period FROM orders
""")
def date_parts(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.month(day).alias("month"), F.date_format(F.add_months(day, -18), "yyyy-MM-dd").alias("earlier"),
        dates.is_leap(F.year(day)).alias("leap"), dates.archive_period(day, F.lit("1998-07-01").cast("date")).alias("period"),
    )


@query("""
    SELECT o_orderkey AS orderkey, year(o_orderdate) AS "Year", o_custkey AS "Plot_id", o_orderpriority AS "Treatment_id",
           o_totalprice AS "Yield", o_orderstatus AS "Kulturart" FROM orders
""")
def standard_names(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_orderkey").alias("orderkey"), F.year("o_orderdate").alias("VERSUCHSJAHR"), F.col("o_custkey").alias("parzelle_id"),
        F.col("o_orderpriority").alias("Pruefglied_ID"), F.col("o_totalprice").alias("Ertrag_dt"), F.col("o_orderstatus").alias("Kulturart"),
    )
    # two prefix matches for Crop would clash, so neither is renamed
    named = standardize_names(raw.withColumn("Kultur_x", F.lit(1)))
    return named.drop("Kultur_x")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01'
""")
def year_range(t: Tables) -> DataFrame:
    return within_years(t.orders, "o_orderdate", 1996, 1997).select("o_orderkey", "o_totalprice")


@query("""
    SELECT o_orderkey AS "O_ORDERKEY", strftime(o_orderdate, '%Y-%m-%d') AS "DATE", 'CLIMATE' AS "DATA_TYPE", o_totalprice AS "TEMP" FROM orders
""")
def climate_table(t: Tables) -> DataFrame:
    raw = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("Datum"), F.col("o_totalprice").alias("Temp"))
    return climate(raw).withColumn("DATE", F.date_format("DATE", "yyyy-MM-dd")).drop("DATUM")


@query("""
    SELECT o_orderkey AS "O_ORDERKEY", o_orderstatus AS "BONITUR_TYP", o_orderstatus AS "ASSESSMENT_TYPE", 'CROP_ASSESSMENT' AS "DATA_TYPE" FROM orders
""")
def assessment_table(t: Tables) -> DataFrame:
    return crop_assessment(t.orders.select("o_orderkey", F.col("o_orderstatus").alias("Bonitur_Typ")))


@query("""
    SELECT p_partkey AS "P_PARTKEY", p_retailprice AS "NINPUT", 'NITROGEN' AS "BALANCE_TYPE", 'NITROGEN_BALANCE' AS "DATA_TYPE", (1990 + p_size)::DOUBLE AS "YEAR"
    FROM part
""")
def balance_table(t: Tables) -> DataFrame:
    raw = t.part.select(
        "p_partkey", F.regexp_replace(F.col("p_retailprice").cast("string"), r"\.", ",").alias("NInput"), (F.col("p_size") + 1990).alias("Jahr")
    )
    return balance(raw, "NITROGEN").drop("JAHR")


@query("""
    SELECT s_suppkey AS "S_SUPPKEY", s_name AS "S_NAME", 'CROP_ROTATION' AS "DATA_TYPE" FROM supplier
""")
def upper_headers(t: Tables) -> DataFrame:
    return upper_names(t.supplier.select("s_suppkey", "s_name"), DATA_TYPE="CROP_ROTATION")


@query("""
    SELECT c_custkey, regexp_replace(c_mktsegment || ' ' || n_name, '[^A-Z]', '', 'g') AS capitals, upper(substr(n_name, 1, 2) || 'de') AS code,
           split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def text_parts(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    kind, number = split_parts(F.col("c_name"), "#", 2)
    return rows.select(
        "c_custkey", capitals(F.concat_ws(" ", "c_mktsegment", "n_name")).alias("capitals"), site_code(F.col("n_name"), F.lit("de")).alias("code"),
        kind.alias("kind"), number.alias("number"),
    )
