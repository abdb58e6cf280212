"""Whole experiments: parts become the plots of field trials, with all their tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.operators.columns import front
from agroloom.operators.merge import union_in_order
from agroloom.operators.phenology import jitter
from agroloom.operators.scale import null_safe_join
from agroloom.plans import bundle, sections
from agroloom.plans.reshape import general_section, header_section, reshape_experiments
from agroloom.queries import Tables, query

BY = ["experiment_id"]

# forty plots a year, eight treatments (two by four factor levels) in five blocks, ten years
BASE_SQL = """
    base AS (SELECT 'E' || (p_partkey // 400) AS experiment_id, p_partkey // 400 AS e, p_partkey AS k, 1990 + (p_partkey // 40) % 10 AS y,
                    100 + p_partkey % 40 AS plot, p_partkey % 8 + 1 AS trt, (p_partkey % 40) // 8 + 1 AS block,
                    (p_partkey % 8) // 4 + 1 AS f1, p_partkey % 4 + 1 AS f2, p_retailprice AS price, p_size AS size FROM part)
"""


def base(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(
        F.concat(F.lit("E"), F.floor(k / 400).cast("string")).alias("experiment_id"),
        F.floor(k / 400).alias("e"),
        k.alias("k"),
        (1990 + F.floor(k / 40) % 10).alias("y"),
        (100 + k % 40).alias("plot"),
        (k % 8 + 1).alias("trt"),
        (F.floor(k % 40 / 8) + 1).alias("block"),
        (F.floor(k % 8 / 4) + 1).alias("f1"),
        (k % 4 + 1).alias("f2"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("size"),
    )


def trial_tables(t: Tables) -> dict[str, DataFrame]:
    """The tables as they would land: German headers, keys without declaration, text dates."""
    b = base(t)

    def pick(*cols, distinct: bool = False) -> DataFrame:
        out = b.select("experiment_id", *cols)
        return out.distinct() if distinct else out

    k, y, plot = F.col("k"), F.col("y").alias("Versuchsjahr"), F.col("plot").alias("Parzelle_ID")
    sort = F.col("y") % 3 + 1
    twice = F.explode(F.array(F.lit(0), F.lit(1)))

    def day(month: int, d: Column) -> Column:
        return F.date_format(F.make_date("y", F.lit(month), d.cast("int")), "yyyy-MM-dd")

    ratings = b.withColumn("j", twice)
    return {
        "VERSUCHSAUFBAU": pick(k.alias("Versuchsaufbau_ID"), y, plot, F.col("trt").alias("Pruefglied_ID")),
        "PARZELLE": pick(
            plot, F.concat(F.lit("P"), F.col("plot").cast("string")).alias("Parzelle"), F.col("block").alias("Wiederholung"),
            F.col("trt").alias("Pruefglied_ID"), (100 + F.col("block") * 2).alias("Hoehe"), (51 + F.col("e") / 100).alias("Latitude"),
            (12 + F.col("e") / 100).alias("Longitude"), distinct=True,
        ),
        "PRUEFGLIED": pick(F.col("trt").alias("Pruefglied_ID"), F.col("f1").alias("Faktor1_Stufe_ID"), F.col("f2").alias("Faktor2_Stufe_ID"), distinct=True),
        "FAKTOR1_STUFE": pick(F.col("f1").alias("Faktor1_Stufe_ID"), F.concat(F.lit("org"), F.col("f1").cast("string")).alias("Name"), distinct=True),
        "FAKTOR2_STUFE": pick(F.col("f2").alias("Faktor2_Stufe_ID"), F.concat(F.lit("min"), F.col("f2").cast("string")).alias("Name"), distinct=True),
        "DUENGUNG": pick(
            k.alias("Duengung_ID"), y, plot, day(4, F.col("f2") + 1).alias("Termin"), F.col("f1").alias("Duengemittel_ID"), (F.col("f2") * 50).alias("Menge")
        ),
        "DUENGEMITTEL": pick(F.col("f1").alias("Duengemittel_ID"), F.concat(F.lit("fert"), F.col("f1").cast("string")).alias("Mittel"), distinct=True),
        "AUSSAAT": pick(k.alias("Aussaat_ID"), y, plot, day(3, F.lit(20)).alias("Saattermin"), sort.alias("Sorte_ID")),
        "SORTE": pick(sort.alias("Sorte_ID"), F.concat(F.lit("S"), sort.cast("string")).alias("Sorte"), (sort % 2 + 1).alias("Kultur_ID"), distinct=True),
        "KULTUR": pick((sort % 2 + 1).alias("Kultur_ID"), F.concat(F.lit("K"), (sort % 2 + 1).cast("string")).alias("Art"), distinct=True),
        "ERNTE": pick(k.alias("Ernte_ID"), y, plot, F.col("price").alias("Ertrag")),
        "BONITUR": ratings.select(
            "experiment_id", (F.col("k") * 2 + F.col("j")).alias("Bonitur_ID"), y, plot, day(5, F.col("j") * 20 + 1).alias("Datum"), (F.col("size") + F.col("j")).alias("Wert")
        ),
    }


def trial_metadata(t: Tables) -> DataFrame:
    scopes = base(t).select("experiment_id", "e").distinct()
    return scopes.select(
        "experiment_id",
        F.lit(1990).alias("start_year"),
        F.lit(1999).alias("end_year"),
        F.lit(40).alias("number_plots"),
        F.lit(5).alias("replication"),
        (51 + F.col("e") / 100).alias("latitude"),
        (12 + F.col("e") / 100).alias("longitude"),
        F.concat(F.lit("Trial "), "experiment_id").alias("name"),
        F.lit("Seefeld").alias("site"),
        F.lit("Germany").alias("country"),
        F.lit("A. Person").alias("contact_name"),
        F.lit("a@example.com").alias("contact_email"),
        F.lit("Field Station").alias("trial_institution"),
        F.lit(24.0).alias("size_plots"),
        F.concat(F.lit("10.1/"), "experiment_id").alias("doi"),
    )


def trial_bundle(t: Tables, observed: bool = False) -> dict[str, DataFrame]:
    return reshape_experiments(trial_tables(t), trial_metadata(t), "VERSUCHSAUFBAU", BY, observed=observed)


_IDS_SQL = f"""
    WITH {BASE_SQL},
    n AS (SELECT *, dense_rank() OVER (PARTITION BY experiment_id ORDER BY y) AS yid,
                 dense_rank() OVER (PARTITION BY experiment_id ORDER BY y, f1) AS id1, dense_rank() OVER (PARTITION BY experiment_id ORDER BY y, f2) AS id2 FROM base)
"""


@query(
    _IDS_SQL
    + """SELECT DISTINCT experiment_id, y AS "Year", f1 AS "Faktor1_Stufe_ID", f2 AS "Faktor2_Stufe_ID", yid::VARCHAR AS "AUSSAAT_ID",
        id1 || '_' || id2 AS "DUENGUNG_ID", block AS "FL_ID", trt AS "TRTNO" FROM n"""
)
def trial_treatments(t: Tables) -> DataFrame:
    return trial_bundle(t)["TREATMENTS"]


@query(
    _IDS_SQL
    + """SELECT DISTINCT experiment_id, y AS "Year", id1 || '_' || id2 AS "DUENGUNG_ID", strftime(make_date(y::INT, 4, (f2 + 1)::INT), '%Y-%m-%d') AS "DUENGUNG__Termin",
        f2 * 50 AS "DUENGUNG__Menge", 'fert' || f1 AS "DUENGEMITTEL__Mittel" FROM n"""
)
def trial_fertilizers(t: Tables) -> DataFrame:
    return trial_bundle(t)["DUENGUNG"].withColumn("DUENGUNG__Termin", F.date_format("DUENGUNG__Termin", "yyyy-MM-dd"))


@query(
    _IDS_SQL
    + """SELECT DISTINCT experiment_id, y AS "Year", yid::VARCHAR AS "AUSSAAT_ID", strftime(make_date(y::INT, 3, 20), '%Y-%m-%d') AS "AUSSAAT__Saattermin",
        'S' || (y % 3 + 1) AS "SORTE__Sorte", 'K' || ((y % 3 + 1) % 2 + 1) AS "KULTUR__Art" FROM n"""
)
def trial_sowings(t: Tables) -> DataFrame:
    return trial_bundle(t)["AUSSAAT"].withColumn("AUSSAAT__Saattermin", F.date_format("AUSSAAT__Saattermin", "yyyy-MM-dd"))


@query(f"""
    WITH {BASE_SQL} SELECT DISTINCT experiment_id, block AS "FL_ID", 100 + block * 2 AS "PARZELLE__Hoehe", 51 + e / 100 AS "FL_LAT", 12 + e / 100 AS "FL_LON" FROM base
""")
def trial_fields(t: Tables) -> DataFrame:
    return trial_bundle(t)["FIELDS"]


@query(f"""
    WITH {BASE_SQL} SELECT experiment_id, y AS "Year", plot AS "Plot_id", trt AS "Treatment_id", block AS "Rep_no", price AS "ERNTE__Ertrag", trt AS "TRTNO" FROM base
""")
def trial_summary(t: Tables) -> DataFrame:
    return trial_bundle(t, observed=True)["OBSERVED_Summary"]


@query(f"""
    WITH {BASE_SQL} SELECT experiment_id, y AS "Year", plot AS "Plot_id", trt AS "Treatment_id", block AS "Rep_no",
      strftime(make_date(y::INT, 5, (j * 20 + 1)::INT), '%Y-%m-%d') AS "BONITUR__Datum", size + j AS "BONITUR__Wert", 'BONITUR' AS source, trt AS "TRTNO"
    FROM base, (VALUES (0), (1)) v(j)
""")
def trial_series(t: Tables) -> DataFrame:
    return trial_bundle(t, observed=True)["OBSERVED_TimeSeries"].withColumn("BONITUR__Datum", F.date_format("BONITUR__Datum", "yyyy-MM-dd"))


def wider_tables(t: Tables) -> dict[str, DataFrame]:
    """The trials with a second series that has its own treatment column (wrong on some plots, absent in odd years), and a
    second summary for four of the five blocks."""
    b = base(t)
    j = F.explode(F.sequence(F.lit(0), F.lit(2)))
    given = F.when(F.col("plot") % 10 == 3, F.col("trt") % 8 + 1).otherwise(F.col("trt"))
    rows = b.where("y % 2 = 0").withColumn("j", j)
    series = rows.select(
        "experiment_id", (F.col("k") * 3 + F.col("j")).alias("Messung_ID"), F.col("y").alias("Versuchsjahr"), F.col("plot").alias("Parzelle_ID"),
        given.alias("Pruefglied_ID"), F.date_format(F.make_date("y", F.lit(6), (F.col("j") * 9 + 1).cast("int")), "yyyy-MM-dd").alias("Messtag"),
        (F.col("price") + F.col("j")).alias("Feuchte"),
    )
    summary = b.where("block < 5").select(
        "experiment_id", F.col("k").alias("Qualitaet_ID"), F.col("y").alias("Versuchsjahr"), F.col("plot").alias("Parzelle_ID"), (F.col("price") / 2).alias("Protein")
    )
    return trial_tables(t) | {"MESSUNG": series, "QUALITAET": summary}


@query(f"""
    WITH {BASE_SQL},
    a AS (SELECT experiment_id, y, plot, trt, block, 'BONITUR' AS source, strftime(make_date(y::INT, 5, (j * 20 + 1)::INT), '%Y-%m-%d') AS day, (size + j)::DOUBLE AS v, 0 AS other
          FROM base, (VALUES (0), (1)) v(j)
          UNION ALL
          SELECT experiment_id, y, plot, trt, block, 'MESSUNG', strftime(make_date(y::INT, 6, (j * 9 + 1)::INT), '%Y-%m-%d'), price + j,
                 CASE WHEN plot % 10 = 3 THEN trt % 8 + 1 ELSE 0 END FROM base, (VALUES (0), (1), (2)) v(j) WHERE y % 2 = 0)
    SELECT experiment_id, y AS "Year", plot AS "Plot_id", trt AS "Treatment_id", block AS "Rep_no", source, day, v, other, trt AS "TRTNO" FROM a
""")
def trial_two_series(t: Tables) -> DataFrame:
    got = reshape_experiments(wider_tables(t), trial_metadata(t), "VERSUCHSAUFBAU", BY)["OBSERVED_TimeSeries"]
    day = F.date_format(F.coalesce("BONITUR__Datum", "MESSUNG__Messtag"), "yyyy-MM-dd").alias("day")
    value = F.coalesce(F.col("BONITUR__Wert").cast("double"), "MESSUNG__Feuchte").alias("v")
    other = F.coalesce("MESSUNG__Treatment_id", F.lit(0)).alias("other")
    return got.select(*BY, "Year", "Plot_id", "Treatment_id", "Rep_no", "source", day, value, other, "TRTNO")


@query(f"""
    WITH {BASE_SQL} SELECT experiment_id, y AS "Year", plot AS "Plot_id", trt AS "Treatment_id", block AS "Rep_no", price AS "ERNTE__Ertrag",
        CASE WHEN block < 5 THEN price / 2 ELSE -1 END AS "QUALITAET__Protein", trt AS "TRTNO" FROM base
""")
def trial_two_summaries(t: Tables) -> DataFrame:
    got = reshape_experiments(wider_tables(t), trial_metadata(t), "VERSUCHSAUFBAU", BY)["OBSERVED_Summary"]
    return got.fillna(-1, subset=["QUALITAET__Protein"])


@query(f"""
    WITH {BASE_SQL} SELECT DISTINCT experiment_id, 'Trial ' || experiment_id AS "EXP_DETAILS", 'SEDE' AS "SITE_CODE", 'A. Person' AS "PERSONS", '10.1/' || experiment_id AS "DOI",
        'Source data DOI: 10.1/' || experiment_id AS note FROM base
""")
def trial_general(t: Tables) -> DataFrame:
    meta = trial_metadata(t)
    both = header_section(meta, BY).join(general_section(meta, BY), BY)
    return both.select(*BY, "EXP_DETAILS", "SITE_CODE", "PERSONS", "DOI", F.col("NOTES")[1].alias("note"))


# --- experiments that differ in their columns -------------------------------------------------------

# a second institute's names for the same things
OTHER_HEADERS = {
    "Versuchsjahr": "Season", "Parzelle_ID": "Plot", "Pruefglied_ID": "Variant", "Wiederholung": "Block", "Faktor1_Stufe_ID": "Factor_A", "Sorte_ID": "Cultivar",
}


def unlike_tables(t: Tables) -> dict[str, DataFrame]:
    """Every third experiment with other headers and another date layout, every third without a year in its design."""
    kind = F.substring("experiment_id", 2, 9).cast("int") % 3
    out = {}
    for n, df in trial_tables(t).items():
        other = df.where(kind == 1)
        if "Saattermin" in df.columns:
            other = other.withColumn("Saattermin", F.date_format(F.to_date("Saattermin"), "dd.MM.yyyy"))
        if n == "VERSUCHSAUFBAU":
            df = df.withColumn("Versuchsjahr", F.when(kind != 2, F.col("Versuchsjahr")))
        out[n] = union_in_order(df.where(kind != 1), other.withColumnsRenamed(OTHER_HEADERS))
    return out


def unlike_bundle(t: Tables) -> dict[str, DataFrame]:
    return reshape_experiments(unlike_tables(t), trial_metadata(t), "VERSUCHSAUFBAU", BY, observed=False)


@query(
    _IDS_SQL
    + """SELECT DISTINCT experiment_id, y AS "Year", CASE WHEN e % 3 = 0 THEN f1 ELSE -1 END AS "Faktor1_Stufe_ID", CASE WHEN e % 3 = 1 THEN f1 ELSE -1 END AS "Factor_A",
        f2 AS "Faktor2_Stufe_ID", yid::VARCHAR AS "AUSSAAT_ID", id1 || '_' || id2 AS "DUENGUNG_ID", block AS "FL_ID", trt AS "TRTNO" FROM n WHERE e % 3 <> 2"""
)
def unlike_treatments(t: Tables) -> DataFrame:
    """Treatments of experiments with two sets of headers in one batch; those without a design are left out."""
    return unlike_bundle(t)["TREATMENTS"].fillna(-1)


@query(
    _IDS_SQL
    + """SELECT DISTINCT experiment_id, y AS "Year", yid::VARCHAR AS "AUSSAAT_ID", strftime(make_date(y::INT, 3, 20), '%Y-%m-%d') AS "AUSSAAT__Saattermin",
        'S' || (y % 3 + 1) AS "SORTE__Sorte", 'K' || ((y % 3 + 1) % 2 + 1) AS "KULTUR__Art" FROM n WHERE e % 3 <> 2"""
)
def unlike_sowings(t: Tables) -> DataFrame:
    """Sowings with their varieties by links of two names, and dates in two layouts."""
    return unlike_bundle(t)["AUSSAAT"].withColumn("AUSSAAT__Saattermin", F.date_format("AUSSAAT__Saattermin", "yyyy-MM-dd"))


@query(f"""
    WITH {BASE_SQL} SELECT DISTINCT experiment_id, CASE WHEN e % 3 = 2 THEN 'no column of VERSUCHSAUFBAU lies in the years of the experiment' ELSE '-' END AS problem FROM base
""")
def unlike_problems(t: Tables) -> DataFrame:
    """Every experiment with the reason why it could not be reshaped, if there is one."""
    found = unlike_bundle(t)["PROBLEMS"]
    return null_safe_join(trial_metadata(t).select(*BY), found, BY).fillna("-", subset=["problem"])


# --- sections on top of a bundle -----------------------------------------------------------------

def harvested(t: Tables) -> DataFrame:
    """Orders as harvests: customers are plots, priorities treatments; some rows are empty."""
    some = F.col("o_orderkey") % 6 != 0
    return t.orders.select(
        F.col("o_orderstatus").alias("experiment_id"), F.year("o_orderdate").alias("Year"), (F.col("o_custkey") % 50).alias("Plot_id"),
        F.col("o_orderpriority").alias("TRTNO"), F.when(some, F.to_date("o_orderdate")).alias("ERNTE__Termin"),
        F.when(some, F.col("o_totalprice")).alias("ERNTE__Ertrag"), F.col("o_orderkey").alias("OTHER__x"),
    )


@query("""
    WITH h AS (SELECT o_orderstatus AS experiment_id, year(o_orderdate) AS y, o_custkey % 50 AS plot, o_orderpriority AS trt,
                      o_orderdate::DATE AS d, o_totalprice AS p FROM orders WHERE o_orderkey % 6 <> 0),
    l AS (SELECT * FROM h QUALIFY d = max(d) OVER (PARTITION BY experiment_id, y, plot, trt)),
    u AS (SELECT DISTINCT experiment_id, y, d, p FROM l)
    SELECT experiment_id, y AS "Year", strftime(d, '%Y-%m-%d') AS "ERNTE__Termin", p AS "ERNTE__Ertrag", dense_rank() OVER (PARTITION BY experiment_id ORDER BY y) AS "HA_ID" FROM u
""")
def harvest_section(t: Tables) -> DataFrame:
    rows = harvested(t)
    series, summary = rows.filter(F.col("Year") < 1998), rows.filter(F.col("Year") >= 1998)
    out = sections.harvest(series, summary, BY, "ERNTE__Termin", ["ERNTE"])
    return out.withColumn("ERNTE__Termin", F.date_format("ERNTE__Termin", "yyyy-MM-dd"))


_DU_SQL = """
    WITH d AS (SELECT l_returnflag AS experiment_id, year(l_shipdate) AS y, l_partkey % 3 AS a, l_suppkey % 4 AS b, l_linenumber % 2 AS org,
                      l_quantity AS n, (l_partkey % 3) || '_' || (l_suppkey % 4) AS du FROM lineitem)
"""


def fertilized(t: Tables) -> DataFrame:
    a, b = F.col("l_partkey") % 3, F.col("l_suppkey") % 4
    return t.lineitem.select(
        F.col("l_returnflag").alias("experiment_id"), F.year("l_shipdate").alias("Year"), F.concat_ws("_", a.cast("string"), b.cast("string")).alias("DU_ID"),
        (F.col("l_linenumber") % 2).alias("Organisch"), F.col("l_quantity").alias("Stickstoff"), F.lit(None).cast("double").alias("Leer"),
    )


@query(
    _DU_SQL
    + """SELECT DISTINCT experiment_id, y AS "Year", n AS "Stickstoff", 3.0::DOUBLE AS "OMNPC", round(n * 0.03, 6) AS "OMAMT",
        dense_rank() OVER (PARTITION BY experiment_id ORDER BY y, a) AS "OM_ID" FROM d WHERE org = 1"""
)
def organic_section(t: Tables) -> DataFrame:
    out, _ = sections.fertilizer(fertilized(t), BY, "DU_ID", "Organisch", "OM_ID", 0, [], extra=sections.organic_amount("Stickstoff"))
    return out.withColumn("OMAMT", F.round("OMAMT", 6))


@query(
    _DU_SQL
    + """SELECT DISTINCT experiment_id, y AS "Year", n AS "Stickstoff", dense_rank() OVER (PARTITION BY experiment_id ORDER BY y, b) AS "FE_ID" FROM d WHERE org = 0"""
)
def mineral_section(t: Tables) -> DataFrame:
    rows = fertilized(t).withColumn("Mineralisch", 1 - F.col("Organisch")).drop("Organisch")
    return sections.fertilizer(rows, BY, "DU_ID", "Mineralisch", "FE_ID", 1, [])[0]


@query("""
    WITH c AS (SELECT DISTINCT l_returnflag AS experiment_id, year(l_shipdate) AS y, l_linestatus AS s FROM lineitem)
    SELECT experiment_id, y AS "Year", s AS "SORTE__Sorte", 'K' || s AS "KULTUR__Art", dense_rank() OVER (PARTITION BY experiment_id ORDER BY y) AS "CU_ID" FROM c
""")
def cultivar_section(t: Tables) -> DataFrame:
    sowing = t.lineitem.select(
        F.col("l_returnflag").alias("experiment_id"), F.year("l_shipdate").alias("Year"), F.col("l_linestatus").alias("SORTE__Sorte"),
        F.concat(F.lit("K"), "l_linestatus").alias("KULTUR__Art"), F.col("l_quantity").alias("AUSSAAT__Menge"),
    )
    return sections.cultivars(sowing, BY, ["SORTE", "KULTUR"])


@query(
    _DU_SQL
    + """, o AS (SELECT DISTINCT experiment_id, y, du, dense_rank() OVER (PARTITION BY experiment_id ORDER BY y, a) AS om FROM d WHERE org = 1),
    c AS (SELECT DISTINCT experiment_id, y, dense_rank() OVER (PARTITION BY experiment_id ORDER BY y) AS cu FROM d)
    SELECT DISTINCT d.experiment_id, d.y AS "Year", d.a AS f1, d.b AS f2, coalesce(cu, 0) AS "CU_ID", coalesce(om, 0) AS "OM_ID", d.a || ' | ' || d.b AS "TRT_NAME"
    FROM d LEFT JOIN o USING (experiment_id, y, du) LEFT JOIN c USING (experiment_id, y)"""
)
def treatment_names(t: Tables) -> DataFrame:
    rows = fertilized(t)
    parts = F.split("DU_ID", "_")
    matrix = rows.select(*BY, "Year", "DU_ID", parts[0].cast("long").alias("f1"), parts[1].cast("long").alias("f2")).distinct()
    _, links = sections.fertilizer(rows, BY, "DU_ID", "Organisch", "OM_ID", 0, [])
    grown = sections.cultivars(rows.select(*BY, "Year", F.lit("x").alias("SORTE__s")), BY, ["SORTE"])
    return sections.treatment_table(matrix, [(grown, "CU_ID")], [(links, "OM_ID")], "DU_ID", ("f1", "f2"), BY)


@query("""
    WITH s AS (SELECT o_orderstatus AS experiment_id, o_orderkey, year(o_orderdate) AS y, o_totalprice AS seeds FROM orders),
    r AS (SELECT DISTINCT o_orderstatus AS experiment_id, year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) % 2 = 0)
    SELECT s.experiment_id, o_orderkey, s.y AS "Year", CASE WHEN r.y IS NOT NULL THEN seeds * 0.0001 ELSE seeds END AS seeds, 'S' AS "PLMA", 'R' AS "PLDS"
    FROM s LEFT JOIN r ON s.experiment_id = r.experiment_id AND s.y = r.y
""")
def planting_section(t: Tables) -> DataFrame:
    sowing = t.orders.select(
        F.col("o_orderstatus").alias("experiment_id"), "o_orderkey", F.year("o_orderdate").alias("Year"), F.col("o_totalprice").alias("seeds"), F.lit("x").alias("SORTE__s")
    )
    rotation = sowing.select(*BY, "Year", F.when(F.col("Year") % 2 == 0, "Potato").otherwise("Wheat").alias("crop")).distinct()
    return sections.plantings(sowing, rotation, BY, "seeds", "crop", "SORTE")


# --- second bundle -------------------------------------------------------------------------------

def sites(t: Tables) -> DataFrame:
    return trial_metadata(t).select(
        *BY, "site", "country", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("name").alias("exp_details"), F.lit("1.0").alias("version")
    )


def second_bundle(t: Tables) -> dict[str, DataFrame]:
    tables = trial_tables(t)
    notes = base(t).select("experiment_id", F.col("k").alias("Bemerkungen_ID"), F.concat(F.lit("size "), F.lpad(F.col("size").cast("string"), 2, "0")).alias("Bemerkungen"))
    tables["PARZELLE"] = tables["PARZELLE"].withColumn("Standort_Nr", F.col("Wiederholung") * 10)
    return bundle.complete_bundle(tables | {"BEMERKUNGEN": notes}, sites(t), {"PARZELLE": ["Plot_id"]})


@query(f"""
    WITH {BASE_SQL} SELECT DISTINCT experiment_id, trt AS "TRTNO", 'Treatment ' || trt AS "TREATMENT_NAME", trt AS "TREATMENT_ID", f1 AS "FAKTOR1_STUFE_ID", f2 AS "FAKTOR2_STUFE_ID" FROM base
""")
def bundle_treatments(t: Tables) -> DataFrame:
    return second_bundle(t)["TREATMENTS"]


@query(f"""
    WITH {BASE_SQL} SELECT DISTINCT experiment_id, 1 AS "FL_ID", 'Seefeld' AS "FL_NAME", 51 + e / 100 AS "FL_LAT", 12 + e / 100 AS "FL_LON", 'Germany' AS "SITE_COUNTRY", 10 AS "STANDORT_NR" FROM base
""")
def bundle_fields(t: Tables) -> DataFrame:
    return second_bundle(t)["DESIGN"]


@query(f"""
    WITH {BASE_SQL} SELECT experiment_id, string_agg(DISTINCT 'size ' || lpad(size::VARCHAR, 2, '0'), '; ' ORDER BY 'size ' || lpad(size::VARCHAR, 2, '0')) AS "REMARKS",
        'Seefeld Germany' AS "ADDRESS", 'Trial ' || experiment_id AS "EXPERIMENT_DETAILS", '1.0' AS "VERSION" FROM base GROUP BY 1
""")
def bundle_metadata(t: Tables) -> DataFrame:
    return second_bundle(t)["METADATA"].select(*BY, "REMARKS", "ADDRESS", "EXPERIMENT_DETAILS", "VERSION")


@query(f"""
    WITH {BASE_SQL} SELECT DISTINCT experiment_id, 'Trial ' || experiment_id AS "EXP_DETAILS", 'SEDE' AS "SITE_CODE", '1.0' AS "VERSION" FROM base
""")
def bundle_header(t: Tables) -> DataFrame:
    return second_bundle(t)["HEADER"].drop("PROCESSED_DATE")


@query(f"""
    WITH {BASE_SQL} SELECT experiment_id AS "EXPERIMENT_ID", k * 2 + j AS "BONITUR_ID", y AS "YEAR", plot AS "PLOT_ID", size + j AS "WERT", 'CROP_ASSESSMENT' AS "DATA_TYPE"
    FROM base, (VALUES (0), (1)) v(j)
""")
def bundle_assessments(t: Tables) -> DataFrame:
    return second_bundle(t)["OBSERVATIONS.BONITUR"].drop("DATE")


@query(f"""
    WITH {BASE_SQL} SELECT experiment_id AS "EXPERIMENT_ID", row_number() OVER (PARTITION BY experiment_id ORDER BY k) AS "ID", k AS "ERNTE_ID", price AS "ERTRAG", 'ERNTE DATEN' AS "TYPE" FROM base
""")
def numbered_observations(t: Tables) -> DataFrame:
    table, _ = bundle.observation_table(trial_tables(t)["ERNTE"].select(*BY, "Ernte_ID", "Ertrag"), "ERNTE_DATEN", ["Ernte_ID"])
    return table


@query(f"""
    WITH {BASE_SQL} SELECT experiment_id AS "EXPERIMENT_ID", row_number() OVER (PARTITION BY experiment_id ORDER BY k) AS "ID", k AS "AUSSAAT_ID",
        strftime(make_date(y::INT, 3, 20), '%j') AS day_of_year, 'AUSSAAT' AS "TYPE" FROM base
""")
def dated_management(t: Tables) -> DataFrame:
    table = bundle.management_table(trial_tables(t)["AUSSAAT"].select(*BY, "Aussaat_ID", "Saattermin"), "AUSSAAT", ["Aussaat_ID"])
    return front(table.withColumn("day_of_year", F.date_format("SAATTERMIN", "DDD")).drop("SAATTERMIN"), "ID")


# --- roles, links and checks of the second bundle ---------------------------------------------------

def sampled_tables(t: Tables) -> dict[str, DataFrame]:
    """The trials with soil samples, and their laboratory values in a table of their own."""
    b = base(t)
    year, plot = F.col("y").alias("Versuchsjahr"), F.col("plot").alias("Parzelle_ID")
    samples = b.select("experiment_id", (F.col("k") * 2).alias("Probe_ID"), year, plot)
    lab = b.withColumn("j", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "experiment_id", (F.col("k") * 2 + F.col("j")).alias("Probe_ID"), (F.col("price") + F.col("j")).alias("Messwert")
    )
    return trial_tables(t) | {"PROBENAHME_BODEN": samples, "LABORWERTE": lab}


@query(f"""
    WITH {BASE_SQL} SELECT experiment_id, k * 2 + j AS "Probe_ID", price + j AS "Messwert", CASE WHEN j = 0 THEN y ELSE -1 END AS "Year",
        CASE WHEN j = 0 THEN plot ELSE -1 END AS "Plot_id" FROM base, (VALUES (0), (1)) v(j)
""")
def linked_laboratory(t: Tables) -> DataFrame:
    """Values of a known sample have its year and plot; every second value has none."""
    return bundle.complete_bundle(sampled_tables(t), sites(t), {"PARZELLE": ["Plot_id"]})["OBSERVATIONS.LABORWERTE"].fillna(-1, subset=["Year", "Plot_id"])


@query(f"""
    WITH {BASE_SQL}, n AS (SELECT unnest(['VERSUCHSAUFBAU', 'DUENGUNG', 'AUSSAAT', 'ERNTE', 'PROBENAHME_BODEN', 'LABORWERTE', 'PARZELLE']) AS table_name,
        unnest(['design', 'management', 'management', 'management', 'observed_summary', 'observed_summary', 'other']) AS role, unnest([1, 1, 1, 1, 1, 2, 0]) AS per_row)
    SELECT table_name, role, CASE WHEN per_row = 0 THEN (SELECT count(*) FROM (SELECT DISTINCT experiment_id, plot, trt, block FROM base))
                                  ELSE per_row * (SELECT count(*) FROM base) END AS n_rows FROM n
""")
def table_roles(t: Tables) -> DataFrame:
    """Roles by name, content and link, with the rows of each table."""
    tables = {n: df for n, df in sampled_tables(t).items() if n in ("VERSUCHSAUFBAU", "DUENGUNG", "AUSSAAT", "ERNTE", "PROBENAHME_BODEN", "LABORWERTE", "PARZELLE")}
    roles, _ = bundle.key_table_roles(tables)
    role = {n: r for r, names in roles.items() for n in names}
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), F.lit(role[n]).alias("role"), "n_rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


@query(f"""
    WITH {BASE_SQL} SELECT DISTINCT experiment_id, 'VERSUCHSAUFBAU has no Pruefglied_ID column; no table for plots' AS problems FROM base
""")
def dataset_problems(t: Tables) -> DataFrame:
    """What a dataset lacks, with the experiments that it holds."""
    tables = trial_tables(t)
    broken = {"VERSUCHSAUFBAU": tables["VERSUCHSAUFBAU"].drop("Pruefglied_ID"), "PRUEFGLIED": tables["PRUEFGLIED"]}
    found = "; ".join(sorted(m for _, m in bundle.validate(broken)))
    return broken["VERSUCHSAUFBAU"].select(*BY).distinct().withColumn("problems", F.lit(found))


@query("""
    SELECT 'orders' AS table_name, least(3, count(*)) AS n_rows, 0 AS outside FROM orders UNION ALL SELECT 'region', least(3, count(*)), 0 FROM region
""")
def shown_heads(t: Tables) -> DataFrame:
    """The first rows of each table are three of its rows."""
    whole = {"orders": (t.orders, "o_orderkey"), "region": (t.region, "r_regionkey")}
    heads = bundle.table_heads({n: df for n, (df, _) in whole.items()})
    parts = []
    for n, (df, key) in whole.items():
        marked = null_safe_join(heads[n].select(key), df.select(key).withColumn("known", F.lit(True)), [key])
        parts.append(marked.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("known").isNull()).cast("int").alias("outside")).withColumn("table_name", F.lit(n)))
    return reduce(DataFrame.unionByName, parts)


@query("""
    SELECT n_nationkey, upper(substr(n_name, 1, 2)) || list_extract(['DE', 'JP', 'BR', 'KE', 'US', 'CZ', 'VN'], (n_nationkey % 7 + 1)::INT) AS site_code FROM nation
""")
def site_codes(t: Tables) -> DataFrame:
    """Any country has a code."""
    names = F.array(*[F.lit(c) for c in ("Germany", "Japan", "Brazil", "Kenya", "United States", "Czech Republic", "Vietnam")])
    meta = t.nation.select("n_nationkey", F.lit("x").alias("name"), F.col("n_name").alias("site"), F.get(names, (F.col("n_nationkey") % 7).cast("int")).alias("country"))
    return header_section(meta, ["n_nationkey"]).select("n_nationkey", F.col("SITE_CODE").alias("site_code"))


@query("""
    SELECT o_orderkey, TRUE AS within, TRUE AS repeatable FROM orders
""")
def fixed_variation(t: Tables) -> DataFrame:
    """A variation of three days that depends on the key alone."""
    first, again = jitter(["o_orderkey"], -3, 3, 1), jitter(["o_orderkey"], -3, 3, 1)
    return t.orders.repartition(5).select("o_orderkey", first.between(-3, 3).alias("within"), (first == again).alias("repeatable"))
