"""Keys, links, column roles, dates and table classes found from the values."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.operators import profile
from agroloom.operators.scale import null_safe_join
from agroloom.operators.tagging import classify_names, tag_years, treatment_years, year_counts
from agroloom.queries import Tables, query
from agroloom.session import scratch_path
from agroloom.sources.files import typed

# All columns of these tables, in file order.
PROFILED = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
}


def _profile_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {i + 1} AS position, '{c}' AS column_name, count(*) AS n_rows, "
        f"count(*) - count({c}) AS n_null, "
        f"count(*) = count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 END), 0) AS is_key FROM {t}"
        for t, cols in PROFILED.items()
        for i, c in enumerate(cols)
    )
    return f"""WITH p AS ({rows})
        SELECT *, is_key AND position = min(CASE WHEN is_key THEN position END) OVER (PARTITION BY table_name) AS is_primary
        FROM p"""


@query(f"SELECT * REPLACE (coalesce(is_primary, false) AS is_primary) FROM ({_profile_sql()})")
def key_profiles(t: Tables) -> DataFrame:
    with ThreadPoolExecutor() as pool:
        parts = list(pool.map(lambda n: profile.key_profile(getattr(t, n).select(*PROFILED[n]), n), PROFILED))
    return reduce(DataFrame.unionByName, parts)


def star(t: Tables) -> dict[str, DataFrame]:
    """The star schema with the table prefixes cut off, so that keys share their names."""
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    tables = {n: getattr(t, n) for n in names}
    return {n: df.toDF(*[c.split("_", 1)[1] for c in df.columns]) for n, df in tables.items()}


_EDGES = [
    ("customer", "nation", "nationkey", "c_nationkey", "n_nationkey"),
    ("lineitem", "orders", "orderkey", "l_orderkey", "o_orderkey"),
    ("lineitem", "part", "partkey", "l_partkey", "p_partkey"),
    ("lineitem", "supplier", "suppkey", "l_suppkey", "s_suppkey"),
    ("nation", "region", "regionkey", "n_regionkey", "r_regionkey"),
    ("orders", "customer", "custkey", "o_custkey", "c_custkey"),
    ("supplier", "nation", "nationkey", "s_nationkey", "n_nationkey"),
]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS child, '{p}' AS parent, '{k}' AS key_column, "
        f"(SELECT count(DISTINCT {ck}) FROM {c} WHERE {ck} NOT IN (SELECT {pk} FROM {p})) AS n_orphans"
        for c, p, k, ck, pk in _EDGES
    )
)
def parent_links(t: Tables) -> DataFrame:
    tables = star(t)
    edges = profile.parent_edges(profile.catalog(tables))
    parts = [
        profile.orphans(tables[c], tables[p], k)
        .agg(F.count(F.lit(1)).alias("n_orphans"))
        .select(F.lit(c).alias("child"), F.lit(p).alias("parent"), F.lit(k).alias("key_column"), "n_orphans")
        for c, p, k in edges
    ]
    return reduce(DataFrame.unionByName, parts)


_YEAR_COLS = {"Jahr": "year(o_orderdate)", "custkey": "o_custkey", "price": "o_totalprice", "const": "2000"}


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, min({e})::DOUBLE AS min_value, max({e})::DOUBLE AS max_value, "
        f"bool_and({e} BETWEEN 1995 AND 2001) AS in_range FROM orders"
        for n, e in _YEAR_COLS.items()
    )
)
def years_column(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.year("o_orderdate").alias("Jahr"), F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("price"), F.lit(2000).alias("const")
    )
    return profile.years_columns(rows, 1995, 2001)


# parts as plots of a field design: forty plots a year, eight treatments in five blocks
DESIGN_SQL = """
    design AS (SELECT p_partkey // 400 AS exp, 1990 + (p_partkey // 40) % 10 AS jahr, 100 + p_partkey % 40 AS plot,
                      p_partkey % 8 AS trt, (p_partkey % 40) // 8 AS block, p_size AS size FROM part)
"""


def design(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(
        F.floor(k / 400).alias("exp"),
        (1990 + F.floor(k / 40) % 10).alias("jahr"),
        (100 + k % 40).alias("plot"),
        (k % 8).alias("trt"),
        F.floor(k % 40 / 8).alias("block"),
        F.col("p_size").alias("size"),
    )


@query(
    f"WITH {DESIGN_SQL} "
    + " UNION ALL ".join(
        f"SELECT exp, '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) = count(DISTINCT plot) AS fits_plots FROM design GROUP BY exp"
        for c in ("jahr", "plot", "trt", "block", "size")
    )
)
def plots_column(t: Tables) -> DataFrame:
    rows = design(t)
    prof = profile.distinct_profile(rows, ["exp"], ["jahr", "plot", "trt", "block", "size"])
    plots = prof.filter(F.col("column_name") == "plot").select("exp", F.col("n_distinct").alias("n_plots"))
    out = null_safe_join(prof, plots, ["exp"])
    return out.select("exp", "column_name", "n_distinct", (F.col("n_distinct") == F.col("n_plots")).alias("fits_plots"))


@query(
    f"""WITH {DESIGN_SQL},
    s AS (SELECT exp, count(DISTINCT jahr) AS ny, count(DISTINCT plot) AS np FROM design GROUP BY exp),
    d AS (SELECT DISTINCT exp, jahr, trt, block, size FROM design),
    c AS ("""
    + " UNION ALL ".join(f"SELECT exp, '{c}' AS column_name, {c}::VARCHAR AS v, count(*) AS n FROM d GROUP BY exp, {c}" for c in ("trt", "block", "size"))
    + """), g AS (SELECT exp, column_name, min(n) AS lo, max(n) AS hi FROM c GROUP BY 1, 2)
    SELECT exp, column_name, round(lo / ny, 6) AS reps, lo = hi AND lo / ny < np AS is_treatment FROM g JOIN s USING (exp)"""
)
def treatment_column(t: Tables) -> DataFrame:
    found = profile.treatment_columns(design(t), "jahr", "plot", ["exp"])
    return found.select("exp", "column_name", F.round("reps", 6).alias("reps"), "is_treatment")


@query("""
    WITH p AS (SELECT l.*, p_brand FROM lineitem l JOIN part ON l_partkey = p_partkey),
    a AS (SELECT 'tax' AS table_name, p_brand AS scope, year(l_shipdate) AS year, count(DISTINCT l_tax) AS n_records, count(*) AS n_rows FROM p GROUP BY 2, 3
      UNION ALL SELECT 'line', p_brand, year(l_shipdate), count(DISTINCT l_linenumber), count(*) FROM p GROUP BY 2, 3
      UNION ALL SELECT 'order', o_orderpriority, year(o_orderdate), count(DISTINCT (o_orderstatus, o_totalprice)), count(*) FROM orders GROUP BY 2, 3),
    n AS (SELECT 'tax' AS table_name, p_brand AS scope, count(DISTINCT l_suppkey) AS n_plots FROM p GROUP BY 2
      UNION ALL SELECT 'line', p_brand, count(DISTINCT l_suppkey) FROM p GROUP BY 2
      UNION ALL SELECT 'order', o_orderpriority, count(DISTINCT o_custkey) FROM orders GROUP BY 2)
    SELECT table_name, scope, year, n_records, n_rows,
           CASE WHEN avg(n_records) OVER (PARTITION BY table_name, scope) <= 8 THEN 'management'
                WHEN n_rows <= n_plots THEN 'observed_summary' ELSE 'observed_timeseries' END AS tag
    FROM a JOIN n USING (table_name, scope)
""")
def tagged_years(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    base = [F.col("p_brand").alias("scope"), F.year("l_shipdate").alias("year"), F.col("l_suppkey").alias("plot")]
    tables = {
        "tax": lines.select(*base, "l_tax"),
        "line": lines.select(*base, "l_linenumber"),
        "order": t.orders.select(
            F.col("o_orderpriority").alias("scope"), F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("plot"), "o_orderstatus", "o_totalprice"
        ),
    }
    parts = []
    for name, df in tables.items():
        plots = df.select("scope", "plot").distinct().groupBy("scope").agg(F.count(F.lit(1)).alias("n_plots"))
        tags = tag_years(df, "year", "plot", plots, by=["scope"])
        parts.append(tags.select(F.lit(name).alias("table_name"), "scope", "year", "n_records", "n_rows", "tag"))
    return reduce(DataFrame.unionByName, parts)


@query("""
    WITH e AS (SELECT l_orderkey AS scope, year(l_shipdate) AS year, l_linestatus AS plot, l_returnflag AS sig,
                      row_number() OVER (PARTITION BY l_orderkey, year(l_shipdate), l_linestatus ORDER BY l_returnflag) AS k FROM lineitem),
    p AS (SELECT scope, count(DISTINCT plot) AS np FROM e GROUP BY 1),
    d AS (SELECT scope, year, k, count(DISTINCT sig) AS n, count(*) AS plots FROM e GROUP BY 1, 2, 3)
    SELECT scope, year, bool_or(n + CASE WHEN plots < np THEN 1 ELSE 0 END > 1) AS is_trt FROM d JOIN p USING (scope) GROUP BY 1, 2
""")
def treatment_flags(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("scope"), F.year("l_shipdate").alias("year"), F.col("l_linestatus").alias("plot"), F.col("l_returnflag").alias("sig")
    )
    return treatment_years(rows, "year", "plot", by=["scope"])


@query("""
    SELECT year(o_orderdate) AS year, count(*) AS n_rows FROM orders GROUP BY 1
""")
def rows_per_year(t: Tables) -> DataFrame:
    return year_counts(t.orders.select(F.year("o_orderdate").alias("year")), "year")


def printed_dates(t: Tables) -> DataFrame:
    """Order dates printed in several layouts, with values that are no dates beside them."""
    d = "o_orderdate"
    return t.orders.select(
        F.date_format(d, "yyyy-MM-dd").alias("iso"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("compact"),
        F.date_format(d, "dd.MM.yyyy").alias("dotted"),
        F.date_format(d, "MM/dd/yyyy").alias("slashed"),
        F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"),
        F.date_format(d, "yyDDD").cast("int").alias("code"),
        (12001 + F.col("o_custkey") % 168).cast("int").alias("plot"),
        F.col("o_orderpriority").alias("word"),
    )


_LAYOUTS = {"iso": "yyyy-MM-dd", "compact": "yyyyMMdd", "dotted": "d.M.yyyy", "slashed": "M/d/yyyy", "stamp": "yyyy-MM-dd'T'HH:mm:ss", "code": "yyDDD"}


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{lay.replace(chr(39), chr(39) * 2)}' AS layout, count(*) AS n, "
        "strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders"
        for c, lay in _LAYOUTS.items()
    )
)
def date_columns(t: Tables) -> DataFrame:
    rows = printed_dates(t)
    layouts = profile.date_layouts(rows, doy=["code"])
    parsed = profile.dates_parsed(rows, layouts)
    items = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.array_join(F.array(*[F.lit(x) for x in lays]), " ").alias("layout"), F.col(f"n_{c}").alias("n"),
                 F.date_format(f"a_{c}", "yyyy-MM-dd").alias("first_day"), F.date_format(f"b_{c}", "yyyy-MM-dd").alias("last_day"))
        for c, lays in layouts.items()
    ])
    aggs = [f(c).alias(f"{k}_{c}") for c in layouts for k, f in (("n", F.count), ("a", F.min), ("b", F.max))]
    return parsed.agg(*aggs).select(F.explode(items).alias("i")).select("i.*")


@query("""
    SELECT 'several' AS name, TRUE AS multiple, count(*) AS n FROM orders UNION ALL SELECT 'one', FALSE, count(*) FROM orders
""")
def multiple_date_columns(t: Tables) -> DataFrame:
    printed = printed_dates(t)
    cases = {"several": printed, "one": printed.select("iso", "code")}
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), F.lit(profile.has_multiple_date_columns(df)).alias("multiple"), "n") for n, df in cases.items()]
    return parts[0].unionByName(parts[1])


@query("""
    SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d') AS same FROM orders
""")
def scoped_date_layouts(t: Tables) -> DataFrame:
    """Every status prints its dates in another layout; a second column has one layout throughout, a third is no date in one scope."""
    layout = {"F": "yyyy-MM-dd", "O": "dd.MM.yyyy", "P": "M/d/yyyy"}
    printed = F.coalesce(*[F.when(F.col("o_orderstatus") == s, F.date_format("o_orderdate", x)) for s, x in layout.items()])
    rows = t.orders.select(
        "o_orderkey", "o_orderstatus", printed.alias("day"), F.date_format("o_orderdate", "yyyyMMdd").alias("same"),
        F.when(F.col("o_orderstatus") == "P", F.lit("none")).otherwise(printed).alias("broken"),
    )
    layouts = profile.date_layouts(rows, ["day", "same", "broken"], by=["o_orderstatus"])
    parsed = profile.dates_parsed(rows, layouts, ["o_orderstatus"])
    return parsed.select("o_orderkey", "o_orderstatus", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in layouts])


@query("""
    SELECT 'iso' AS column_name, count(*) AS n FROM orders
    UNION ALL SELECT 'dotted', count(*) FROM orders UNION ALL SELECT 'slashed', count(*) FROM orders
""")
def date_share_columns(t: Tables) -> DataFrame:
    rows = printed_dates(t)
    found = profile.date_columns_by_share(rows)
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in found])
    return rows.agg(*[F.count(c).alias(c) for c in found]).select(F.explode(items).alias("i")).select("i.*")


# table names in the style of the landed files, one per part
NAMES = [
    "STICKSTOFFBILANZ", "ENERGIEBILANZ", "DUENGUNG", "AUSSAAT", "ERNTE", "BODENBEARBEITUNG", "FRUCHTFOLGE", "PFLANZENSCHUTZ",
    "BODENLABORWERTE", "BONITUR", "KLIMADATEN", "PARZELLE", "SORTE",
]


@query(f"""
    WITH n AS (SELECT p_partkey, p_type || '_V1_0_' || list_extract({NAMES!r}, (p_partkey % 13 + 1)::INT) AS name FROM part)
    SELECT p_partkey, name,
      CASE WHEN regexp_matches(name, 'STICKSTOFFBILANZ|N_BILANZ|NBILANZ|ENERGIEBILANZ|E_BILANZ|EBILANZ') THEN 'balance'
           WHEN regexp_matches(name, 'ERNTE|DUENGUNG|BODENBEARBEITUNG|AUSSAAT|FRUCHTFOLGE') THEN 'management'
           WHEN regexp_matches(name, 'PFLANZENSCHUTZ|BODENBIOLOGIE|PROBENAHME|LABORWERTE|BONITUR|KLIMADATEN') THEN 'observation'
           ELSE '-' END AS table_class FROM n
""")
def classified_names(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(n) for n in NAMES])
    rows = t.part.select("p_partkey", F.concat("p_type", F.lit("_V1_0_"), F.get(names, (F.col("p_partkey") % 13).cast("int"))).alias("name"))
    return classify_names(rows, "name").select("p_partkey", "name", F.coalesce("table_class", F.lit("-")).alias("table_class"))


@query("""
    SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def typed_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customers")
    t.customer.withColumn("empty", F.lit(None).cast("string")).write.option("header", True).csv(path)
    return typed(t.spark.read.option("header", True).csv(path))


@query("""
    SELECT p_partkey, p_retailprice FROM part
""")
def comma_numbers(t: Tables) -> DataFrame:
    printed = t.part.select("p_partkey", F.regexp_replace(F.col("p_retailprice").cast("string"), r"\.", ",").alias("p_retailprice"))
    return profile.promote_numbers(printed, r"^[0-9.,-]+$", comma=True)
