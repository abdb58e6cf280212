"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.operators import merge, profile
from agroloom.operators.columns import qualify, rescale_members
from agroloom.operators.ids import first_row
from agroloom.operators.nesting import collapse_columns, joined_text, numbered_items, text_pieces, unnest, zip_lists
from agroloom.operators.quality import compare_by_checksum, compare_tables, fit_metrics, midpoints, paired_values, section_dates
from agroloom.operators.scale import null_safe_join, rename_join
from agroloom.queries import Tables, query
from agroloom.queries.profiles import star


@query("""
    SELECT o_orderkey AS orderkey, o_totalprice AS orders__totalprice, c_name AS customer__name, c_mktsegment AS customer__mktsegment,
           n_name AS nation__name, r_name AS region__name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
""")
def merged_star(t: Tables) -> DataFrame:
    keys = ["orderkey", "custkey", "nationkey", "regionkey"]
    tables = {n: qualify(df, n, keys) for n, df in star(t).items() if n in ("region", "nation", "customer", "orders")}
    cat = profile.catalog(tables)
    attributes = merge.fold_attributes({n: tables[n] for n in ("region", "nation", "customer")}, cat)
    folded = cat | {n: {"columns": list(df.columns), "key": cat[n]["key"]} for n, df in attributes.items()}
    out, _ = merge.merge_tables({"orders": tables["orders"]}, {"customer": attributes["customer"]}, folded, "child-parent")
    return out["orders"].select("orderkey", "orders__totalprice", "customer__name", "customer__mktsegment", "nation__name", "region__name")


@query("""
    WITH c AS (SELECT o_orderkey, o_orderstatus, o_custkey, c_nationkey AS own, c_nationkey + CASE WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS other
               FROM orders JOIN customer ON o_custkey = c_custkey),
    s AS (SELECT o_orderstatus, bool_and(own = other) AS same FROM c GROUP BY 1)
    SELECT o_orderkey, CASE WHEN same THEN other ELSE -1 END AS nation, CASE WHEN same THEN -1 ELSE own END AS nation_x, CASE WHEN same THEN -1 ELSE other END AS nation_y
    FROM c JOIN s USING (o_orderstatus)
""")
def settled_conflicts(t: Tables) -> DataFrame:
    """Orders and their customers both know the nation; in the statuses where they agree there is one, elsewhere both stay."""
    nations = t.customer.select("c_custkey", "c_nationkey")
    wrong = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 7 == 0)
    placed = null_safe_join(t.orders.withColumn("c_custkey", F.col("o_custkey")), nations, ["c_custkey"], "inner")
    orders = placed.select("o_orderkey", "o_orderstatus", "c_custkey", F.col("c_nationkey").alias("nation"))
    told = placed.select("o_orderkey", "o_orderstatus", (F.col("c_nationkey") + wrong.cast("int")).alias("nation"))
    out = merge.merge_settled(orders, told, ["o_orderstatus", "o_orderkey"], ["o_orderstatus"])
    return out.select("o_orderkey", "nation", "nation_x", "nation_y").fillna(-1)


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, year(o_orderdate) AS year
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def linked_lab_values(t: Tables) -> DataFrame:
    samples = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    return rename_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), samples, {"l_orderkey": "o_orderkey"})


@query("""
    WITH a AS (SELECT nullif(l_returnflag, 'A') AS k, count(*) AS n_lines FROM lineitem GROUP BY 1),
    o AS (SELECT o_orderkey, nullif(list_extract(['A', 'N', 'R'], (o_orderkey % 3 + 1)::INT), 'A') AS k FROM orders)
    SELECT o_orderkey, coalesce(o.k, '-') AS k, n_lines FROM o JOIN a ON o.k IS NOT DISTINCT FROM a.k
""")
def null_key_join(t: Tables) -> DataFrame:
    flags = F.array(F.lit("A"), F.lit("N"), F.lit("R"))
    left = t.orders.select("o_orderkey", F.nullif(F.get(flags, (F.col("o_orderkey") % 3).cast("int")), F.lit("A")).alias("k"))
    right = t.lineitem.groupBy(F.nullif("l_returnflag", F.lit("A")).alias("k")).agg(F.count(F.lit(1)).alias("n_lines"))
    return null_safe_join(left, right, ["k"], "inner").select("o_orderkey", F.coalesce("k", F.lit("-")).alias("k"), "n_lines")


_OBSERVED = """
    WITH o AS (SELECT o_custkey AS plot, year(o_orderdate) AS year, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1, 2),
    l AS (SELECT o_custkey AS plot, year(l_shipdate) AS year, sum(l_quantity) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
"""


def observed_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = t.orders.groupBy(F.col("o_custkey").alias("plot"), F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )
    shipped = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("plot"), F.year("l_shipdate").alias("year"), "l_orderkey", "l_linenumber", "l_quantity"
    )
    lines = shipped.groupBy("plot", "year").agg(F.sum("l_quantity").alias("quantity"))
    return orders, lines, shipped


@query(
    _OBSERVED
    + """SELECT plot, year, coalesce(n_orders, -1) AS n_orders, coalesce(spent, -1) AS spent, coalesce(quantity, -1) AS quantity
    FROM o FULL JOIN l USING (plot, year)"""
)
def observed_full_join(t: Tables) -> DataFrame:
    orders, lines, _ = observed_tables(t)
    return merge.full_join({"orders": orders, "lines": lines}, ["plot", "year"]).fillna(-1)


@query(
    _OBSERVED
    + """, s AS (SELECT o_custkey AS plot, year(l_shipdate) AS year, l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT plot, year, coalesce(l_orderkey, -1) AS l_orderkey, coalesce(l_linenumber, -1) AS l_linenumber,
           coalesce(l_quantity, -1) AS l_quantity, coalesce(n_orders, -1) AS n_orders, coalesce(spent, -1) AS spent
    FROM s FULL JOIN o USING (plot, year)"""
)
def observed_series_join(t: Tables) -> DataFrame:
    orders, _, shipped = observed_tables(t)
    return merge.full_join({"orders": orders, "shipped": shipped}, ["plot", "year"]).fillna(-1)


@query("""
    SELECT o_custkey AS plot, year(o_orderdate) AS year, 'orders' AS source, o_orderkey AS orders__orderkey, -1 AS shipped__orderkey, o_totalprice AS price,
           -1.0::DOUBLE AS quantity FROM orders
    UNION ALL SELECT o_custkey, year(l_shipdate), 'shipped', -1, l_orderkey, -1.0, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def observed_long_form(t: Tables) -> DataFrame:
    orders = t.orders.select(
        F.col("o_custkey").alias("plot"), F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price")
    )
    shipped = observed_tables(t)[2].select("plot", "year", F.col("l_orderkey").alias("orderkey"), F.col("l_quantity").alias("quantity"))
    return merge.stacked({"orders": orders, "shipped": shipped}, ["plot", "year"]).fillna(-1)


@query("""
    WITH a AS (SELECT o_orderkey AS orderkey, year(o_orderdate) AS year, o_orderpriority AS priority FROM orders),
    b AS (SELECT l_orderkey AS orderkey, year(l_shipdate) AS year, l_linenumber AS line FROM lineitem)
    SELECT orderkey, year, priority, -1 AS line FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.orderkey = a.orderkey AND b.year = a.year)
    UNION ALL SELECT orderkey, year, '-', line FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.orderkey = a.orderkey AND b.year = a.year)
""")
def rows_in_one_year(t: Tables) -> DataFrame:
    ordered = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("priority"))
    shipped = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), F.year("l_shipdate").alias("year"), F.col("l_linenumber").alias("line"))
    return merge.rows_in_one(ordered, shipped).fillna(-1).fillna("-")


@query("""
    SELECT o_orderkey AS orderkey, o_totalprice AS price, -1.0::DOUBLE AS quantity, o_orderpriority AS priority FROM orders
    UNION ALL SELECT l_orderkey, -1.0, l_quantity, '-' FROM lineitem
""")
def padded_union(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
    lines = t.lineitem.select(F.col("l_quantity").alias("quantity"), F.col("l_orderkey").alias("orderkey"))
    return merge.union_padded(orders, lines).fillna(-1.0).fillna("-")


_INSERT = """
    WITH e AS (SELECT p_partkey AS code, p_name || '#' || p_partkey AS name, 0 AS batch FROM part),
    n AS (SELECT p_partkey * 2 + 1 AS code, p_name || '#' || (p_partkey * 3) AS name, 1 AS batch FROM part),
    a AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE contains(e.code::VARCHAR, n.code::VARCHAR)) AND NOT EXISTS (SELECT 1 FROM e WHERE contains(e.name, n.name)))
"""


def insert_parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    def named(code, number, batch: int) -> DataFrame:
        return t.part.select(code.alias("code"), F.concat("p_name", F.lit("#"), number.cast("string")).alias("name"), F.lit(batch).alias("batch"))

    k = F.col("p_partkey")
    return merge.guarded_insert(named(k, k, 0), named(k * 2 + 1, k * 3, 1), ["code", "name"])


@query(_INSERT + "SELECT * FROM e UNION ALL SELECT * FROM a")
def guarded_insert(t: Tables) -> DataFrame:
    return insert_parts(t)[0]


@query(_INSERT + "SELECT * FROM n EXCEPT ALL SELECT * FROM a")
def refused_inserts(t: Tables) -> DataFrame:
    return insert_parts(t)[1]


@query("""
    SELECT o_orderkey, o_totalprice * CASE WHEN c_mktsegment = 'MACHINERY' THEN 0.5 ELSE 1 END AS o_totalprice
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def rescaled_members(t: Tables) -> DataFrame:
    machines = t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("o_custkey"))
    return rescale_members(t.orders, machines, ["o_custkey"], "o_totalprice", 0.5).select("o_orderkey", "o_totalprice")


@query("""
    SELECT o_custkey, count(*) AS n_items, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS items FROM orders GROUP BY 1
""")
def collapsed_orders(t: Tables) -> DataFrame:
    nested = collapse_columns(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_orderkey", "o_totalprice"], ["o_orderkey"])
    return nested.select(
        "o_custkey", F.size("items").cast("long").alias("n_items"),
        F.array_join(F.transform("items", lambda s: s["o_orderkey"].cast("string")), ",").alias("items"),
    )


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def unnested_orders(t: Tables) -> DataFrame:
    nested = collapse_columns(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_orderkey", "o_totalprice"], ["o_orderkey"]
    )
    return unnest(nested)


@query("""
    SELECT o_custkey, o_orderkey AS k, o_totalprice AS v FROM orders
""")
def zipped_lists(t: Tables) -> DataFrame:
    nested = collapse_columns(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_orderkey", "o_totalprice"], ["o_orderkey"])
    lists = nested.select("o_custkey", F.col("items.o_orderkey").alias("k"), F.col("items.o_totalprice").alias("v"))
    return zip_lists(lists, ["k", "v"])


@query("""
    SELECT l_returnflag, l_quantity, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity, l_orderkey, l_linenumber) AS number FROM lineitem
""")
def numbered_lines(t: Tables) -> DataFrame:
    """Three lists of all lines, with the place of each item."""
    return numbered_items(t.lineitem, ["l_quantity", "l_orderkey", "l_linenumber"], ["l_quantity"], ["l_returnflag"])


@query("""
    WITH d AS (SELECT DISTINCT o_orderstatus, o_orderpriority || '/' || o_custkey AS v FROM orders),
    n AS (SELECT *, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY v) - 1) // 100 AS piece FROM d)
    SELECT o_orderstatus, piece, CASE WHEN piece > 0 THEN '; ' ELSE '' END || string_agg(v, '; ' ORDER BY v) AS text FROM n GROUP BY 1, 2
""")
def remark_pieces(t: Tables) -> DataFrame:
    """Priorities and customers of a status as one long text, in pieces of a hundred."""
    rows = t.orders.select("o_orderstatus", F.concat_ws("/", "o_orderpriority", F.col("o_custkey").cast("string")).alias("v"))
    return text_pieces(rows, ["o_orderstatus"], "v", most=100)


@query("""
    SELECT conv_id, string_agg(DISTINCT text, '; ' ORDER BY text) AS remarks FROM conversations GROUP BY 1
""")
def joined_remarks(t: Tables) -> DataFrame:
    return joined_text(t.conversations, ["conv_id"], "text", "remarks")


@query("""
    SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) = 1
""")
def first_rows(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return first_row(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_quantity"])


def simulated(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Order totals as observations, and a copy moved by a rule as simulation."""
    obs = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("trt"), F.col("o_totalprice").alias("yield"), F.year("o_orderdate").cast("double").alias("day"))
    shift = (F.col("o_orderkey") % 7 - 3).cast("double")
    return obs.withColumns({"yield": F.col("yield") + shift, "day": F.col("day") + shift / 2}), obs


@query("""
    WITH d AS (SELECT o_orderpriority AS trt, (o_totalprice + (o_orderkey % 7 - 3)) - o_totalprice AS a,
                      (o_orderkey % 7 - 3) / 2 AS b FROM orders),
    l AS (SELECT trt, 'yield' AS variable, a AS d FROM d UNION ALL SELECT trt, 'day', b FROM d)
    SELECT trt, variable, count(*) AS n, round(avg(d), 6) + 0.0 AS bias, round(sqrt(avg(d * d)), 6) AS rmse, round(avg(abs(d)), 6) AS mae
    FROM l GROUP BY 1, 2
""")
def simulated_fit(t: Tables) -> DataFrame:
    sim, obs = simulated(t)
    fit = fit_metrics(paired_values(sim, obs, ["o_orderkey", "trt"], ["yield", "day"]), ["trt", "variable"])
    return fit.select("trt", "variable", "n", *[F.round(c, 6).alias(c) for c in ("bias", "rmse", "mae")])


@query("""
    SELECT 'trt' AS column_name, 0 AS n_differ, count(*) AS n_matched, 0 AS n_one_side FROM orders
    UNION ALL SELECT 'yield', count_if(abs(o_orderkey % 7 - 3) > 1), count(*), 0 FROM orders
    UNION ALL SELECT 'day', count_if(abs(o_orderkey % 7 - 3) / 2 > 1), count(*), 0 FROM orders
""")
def compared_tables(t: Tables) -> DataFrame:
    sim, obs = simulated(t)
    return compare_tables(sim, obs, ["o_orderkey"])


@query("""
    SELECT 'trt' AS column_name, 0 AS n_differ, count_if(o_orderkey % 1009 <> 5) AS n_matched, count_if(o_orderkey % 1009 = 5) AS n_one_side FROM orders
    UNION ALL SELECT 'yield', count_if(o_orderkey % 211 = 3 AND o_orderkey % 1009 <> 5), count_if(o_orderkey % 1009 <> 5), count_if(o_orderkey % 1009 = 5) FROM orders
    UNION ALL SELECT 'day', 0, count_if(o_orderkey % 1009 <> 5), count_if(o_orderkey % 1009 = 5) FROM orders
""")
def checksummed_tables(t: Tables) -> DataFrame:
    """Tables that differ in a few cells and a few rows, compared by the checksums of their ranges first."""
    _, obs = simulated(t)
    other = obs.withColumn("yield", F.col("yield") + F.when(F.col("o_orderkey") % 211 == 3, 2.0).otherwise(0.0)).where("o_orderkey % 1009 <> 5")
    return compare_by_checksum(obs, other, ["o_orderkey"])


@query("""
    SELECT p_brand, (min(p_size) + max(p_size)) / 2 AS p_size, round((min(p_retailprice) + max(p_retailprice)) / 2, 6) AS p_retailprice FROM part GROUP BY 1
""")
def parameter_midpoints(t: Tables) -> DataFrame:
    return midpoints(t.part, ["p_brand"], ["p_size", "p_retailprice"]).withColumn("p_retailprice", F.round("p_retailprice", 6))


@query("""
    WITH d AS (SELECT o_custkey, o_orderdate::DATE AS d FROM orders
               UNION ALL SELECT o_custkey, l_shipdate::DATE FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT o_custkey, strftime(min(d), '%Y-%m-%d') AS first_date, count(DISTINCT year(d)) AS n_years FROM d GROUP BY 1
""")
def earliest_dates(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", F.col("o_orderdate").alias("PDATE"))
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", F.col("l_shipdate").alias("HDATE"))
    out = section_dates({"PLANTING": orders, "HARVEST": lines}, ["o_custkey"])
    return out.withColumn("first_date", F.date_format("first_date", "yyyy-MM-dd"))
