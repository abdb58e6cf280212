"""Ids, event numbers and order-dependent flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.operators import ids
from agroloom.operators.scale import dense_ids
from agroloom.plans.sections import harvest_type, initial_conditions
from agroloom.queries import Tables, query


def years(t: Tables) -> DataFrame:
    """Orders with their year and a status that is null for one of its values."""
    return t.orders.withColumns({"year": F.year("o_orderdate"), "status": F.nullif("o_orderstatus", F.lit("P"))})


@query("""
    SELECT o_orderkey, dense_rank() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderpriority, nullif(o_orderstatus, 'P') NULLS LAST) AS id
    FROM orders
""")
def dense_ids_by_year(t: Tables) -> DataFrame:
    return dense_ids(years(t), ["o_orderpriority", "status"], "id", ["year"]).select("o_orderkey", "id")


@query("""
    SELECT l_partkey, l_suppkey, dense_rank() OVER (ORDER BY l_partkey, l_suppkey) AS id FROM lineitem
""")
def dense_ids_global(t: Tables) -> DataFrame:
    return dense_ids(t.lineitem.select("l_partkey", "l_suppkey"), ["l_partkey", "l_suppkey"], "id")


@query("""
    WITH d AS (SELECT o_orderkey, year(o_orderdate) % 2 = 0 AS is_trt,
        dense_rank() OVER (ORDER BY year(o_orderdate), o_orderpriority) AS a,
        dense_rank() OVER (ORDER BY year(o_orderdate), nullif(o_orderstatus, 'P') NULLS LAST) AS b,
        dense_rank() OVER (ORDER BY year(o_orderdate)) AS y FROM orders)
    SELECT o_orderkey, CASE WHEN is_trt THEN a || '_' || b ELSE y::VARCHAR END AS "MANAGEMENT_ID" FROM d
""")
def management_record_ids(t: Tables) -> DataFrame:
    rows = years(t)
    flags = rows.select("year").distinct().withColumn("is_trt", F.col("year") % 2 == 0)
    return ids.management_ids(rows, flags, ["o_orderpriority", "status"], "MANAGEMENT_ID", year="year").select("o_orderkey", "MANAGEMENT_ID")


@query("""
    SELECT event_id, ts::DATE = max(ts::DATE) OVER (PARTITION BY user_id, event_type) AS is_latest FROM events
""")
def latest_events(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    return ids.latest_flag(rows, ["user_id", "event_type"], "day").select("event_id", "is_latest")


@query("""
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '-' WHEN dense_rank() OVER (
        PARTITION BY user_id ORDER BY CASE WHEN event_id % 5 <> 0 THEN ts::DATE END DESC NULLS LAST) > 1 THEN 'is' ELSE 'eos' END AS "HA_type"
    FROM events
""")
def harvest_kinds(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id", F.col("user_id").alias("TRTNO"), F.lit(2024).alias("Year"), F.when(F.col("event_id") % 5 != 0, F.to_date("ts")).alias("day")
    )
    return harvest_type(rows, [], "day").select("event_id", F.coalesce("HA_type", F.lit("-")).alias("HA_type"))


@query("""
    WITH y AS (SELECT o_custkey, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1, 2)
    SELECT o_custkey, year, spent, coalesce(CASE WHEN lag(year) OVER w = year - 1 THEN lag(spent) OVER w END, -1) AS before
    FROM y WINDOW w AS (PARTITION BY o_custkey ORDER BY year)
""")
def previous_year(t: Tables) -> DataFrame:
    yearly = years(t).groupBy("o_custkey", "year").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return ids.previous_year_value(yearly, ["o_custkey"], "year", "spent", "before").fillna(-1.0, subset=["before"])


@query("""
    WITH r AS (SELECT o_custkey, year(o_orderdate) AS year, max(o_orderpriority) AS crop FROM orders GROUP BY 1, 2),
    p AS (SELECT *, CASE WHEN lag(year) OVER w = year - 1 THEN lag(crop) OVER w END AS before FROM r WINDOW w AS (PARTITION BY o_custkey ORDER BY year))
    SELECT o_custkey, year AS "Year", crop, coalesce(before, '-') AS "ICPCR",
           dense_rank() OVER (PARTITION BY o_custkey ORDER BY year, before NULLS LAST) AS "IC_ID" FROM p
""")
def initial_condition_ids(t: Tables) -> DataFrame:
    rotation = years(t).groupBy("o_custkey", F.col("year").alias("Year")).agg(F.max("o_orderpriority").alias("crop"))
    return initial_conditions(rotation, "crop", ["o_custkey"]).fillna("-", subset=["ICPCR"])


@query("""
    SELECT o_orderkey, CASE WHEN o_custkey > 0 THEN o_custkey - min(nullif(o_custkey, 0)) OVER w + 1 ELSE o_custkey END AS "CU",
           CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey % 9 - min(nullif(o_orderkey % 9, 0)) OVER w + 1 ELSE o_orderkey % 9 END AS "MF"
    FROM orders WINDOW w AS (PARTITION BY year(o_orderdate), o_orderpriority)
""")
def reset_ids(t: Tables) -> DataFrame:
    rows = years(t).select("o_orderkey", "year", "o_orderpriority", F.col("o_custkey").alias("CU"), (F.col("o_orderkey") % 9).alias("MF"))
    return ids.reset_ids(rows, ["CU", "MF"], ["year", "o_orderpriority"]).select("o_orderkey", "CU", "MF")


@query("""
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS event_no FROM orders
""")
def event_numbers(t: Tables) -> DataFrame:
    return ids.event_numbers(years(t), ["o_custkey", "year"], "o_orderdate", ["o_orderkey"]).select("o_orderkey", "event_no")


@query("""
    SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY p_type) AS "TRTNO" FROM (SELECT DISTINCT p_brand, p_type FROM part)
""")
def sequence_numbers(t: Tables) -> DataFrame:
    return ids.sequence_ids(t.part.select("p_brand", "p_type").distinct(), ["p_type"], "TRTNO", ["p_brand"])
