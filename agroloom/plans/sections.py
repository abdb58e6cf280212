"""Section tables derived from a reshaped bundle: crops, harvests, fertilizers, treatments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.functions.text import split_parts
from agroloom.operators.columns import drop_empty_rows, pick, rescale_members
from agroloom.operators.ids import latest_flag, previous_year_value
from agroloom.operators.merge import union_padded
from agroloom.operators.profile import NUMBERS, drop_null_columns
from agroloom.operators.scale import dense_ids, null_safe_join


def zero_filled(df: DataFrame) -> DataFrame:
    """Null numbers as 0."""
    return df.fillna(0, subset=[f.name for f in df.schema if isinstance(f.dataType, NUMBERS)])


def initial_conditions(rotation: DataFrame, crop: str, by: list[str], year: str = "Year") -> DataFrame:
    """Previous crop of every year and the id of (year, previous crop)."""
    yearly = rotation.select(*by, year, crop).distinct()
    before = previous_year_value(yearly, by, year, crop, "ICPCR")
    return dense_ids(before, [year, "ICPCR"], "IC_ID", by).select("IC_ID", *by, year, crop, "ICPCR")


def harvest(
    series: DataFrame, summary: DataFrame, by: list[str], date: str, prefixes: list[str], year: str = "Year"
) -> DataFrame:
    """Final harvests: the latest date per plot and year, from both observed tables."""
    keys = [*by, year, "Plot_id", "TRTNO"]
    rows = union_padded(
        *[df.select(*keys, *[c for c in pick(df, starts=prefixes) if c not in keys]) for df in (series, summary)]
    )
    filled = drop_empty_rows(rows, [c for c in rows.columns if c not in keys])
    last = latest_flag(filled, keys, date).filter("is_latest")
    out = last.drop("Plot_id", "TRTNO", "is_latest").distinct()
    return dense_ids(out, [year], "HA_ID", by)


def harvest_type(series: DataFrame, by: list[str], date: str, year: str = "Year") -> DataFrame:
    """``eos`` on the latest date of a treatment year, ``is`` before it, null without a date."""
    marked = latest_flag(series, [*by, year, "TRTNO"], date, "__last")
    kind = F.when(F.col("__last"), "eos").when(~F.col("__last"), "is")
    return marked.withColumn("HA_type", kind).drop("__last")


def fertilizer(
    events: DataFrame,
    by: list[str],
    id_column: str,
    flag: str,
    name: str,
    part: int,
    drops: list[str],
    year: str = "Year",
    extra: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fertilizer records of one kind with an id of their own.

    The combined id ``organic_mineral`` is split; part 0 numbers organic, part 1 mineral
    events. Returns the records and the link (combined id, year, new id).
    """
    rows = events.filter(F.col(flag) == 1)
    rows = rows.withColumn("__part", split_parts(F.col(id_column), "_", 2)[part])
    if extra:
        rows = rows.withColumns(extra)
    numbered = dense_ids(rows, [year, "__part"], name, by).drop("__part", flag, *drops)
    slim = zero_filled(drop_null_columns(numbered, keep=[*by, year, name, id_column]))
    return slim.drop(id_column).distinct(), slim.select(*by, id_column, year, name).distinct()


def organic_amount(nitrogen: str, percent: float = 3.0) -> dict[str, Column]:
    """Organic matter from its nitrogen (kept as nitrogen x percent x 0.01)."""
    return {"OMNPC": F.lit(percent), "OMAMT": F.col(nitrogen) * F.lit(percent) * F.lit(0.01)}


def cultivars(sowing: DataFrame, by: list[str], prefixes: list[str], year: str = "Year") -> DataFrame:
    rows = sowing.select(*by, year, *[c for c in pick(sowing, starts=prefixes) if c not in (*by, year)]).distinct()
    return dense_ids(rows, [year], "CU_ID", by)


def plantings(
    sowing: DataFrame, rotation: DataFrame, by: list[str], seeds: str, crop: str, drop_prefix: str, tuber: str = "Potato", year: str = "Year"
) -> DataFrame:
    """Sowing records; seed counts of tuber years are per hectare and rescaled."""
    slim = sowing.drop(*[c for c in pick(sowing, starts=[drop_prefix]) if c not in (*by, year)])
    years = rotation.filter(F.col(crop) == tuber)
    scaled = rescale_members(slim, years, [*by, year], seeds, 0.0001)
    return scaled.withColumns({"PLMA": F.lit("S"), "PLDS": F.lit("R")})


def mid_elevation(fields: DataFrame, low: str, high: str) -> DataFrame:
    return fields.withColumn("FLELE", (F.col(low) + F.col(high)) / 2)


def treatment_table(
    matrix: DataFrame,
    yearly: list[tuple[DataFrame, str]],
    linked: list[tuple[DataFrame, str]],
    id_column: str,
    factors: tuple[str, str],
    by: list[str],
    year: str = "Year",
) -> DataFrame:
    """Treatment matrix with section ids: ``yearly`` join on the year, ``linked`` on the combined
    id and year. Missing ids are 0; the name joins both factor levels."""
    out = matrix
    for df, name in yearly:
        out = null_safe_join(out, df.select(*by, year, name).distinct(), [*by, year])
    for df, name in linked:
        out = null_safe_join(out, df.select(*by, id_column, year, name).distinct(), [*by, id_column, year])
    a, b = (F.coalesce(F.col(f).cast("string"), F.lit("NA")) for f in factors)
    return zero_filled(out).drop(id_column).withColumn("TRT_NAME", F.concat(a, F.lit(" | "), b)).distinct()
