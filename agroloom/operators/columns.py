"""Projections: standard names, qualified names, template conformity, defaults."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.functions import dates
from agroloom.operators.profile import NUMBERS
from agroloom.operators.scale import null_safe_join

# Standard names and the synonyms seen in the source tables.
SYNONYMS = {
    "Year": ["Versuchsjahr", "Jahr"],
    "Plot_id": ["Parzelle_ID", "PARZID"],
    "Treatment_id": ["Pruefglied_ID", "PRUEFGLIED"],
    "Rep_no": ["Wiederholung", "WDHLG"],
    "Crop": ["Kultur", "FRUCHT"],
    "Yield": ["Ertrag"],
    "Date": ["Datum", "Termin"],
}


def standard_names(columns: list[str], synonyms: dict[str, list[str]] = SYNONYMS) -> tuple[dict[str, str], list[str]]:
    """Renames for one table, and the columns left alone because the match is not unique.

    Exact matches (ignoring case) go first. A prefix match is taken only when it is the
    sole one and its standard name is still free.
    """
    every = {s.lower() for names in synonyms.values() for s in names}
    taken = set(columns)
    renames: dict[str, str] = {}
    conflicts: list[str] = []
    for std, names in synonyms.items():
        wanted = {n.lower() for n in names}
        hits = [c for c in columns if c.lower() in wanted]
        if len(hits) == 1 and std not in taken:
            renames[hits[0]] = std
            taken.add(std)
        elif len(hits) > 1 or (hits and std in taken and hits != [std]):
            conflicts += hits
    for std, names in synonyms.items():
        hits = [
            c
            for c in columns
            if c not in renames and c.lower() not in every and any(c.lower().startswith(n.lower()) for n in names)
        ]
        if len(hits) == 1 and std not in taken:
            renames[hits[0]] = std
            taken.add(std)
        else:
            conflicts += hits
    return renames, sorted(set(conflicts))


def standardize_names(df: DataFrame, synonyms: dict[str, list[str]] = SYNONYMS) -> DataFrame:
    return df.withColumnsRenamed(standard_names(df.columns, synonyms)[0])


def qualify(df: DataFrame, table: str, keep: list[str], sep: str = "__") -> DataFrame:
    """``TABLE__column`` for every column that is not a join key."""
    return df.withColumnsRenamed({c: f"{table}{sep}{c}" for c in df.columns if c not in keep})


def pick(df: DataFrame, starts: list[str] = (), ends: list[str] = (), contains: list[str] = (), numeric=False) -> list[str]:
    """Column names by prefix, suffix, part (ignoring case) or numeric type."""
    out = []
    for f in df.schema:
        n = f.name.lower()
        if (
            any(n.startswith(s.lower()) for s in starts)
            or any(n.endswith(s.lower()) for s in ends)
            or any(s.lower() in n for s in contains)
            or (numeric and isinstance(f.dataType, NUMBERS))
        ):
            out.append(f.name)
    return out


def front(df: DataFrame, *cols: str) -> DataFrame:
    """Move columns to the left."""
    return df.select(*cols, *[c for c in df.columns if c not in cols])


def drop_empty_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows that are null in all of ``columns`` (which may differ in type)."""
    return df.dropna(how="all", subset=columns) if columns else df


def within_years(df: DataFrame, date: str, first: int, last: int) -> DataFrame:
    """Rows from January 1 of ``first`` to December 31 of ``last``.

    Compared on the stored column, so the range reaches the scan as a pushed filter.
    """
    lo, hi = f"{first:04d}-01-01", f"{last + 1:04d}-01-01"
    kind = df.schema[date].dataType.simpleString()
    return df.filter((F.col(date) >= F.lit(lo).cast(kind)) & (F.col(date) < F.lit(hi).cast(kind)))


def upper_names(df: DataFrame, **tags: str) -> DataFrame:
    """Upper-case headers plus constant tag columns."""
    out = df.toDF(*[c.upper() for c in df.columns])
    return out.withColumns({k: F.lit(v) for k, v in tags.items()}) if tags else out


def rescale_members(df: DataFrame, members: DataFrame, on: list[str], column: str, factor: float) -> DataFrame:
    """Multiply ``column`` where the key appears in ``members``."""
    flags = members.select(*on).distinct().withColumn("__hit", F.lit(True))
    out = null_safe_join(df, flags, on)
    return out.withColumn(
        column, F.when(F.col("__hit"), F.col(column) * F.lit(factor)).otherwise(F.col(column))
    ).drop("__hit")


def conform(df: DataFrame, template: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Exactly the template's columns, types and order; missing ones null, extra ones dropped.

    Values that do not fit the type become null. Dates are read as year-month-day.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in template:
        if f.name.lower() not in have:
            c = F.lit(None).cast(f.dataType)
        else:
            c = F.col(have[f.name.lower()])
            kind = df.schema[have[f.name.lower()]].dataType
            if kind != f.dataType:
                if isinstance(f.dataType, T.DateType) and isinstance(kind, T.StringType):
                    c = dates.parse_date(c, "yyyy-MM-dd")
                else:
                    c = c.try_cast(f.dataType)
        out.append(c.alias(f.name))
    shaped = df.select(*out)
    return shaped.fillna(defaults) if defaults else shaped
