"""The second bundle: tables classed by name patterns, with validation and site settings.

The scope column ``experiment_id`` takes the place of one run per dataset.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.operators.columns import standardize_names, upper_names
from agroloom.operators.ids import first_row, sequence_ids
from agroloom.operators.merge import union_padded
from agroloom.operators.nesting import joined_text
from agroloom.operators.profile import date_layouts, dates_parsed, has_multiple_date_columns, promote_numbers
from agroloom.operators.scale import null_safe_join
from agroloom.operators.tagging import class_of, key_tables, link_tables

BY = ["experiment_id"]

# Table patterns a dataset must have, and the design columns in either naming.
REQUIRED_TABLES = {"design": "VERSUCHSAUFBAU|L0212", "treatments": "PRUEFGLIED|L0214", "plots": "PARZELLE|L0213"}
REQUIRED_COLUMNS = {"Year": "Versuchsjahr", "Plot_id": "Parzelle_ID", "Treatment_id": "Pruefglied_ID"}

# Remark columns in order of preference; name starts of field and treatment columns.
REMARK_COLUMNS = ("Bemerkung", "BEMERKUNG", "Bemerkungen", "BEMERKUNGEN", "Comment", "COMMENT")
FIELD_STARTS = ("field", "fl_", "standort")
TREATMENT_STARTS = ("pruefglied", "treatment", "variante", "faktor", "factor")


def find_table(names: list[str], pattern: str) -> str | None:
    return next((n for n in names if re.search(pattern, n, re.I)), None)


def validate(db: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """(severity, message) for missing tables and design columns."""
    names = list(db)
    report = [
        ("error", f"no table for {role}") for role, pattern in REQUIRED_TABLES.items() if find_table(names, pattern) is None
    ]
    design = find_table(names, REQUIRED_TABLES["design"])
    if design:
        have = set(db[design].columns)
        report += [
            ("error", f"{design} has no {src} column")
            for std, src in REQUIRED_COLUMNS.items()
            if not {std, src} & have
        ]
    return report


def require_valid(db: dict[str, DataFrame]) -> None:
    errors = [m for level, m in validate(db) if level == "error"]
    if errors:
        raise ValueError("; ".join(errors))


def climate(df: DataFrame) -> DataFrame:
    out = upper_names(df, DATA_TYPE="CLIMATE")
    return out.withColumn("DATE", F.to_date("DATUM")) if "DATUM" in out.columns else out


def crop_assessment(df: DataFrame) -> DataFrame:
    out = upper_names(df, DATA_TYPE="CROP_ASSESSMENT")
    return out.withColumn("ASSESSMENT_TYPE", F.col("BONITUR_TYP")) if "BONITUR_TYP" in out.columns else out


def crop_rotation(df: DataFrame) -> DataFrame:
    return upper_names(df, DATA_TYPE="CROP_ROTATION")


def balance(df: DataFrame, kind: str) -> DataFrame:
    """Balances: upper-case headers, comma decimals as numbers, kind tags and the date or year."""
    out = promote_numbers(upper_names(df), r"^[0-9.,-]+$", comma=True)
    out = out.withColumns({"BALANCE_TYPE": F.lit(kind), "DATA_TYPE": F.lit(f"{kind}_BALANCE")})
    if "DATUM" in out.columns:
        return out.withColumn("DATE", F.to_date("DATUM"))
    return out.withColumn("YEAR", F.col("JAHR").cast("double")) if "JAHR" in out.columns else out


def observation_table(df: DataFrame, name: str, order: list[str], by: list[str] = BY) -> tuple[DataFrame, bool]:
    """Upper-case headers, an ``ID`` if there is none, the ``TYPE``; whether it is a time series."""
    out = upper_names(df)
    scope = [b.upper() for b in by]
    if "ID" not in out.columns:
        out = sequence_ids(out, [c.upper() for c in order], "ID", scope)
    out = out.withColumn("TYPE", F.lit(name.replace("_", " ").upper()))
    return out, bool(date_layouts(out))


def management_table(df: DataFrame, name: str, order: list[str], by: list[str] = BY) -> DataFrame:
    """As :func:`observation_table`, with year-month-day text as dates."""
    out, _ = observation_table(df, name, order, by)
    layouts = {c: lays for c, lays in date_layouts(out).items() if all(x.startswith("yyyy-MM-dd") for x in lays)}
    return dates_parsed(out, layouts) if layouts else out


def fields(plots: DataFrame | None, sites: DataFrame, key: list[str], by: list[str] = BY) -> DataFrame:
    """One field per experiment with the site's coordinates and the first plot's field columns."""
    base = sites.select(
        *by,
        F.lit(1).alias("FL_ID"),
        F.col("site").alias("FL_NAME"),
        F.col("lat").alias("FL_LAT"),
        F.col("lon").alias("FL_LON"),
        F.col("country").alias("SITE_COUNTRY"),
    )
    cols = [c for c in plots.columns if c.lower().startswith(FIELD_STARTS)] if plots is not None else []
    if not cols:
        return base
    first = first_row(plots.select(*by, *key, *cols), by, key)
    return null_safe_join(base, first.select(*by, *[F.col(c).alias(c.upper()) for c in cols]), by)


def treatments(table: DataFrame | None, sites: DataFrame, by: list[str] = BY) -> DataFrame:
    """Distinct treatment and factor columns, numbered by their values; a default without them."""
    cols = [c for c in table.columns if c.lower().startswith(TREATMENT_STARTS)] if table is not None else []
    if not cols:
        return sites.select(*by, F.lit(1).alias("TRTNO"), F.lit("Default Treatment").alias("TREATMENT_NAME"))
    rows = sequence_ids(table.select(*by, *cols).distinct(), cols, "TRTNO", by, spread=False)
    named = rows.withColumn("TREATMENT_NAME", F.concat(F.lit("Treatment "), F.col("TRTNO").cast("string")))
    return named.select(*by, "TRTNO", "TREATMENT_NAME", *[F.col(c).alias(c.upper()) for c in cols])


def remarks(tables: dict[str, DataFrame], by: list[str] = BY) -> DataFrame | None:
    """All remarks of an experiment as one text."""
    parts = []
    for df in tables.values():
        col = next((c for c in REMARK_COLUMNS if c in df.columns), None)
        if col:
            parts.append(df.select(*by, F.col(col).cast("string").alias("remark")))
    return joined_text(union_padded(*parts), by, "remark", "REMARKS") if parts else None


def metadata(db: dict[str, DataFrame], sites: DataFrame, by: list[str] = BY) -> DataFrame:
    """Site constants, version and remarks."""
    # fixed values: contact placeholders and the text without remarks
    out = sites.select(
        *by,
        F.lit("Dataset Contributors").alias("PERSONS"),
        F.lit("contact@example.com").alias("EMAIL"),
        F.concat_ws(" ", "site", "country").alias("ADDRESS"),
        F.col("site").alias("SITE"),
        F.col("country").alias("COUNTRY"),
        F.col("lat").alias("LATITUDE"),
        F.col("lon").alias("LONGITUDE"),
        F.col("exp_details").alias("EXPERIMENT_DETAILS"),
        F.col("version").alias("VERSION"),
    )
    found = remarks({n: df for n, df in db.items() if "BEMERKUNGEN" in n.upper()}, by)
    none = F.lit("No additional remarks")
    if found is None:
        return out.withColumn("REMARKS", none)
    return null_safe_join(out, found, by).withColumn("REMARKS", F.coalesce("REMARKS", none))


def result_header(sites: DataFrame, by: list[str] = BY, country_code: str = "DE") -> DataFrame:
    """Title, site code, processing time and version of a bundle."""
    return sites.select(
        *by,
        F.col("exp_details").alias("EXP_DETAILS"),
        F.concat(F.upper(F.substring("site", 1, 2)), F.lit(country_code)).alias("SITE_CODE"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("PROCESSED_DATE"),
        F.col("version").alias("VERSION"),
    )


def key_table_roles(db: dict[str, DataFrame]):
    """Roles of all tables by name and content, laboratory tables linked to their samples."""
    columns = {n: list(df.columns) for n, df in db.items()}
    undecided = key_tables(columns, {})["other"]  # only tables that no name decides are looked at
    dated = {n: has_multiple_date_columns(db[n]) for n in undecided}
    return link_tables(key_tables(columns, dated), columns)


def with_samples(lab: DataFrame, sample: DataFrame, link: str, by: list[str] = BY) -> DataFrame:
    """Laboratory values with the year and plot of their sample."""
    facts = [c for c in ("Year", "Plot_id") if c in sample.columns and c not in lab.columns]
    return null_safe_join(lab, sample.select(*by, link, *facts).distinct(), [*by, link])


def complete_bundle(
    db: dict[str, DataFrame], sites: DataFrame, keys: dict[str, list[str]], by: list[str] = BY, check: bool = True
) -> dict[str, DataFrame]:
    """``METADATA, DESIGN, TREATMENTS, MANAGEMENT.x, OBSERVATIONS.x, BALANCES.x``.

    ``sites``: scope, site, country, lat, lon, exp_details, version. ``keys`` gives the key columns
    by which the first plot is chosen. Laboratory values get the year and plot of their sample. Other tables that no rule names
    are left out.
    """
    named = {n: standardize_names(df) for n, df in db.items()}
    if check:
        require_valid(named)
    names = list(named)
    plots = find_table(names, REQUIRED_TABLES["plots"])
    trt = find_table(names, REQUIRED_TABLES["treatments"])
    out = {
        "METADATA": metadata(named, sites, by),
        "DESIGN": fields(named.get(plots), sites, keys.get(plots, ["Plot_id"]), by),
        "TREATMENTS": treatments(named.get(trt), sites, by),
        "HEADER": result_header(sites, by),
    }
    balances: dict[str, list[DataFrame]] = {}
    _, links = key_table_roles(named)
    for n, df in named.items():
        if n in links:  # laboratory values stand beside the sample that they belong to
            sample, link = links[n]
            out[f"OBSERVATIONS.{n}"] = with_samples(df, named[sample], link, by)
            continue
        kind = class_of(n)
        if kind is None:
            continue
        cls, part = kind
        if cls == "balance":
            balances.setdefault(part, []).append(balance(df, part))
        elif cls == "management":
            out[f"MANAGEMENT.{n}"] = df
        elif part == "CLIMATE":
            out[f"OBSERVATIONS.{n}"] = climate(df)
        elif part == "CROP_ASSESSMENT":
            out[f"OBSERVATIONS.{n}"] = crop_assessment(df)
        else:
            out[f"OBSERVATIONS.{n}"] = df
    return out | {f"BALANCES.{k}": union_padded(*v) for k, v in balances.items()}


def table_heads(db: dict[str, DataFrame], n: int = 3) -> dict[str, DataFrame]:
    """The first rows of every table, for display."""
    return {name: df.limit(n) for name, df in db.items()}
