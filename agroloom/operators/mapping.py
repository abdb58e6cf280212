"""Dictionary mapping of headers, codes and units.

A mapping is a list of rows (dicts) with ``table_name, column_header, column_unit, std_header,
std_unit, code_mappings``; :func:`read_mapping` brings a mapping DataFrame to the driver, as header names are part of the
schema. Code lookups stay distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.functions.units import NO_CONVERSION, conversion, convert_unit
from agroloom.operators.scale import null_safe_join


def read_mapping(table: DataFrame) -> list[dict]:
    return [r.asDict() for r in table.collect()]


def code_lookup(table: DataFrame, text: str = "code_mappings") -> DataFrame:
    """Mapping texts as rows (source, target): ``list('a: X', 'c(b, d): Y')``.

    ``c(b, d): Y`` gives two rows, target ``1`` keeps the source, and the text ``1`` gives none.
    The text is taken apart with patterns, never evaluated.
    """
    rest = [c for c in table.columns if c != text]
    entry = F.explode(F.regexp_extract_all(F.col(text), F.lit("'([^']*)'"), F.lit(1))).alias("entry")
    pair = F.split("entry", ": ")
    source, target = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
    several = F.regexp_extract(source, r"^\s*c\((.*)\)\s*$", 1)
    sources = F.when(several != "", F.split(several, r"\s*,\s*")).otherwise(F.array(source))
    return (
        table.select(*rest, entry)
        .select(*rest, F.explode(sources).alias("source"), target.alias("target"))
        .withColumn("target", F.when(F.col("target") == "1", F.col("source")).otherwise(F.col("target")))
    )


def map_codes(df: DataFrame, lookup: DataFrame, columns: list[str], header: str = "std_header") -> DataFrame:
    """Recode ``columns`` by a lookup (header, source, target); unmatched values become null.

    A column without any lookup row stays. Coded columns come out as text; of several targets of a source the smallest counts.
    """
    out = df
    for c in columns:
        part = lookup.filter(F.col(header) == c).groupBy(F.col("source").alias("__src")).agg(F.min("target").alias("__tgt"))
        some = part.agg(F.count(F.lit(1)).alias("n")).scalar() > 0
        keyed = null_safe_join(out.withColumn("__src", F.col(c).cast("string")), part, ["__src"])
        out = keyed.withColumn(c, F.when(some, F.col("__tgt")).otherwise(F.col("__src"))).select(*df.columns)
    return out


def header_renames(columns: list[str], mapping: list[dict], table: str) -> dict[str, str]:
    """Source header -> standard header, decided on the source names in one pass."""
    out: dict[str, str] = {}
    for m in mapping:
        src, std = m["column_header"], m["std_header"]
        if m["table_name"] == table and src in columns and std and src not in out and std not in out.values():
            out[src] = std
    return out


def unit_errors(mapping: list[dict]) -> list[dict]:
    """The mapping rows whose units have no conversion."""
    wrong = []
    for m in mapping:
        unit = m.get("std_unit") or ""
        if m["std_header"] and unit != "code" and unit not in NO_CONVERSION:
            try:
                conversion(m["column_unit"], unit)
            except (KeyError, ValueError):
                wrong.append(m)
    return wrong


def map_data(
    df: DataFrame,
    table: str,
    mapping: list[dict],
    lookup: DataFrame | None = None,
    keep_unmapped: bool = True,
    exempt: list[str] = (),
    distinct: bool = True,
) -> DataFrame:
    """Headers, then codes, then units of one section, as one projection over the rows.

    ``keep_unmapped=False`` keeps the mapped and the exempt columns only. Unit pairs without a conversion are an error that
    names all of them, before any row is read; see :func:`unit_errors`.
    """
    rows = [m for m in mapping if m["table_name"] == table]
    wrong = unit_errors([m for m in rows if m["column_header"] in df.columns])
    if wrong:
        raise ValueError("; ".join(f"{e['column_header']}: no conversion from {e['column_unit']!r} to {e['std_unit']!r}" for e in wrong))
    renames = header_renames(df.columns, rows, table)
    by_source = {m["column_header"]: m for m in reversed(rows)}
    out: list[Column] = []
    codes: list[str] = []
    for c in df.columns:
        if c not in renames:
            if keep_unmapped or c in exempt:
                out.append(F.col(c))
            continue
        m = by_source[c]
        unit = m.get("std_unit") or ""
        value = F.col(c)
        if unit == "code":
            codes.append(renames[c])
        elif unit not in NO_CONVERSION:
            value = convert_unit(value, m["column_unit"], unit)
        out.append(value.alias(renames[c]))
    mapped = df.select(*out)
    if lookup is not None and codes:
        mapped = map_codes(mapped, lookup.filter(F.col("table_name") == table), codes)
    return mapped.distinct() if distinct else mapped
