"""Sectioned fixed-width text: simulation reports, soil profiles, weather files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MISSING = "-99"


def read_sections(spark: SparkSession, path: str, mark: str = "*RUN") -> DataFrame:
    """One row per section (``file_name``, ``title``, ``body``).

    The mark is the record separator of the scan, so a file is split on its sections and never
    held whole. Text before the first mark is dropped.
    """
    rows = spark.read.option("lineSep", mark).text(path).select(F.col("_metadata.file_name").alias("file_name"), "value")
    # a section's title follows the mark on the same line; the preamble starts at column one
    return rows.select(
        "file_name",
        F.trim(F.substring_index("value", "\n", 1)).alias("title"),
        F.col("value").alias("body"),
    )


# Columns of a profile's site line, the one line with left-aligned text.
SITE_LAYOUT = [("SITE", 2, 11), ("COUNTRY", 14, 11), ("LAT", 25, 9), ("LONG", 34, 9), ("SCS_FAMILY", 44, 50)]


def _layout(header: Column) -> Column:
    """Name, start and length of every column of a head line, which ends where its name ends.

    One fold over the words of the line; it runs once per block, not per data line. A repeated
    name gets its position appended.
    """
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<name:string,start:int,len:int>>").alias("cols"))

    def add(acc: Column, word: Column) -> Column:
        plain = F.regexp_replace(F.trim(word), r"^\.+|\.+$", "")
        seen = F.exists(acc["cols"], lambda c: c["name"] == plain)
        name = F.when(seen, F.concat_ws("_", plain, F.size(acc["cols"]) + 1)).otherwise(plain)
        col = F.struct(name.alias("name"), acc["at"].alias("start"), F.length(word).alias("len"))
        return F.struct((acc["at"] + F.length(word)).alias("at"), F.concat(acc["cols"], F.array(col)).alias("cols"))

    words = F.regexp_extract_all(header, F.lit(r"(\s*\S+)"), F.lit(1))
    folded = F.aggregate(words, start, add, lambda acc: acc["cols"])
    site = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(a).alias("start"), F.lit(k).alias("len")) for n, a, k in SITE_LAYOUT]
    )
    return F.when(header.rlike(r"^\s*SITE\s+COUNTRY\s"), site).otherwise(folded)


def section_rows(sections: DataFrame) -> DataFrame:
    """Data lines of every ``@`` block: block number, line number and a map of fields.

    Comment lines (``!``) and empty lines are skipped, ``-99`` and blanks are null.
    """
    keep = [c for c in sections.columns if c != "body"]
    blocks = sections.select(*keep, F.posexplode(F.split("body", r"(?m)^@")).alias("block_no", "block")).filter(
        "block_no > 0"
    )
    # the mark took the first place of the head line
    head = F.concat(F.lit(" "), F.regexp_replace(F.substring_index("block", "\n", 1), r"\r$", ""))
    lines = (
        blocks.withColumn("layout", _layout(head))
        .select(*keep, "block_no", "layout", F.posexplode(F.split("block", "\r?\n")).alias("line_no", "line"))
        .filter((F.col("line_no") > 0) & (F.trim("line") != "") & ~F.col("line").rlike(r"^\s*[!*$]"))
    )

    def text(c: Column) -> Column:
        v = F.trim(F.substring(F.col("line"), c["start"], c["len"]))
        return F.when((v != "") & (v != MISSING), v)

    names, values = F.transform("layout", lambda c: c["name"]), F.transform("layout", text)
    return lines.select(*keep, "block_no", "line_no", F.map_from_arrays(names, values).alias("fields"))


def fields_as(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Chosen fields as typed columns; an absent field is null."""
    rest = [c for c in rows.columns if c != "fields"]
    return rows.select(
        *rest, *[F.try_element_at("fields", F.lit(c)).try_cast(t).alias(c) for c, t in types.items()]
    )


def read_runs(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Daily rows of a simulation report with run number, date and the chosen variables."""
    sections = read_sections(spark, path, "*RUN").withColumn(
        "run", F.regexp_extract("title", r"^(\d+)", 1).try_cast("int")
    ).filter("run IS NOT NULL")
    rows = fields_as(section_rows(sections), {"YEAR": "int", "DOY": "int", **types})
    return rows.withColumn("date", F.date_add(F.make_date("YEAR", F.lit(1), F.lit(1)), F.col("DOY") - 1)).select(
        "file_name", "run", "date", *types
    )


def read_profiles(spark: SparkSession, path: str, profile: str | None = None) -> DataFrame:
    """Rows of soil profiles; the filter on the profile id runs before any line is cut."""
    sections = read_sections(spark, path, "\n*").withColumn("profile_id", F.regexp_extract("title", r"^\*?(\S+)", 1))
    if profile is not None:
        sections = sections.filter(F.col("profile_id") == profile)
    return section_rows(sections)
