"""CSV folders of many experiments, delimited keys, and the station archive."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.operators.columns import standardize_names, within_years
from agroloom.operators.merge import union_in_order

# experiment before the first dot, table after the version number (and a year, if any)
EXPERIMENT_PATTERN = r"^([^.]+)\."
TABLE_PATTERN = r"[._]V\d+_\d+_(?:\d{4}_)?([^.]+)\."


def table_name(file_name: Column) -> Column:
    """Logical table of a file: the text after the version number, without extension."""
    return F.nullif(F.regexp_extract(file_name, TABLE_PATTERN, 1), F.lit(""))


def experiment_name(file_name: Column) -> Column:
    return F.regexp_extract(file_name, EXPERIMENT_PATTERN, 1)


def scan_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: name, first line, lines, and whether UTF-8 could not decode it.

    A single pass over the folder; the lines of a file are combined before the shuffle. The
    first line is the one with the smallest row id in the file's first block.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        F.monotonically_increasing_id().alias("row"),
    )
    return (
        lines.groupBy("path", "file_name")
        .agg(
            F.min_by("value", F.struct("block", "row")).alias("header"),
            F.count(F.lit(1)).alias("n_lines"),
            F.bool_or(~F.is_valid_utf8("value")).alias("not_utf8"),
        )
        .withColumns({"table_name": table_name(F.col("file_name")), "experiment_id": experiment_name(F.col("file_name"))})
    )


def separator(file_name: str, header: str) -> str:
    """Tab for ``.txt``; for other files a comma if the first line has one, else a semicolon."""
    if file_name.lower().endswith(".txt"):
        return "\t"
    return "," if "," in header else ";"


def typed(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Drop columns without values and give whole and decimal numbers their type; one aggregate."""
    cols = [f.name for f in df.schema if f.name not in keep and isinstance(f.dataType, T.StringType)]
    if not cols:
        return df
    row = df.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.count(F.col(c).try_cast("bigint")).alias(f"i{i}") for i, c in enumerate(cols)],
        # a whole number as text must look like one: 1.0 and 1e3 are decimals
        *[F.count_if(F.col(c).rlike(r"^\s*[-+]?\d+\s*$")).alias(f"w{i}") for i, c in enumerate(cols)],
        *[F.count(F.col(c).try_cast("double")).alias(f"d{i}") for i, c in enumerate(cols)],
    ).first()
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        i = cols.index(c)
        n = row[f"n{i}"]
        if n == 0:
            continue
        if row[f"i{i}"] == n and row[f"w{i}"] == n:
            out.append(F.col(c).try_cast("bigint").alias(c))
        elif row[f"d{i}"] == n:
            out.append(F.col(c).try_cast("double").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _readable(files: DataFrame, names: list[str] | None) -> tuple[dict[tuple, list[str]], list[tuple[str, str]]]:
    """Paths by (table, header, separator, encoding), and (path, reason) of the files that hold no table."""
    groups: dict[tuple, list[str]] = {}
    skipped: list[tuple[str, str]] = []
    for r in files.collect():
        name = r["table_name"]
        if name is None:
            skipped.append((r["path"], "no version and table in the name"))
        elif r["n_lines"] < 2:
            skipped.append((r["path"], "no data rows"))
        elif names is None or name in names:
            kind = (name, r["header"], separator(r["file_name"], r["header"]), bool(r["not_utf8"]))
            groups.setdefault(kind, []).append(r["path"])
    return groups, sorted(skipped)


def _scan(spark: SparkSession, paths: list[str], sep: str, latin: bool, missing: str = "NA") -> DataFrame:
    """All rows of like files as text, with the file's name and, for a row that does not fit the header, its text in ``__bad``."""

    def reader():
        return (
            spark.read.option("header", True)
            .option("sep", sep)
            .option("encoding", "ISO-8859-1" if latin else "UTF-8")
            .option("nullValue", missing)
            .option("multiLine", True)
            .option("escape", '"')
        )

    columns = reader().csv(paths[0]).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "__bad")])
    # all columns are parsed, else a row of the wrong length would go unnoticed
    rows = reader().schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad").option("columnPruning", False)
    return rows.csv(sorted(paths)).select("*", F.col("_metadata.file_name").alias("__file"))


def _misfits(rows: DataFrame) -> DataFrame:
    """file, reason, record of the rows of :func:`_scan` that don't fit their header."""
    # the reader gives the text of a misfit only along with a column of the file
    record = F.when(F.col(f"`{rows.columns[0]}`") == "\x00", "").otherwise(F.col("__bad"))
    found = rows.filter(F.col("__bad").isNotNull())
    return found.select(F.col("__file").alias("file"), F.lit("row does not fit the header").alias("reason"), record.alias("record"))


def load_tables(
    spark: SparkSession, path: str, names: list[str] | None = None, standard: bool = False, report: str | None = None
) -> dict[str, DataFrame]:
    """Every logical table of a folder, over all experiments, with ``experiment_id``.

    Files of a table that share a header, separator and encoding are one scan. The driver sees one
    row per file, as Spark's own file index does. Quoted line breaks belong to their cell; an unreadable file is an error.
    ``standard=True`` also gives the design columns their standard names. ``report`` names a further table (file, reason,
    record) of what the tables leave out: files without a table name or rows, and rows that don't fit their header.
    """
    groups, skipped = _readable(scan_headers(spark, path), names)
    parts: dict[str, list[DataFrame]] = {}
    bad = [spark.createDataFrame([(p, r, None) for p, r in skipped], "file string, reason string, record string")]
    for (name, _, sep, latin), paths in sorted(groups.items()):
        df = _scan(spark, sorted(paths), sep, latin)
        bad.append(_misfits(df))
        good = df.filter(F.col("__bad").isNull()).withColumn("experiment_id", experiment_name(F.col("__file"))).drop("__bad", "__file")
        parts.setdefault(name, []).append(good.withColumnsRenamed({c: re.sub("^(\ufeff|ï»¿|ï\\.\\.)", "", c) for c in good.columns}))
    out = {n: typed(union_in_order(*ps), keep=["experiment_id"]) for n, ps in parts.items()}
    out = {n: standardize_names(df) for n, df in out.items()} if standard else out
    return out | ({report: union_in_order(*bad)} if report else {})


def load_key(spark: SparkSession, path: str) -> DataFrame:
    """A variable key whose files may differ in separator and columns; like files are one scan. Rows that don't fit their
    header are left out; :func:`key_report` lists them."""
    return union_in_order(*[df.filter(F.col("__bad").isNull()).drop("__bad", "__file") for df in _key_parts(spark, path)])


def key_report(spark: SparkSession, path: str) -> DataFrame:
    """file, reason, record of the rows that :func:`load_key` leaves out."""
    return union_in_order(*[_misfits(df) for df in _key_parts(spark, path)])


def _key_parts(spark: SparkSession, path: str) -> list[DataFrame]:
    groups: dict[tuple, list[str]] = {}
    for r in scan_headers(spark, path).collect():
        groups.setdefault((separator(r["file_name"], r["header"]), r["header"], bool(r["not_utf8"])), []).append(r["path"])
    return [_scan(spark, sorted(ps), sep, latin, "") for (sep, _, latin), ps in sorted(groups.items())]


def read_archive(
    spark: SparkSession, path: str, columns: list[str], first: int, last: int, ts: str = "ts", stations: list | None = None
) -> DataFrame:
    """Station readings limited to columns, years and stations.

    With a layout partitioned by year only the matching folders are listed and read; the
    time range reaches the scan as a pushed filter.
    """
    df = spark.read.parquet(path)
    if "year" in df.columns:
        df = df.filter(F.col("year").between(first, last))
    if stations is not None:
        df = df.filter(F.col("station_id").isin(stations))
    return within_years(df, ts, first, last).select(*columns)
