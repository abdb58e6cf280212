"""Column roles found from the values: keys, dates, numbers, years, plots, treatments.

Results that name columns come to the driver (one row per column); row data does not.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.functions import dates
from agroloom.operators.scale import null_safe_join

# a sketch this far below the row count rules a key out (error of the sketch is 2 %)
SKETCH_ERROR = 0.02
KEY_SHARE = 0.9

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = INTEGERS + (T.FloatType, T.DoubleType, T.DecimalType)


def _distinct(by: list[str], c: str) -> Column:
    """Aggregate: distinct values of a column (per scope, summed over the scopes); null is one value."""
    if by:
        return F.count_distinct(F.struct(*[F.col(b) for b in by], F.col(c).alias("v")))
    return F.count_distinct(F.col(c)) + F.coalesce(F.max(F.when(F.col(c).isNull(), 1)), F.lit(0))


def is_unique_id(df: DataFrame, column: str, by: list[str] = (), kind: str = "all") -> bool:
    """Every row has its own value (null counts once); ``kind="int"`` also asks for an integer type."""
    if kind == "int" and not isinstance(df.schema[column].dataType, INTEGERS):
        return False
    row = df.agg(F.count(F.lit(1)).alias("n"), _distinct(list(by), column).alias("d")).first()
    return row["n"] == row["d"]


def key_candidates(df: DataFrame, by: list[str] = ()) -> list[str]:
    """Columns a distinct-count sketch cannot rule out, from one pass over all columns.

    The sketch errs by 2 % (one standard deviation) and a column is ruled out more than five of them below the row count, so a
    true key is missed about once in a million columns; whatever is left is counted exactly.
    """
    by = list(by)
    cols = [c for c in df.columns if c not in by and not isinstance(df.schema[c].dataType, T.MapType)]
    if not cols:
        return []
    row = df.agg(
        F.count(F.lit(1)).alias("__n"),
        # the hash of a null is a value too
        *[F.approx_count_distinct(F.xxhash64(*by, c), SKETCH_ERROR).alias(c) for c in cols],
    ).first()
    return [c for c in cols if row[c] >= KEY_SHARE * row["__n"]]


def key_columns(df: DataFrame, by: list[str] = (), alternates: bool = False) -> list[str]:
    """Primary key (first unique column in schema order), or all unique columns.

    With a scope the column must be unique inside every scope, which is the same
    as (scope, column) being unique.
    """
    candidates = key_candidates(df, by)
    if not candidates:
        return []
    # one exact pass over all candidates
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[_distinct(list(by), c).alias(f"d{i}") for i, c in enumerate(candidates)]).first()
    unique = [c for i, c in enumerate(candidates) if row[f"d{i}"] == row["__n"]]
    return unique if alternates else unique[:1]


def key_profile(df: DataFrame, table: str, by: list[str] = ()) -> DataFrame:
    """One row per column: position, rows, nulls, whether unique, whether the primary key."""
    by = list(by)
    cols = [c for c in df.columns if c not in by]
    candidates = set(key_candidates(df, by))
    stats = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(F.col(c).isNull()).alias(f"z{i}") for i, c in enumerate(cols)],
        *[_distinct(by, c).alias(f"d{i}") for i, c in enumerate(cols) if c in candidates],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(c).alias("column_name"),
                F.col(f"z{i}").alias("n_null"),
                (F.col(f"d{i}") == F.col("__n") if c in candidates else F.lit(False)).alias("is_key"),
            )
            for i, c in enumerate(cols)
        ]
    )
    first = F.array_min(F.transform(F.filter("r", lambda x: x["is_key"]), lambda x: x["position"]))
    return (
        stats.select("__n", rows.alias("r"))
        .select("__n", first.alias("pk"), F.explode("r").alias("c"))
        .select(
            F.lit(table).alias("table_name"),
            "c.position",
            "c.column_name",
            F.col("__n").alias("n_rows"),
            "c.n_null",
            "c.is_key",
            F.coalesce(F.col("c.position") == F.col("pk"), F.lit(False)).alias("is_primary"),
        )
    )


def catalog(db: dict[str, DataFrame], by: list[str] = ()) -> dict[str, dict]:
    """Columns and primary key of every table, profiled once and passed around.

    The tables are independent, so their small profile jobs run side by side.
    """
    with ThreadPoolExecutor(max_workers=8) as pool:
        keys = dict(zip(db, pool.map(lambda df: key_columns(df, by), db.values())))
    return {n: {"columns": list(df.columns), "key": keys[n]} for n, df in db.items()}


def parent_edges(cat: dict[str, dict]) -> list[tuple[str, str, str]]:
    """(child, parent, key) where the parent's primary key is a column of the child."""
    return sorted(
        (child, parent, k)
        for child, c in cat.items()
        for parent, p in cat.items()
        if child != parent
        for k in p["key"]
        if k in c["columns"]
    )


def orphans(child: DataFrame, parent: DataFrame, key: str, by: list[str] = ()) -> DataFrame:
    """Child keys missing in the parent: an inclusion check on an edge."""
    cols = [*by, key]
    return null_safe_join(child.select(*cols).distinct(), parent.select(*cols), cols, "left_anti")


def table_with_key(cat: dict[str, dict], key: str) -> str:
    """The table whose primary key is ``key``; several or none is an error."""
    found = [n for n, c in cat.items() if c["key"] == [key]]
    if len(found) != 1:
        raise LookupError(f"{len(found)} tables have the primary key {key!r}: {sorted(found)}")
    return found[0]


def has_link(a: list[str], b: list[str], subset: list[str] | None = None) -> bool:
    """Two tables share a column (of the subset)."""
    return bool(set(a) & set(b) & set(subset if subset is not None else a))


def _date_tests(df: DataFrame, columns: list[str] | None, doy: list[str]) -> tuple[list[str], dict[str, list[str]]]:
    """Columns that are dates by type, and the layouts that each other column may have."""
    typed, tests = [], {}
    for f in df.schema:
        if columns is not None and f.name not in columns:
            continue
        if f.name in doy:
            tests[f.name] = ["yyDDD"]
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            typed.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            tests[f.name] = list(dates.DATE_LAYOUTS)
        elif isinstance(f.dataType, INTEGERS):
            tests[f.name] = ["yyyyMMdd"]
    return typed, tests


def date_layouts(df: DataFrame, columns: list[str] | None = None, doy: list[str] = (), by: list[str] = ()) -> dict[str, list[str]]:
    """Layouts of every column whose values all parse as dates: in each scope one layout fits all values.

    Scopes may differ; the layouts in use are listed in the order in which they are tried. Five-digit codes are
    read as day-of-year only for columns declared in ``doy``: plot numbers look the same.
    """
    typed, tests = _date_tests(df, columns, doy)
    found = {c: ["date"] for c in typed}
    if tests:
        layouts = scope_layouts(df, tests, by)
        row = layouts.agg(
            *[F.collect_set(f"layout_{i}").alias(f"all_{i}") for i in range(len(tests))],
            *[F.bool_or(F.col(f"n_{i}") & F.col(f"layout_{i}").isNull()).alias(f"bad_{i}") for i in range(len(tests))],
        ).first()
        for i, (c, lays) in enumerate(tests.items()):
            if row[f"all_{i}"] and not row[f"bad_{i}"]:
                found[c] = [x for x in lays if x in row[f"all_{i}"]]
    return {c: found[c] for c in df.columns if c in found}


def scope_layouts(df: DataFrame, tests: dict[str, list[str]], by: list[str] = ()) -> DataFrame:
    """One row per scope: for column number i whether it has values (``n_i``) and its first layout that fits all (``layout_i``)."""
    by = list(by)
    aggs = []
    for i, (c, lays) in enumerate(tests.items()):
        aggs.append(F.count(c).alias(f"c_{i}"))
        aggs += [dates.misfits(F.col(c), lay).alias(f"m_{i}_{j}") for j, lay in enumerate(lays)]
    counts = df.groupBy(*by).agg(*aggs)
    out = []
    for i, lays in enumerate(tests.values()):
        fits = [F.when(F.col(f"m_{i}_{j}") == 0, lay) for j, lay in enumerate(lays)]
        some = F.col(f"c_{i}") > 0
        out += [some.alias(f"n_{i}"), F.when(some, F.coalesce(*fits)).alias(f"layout_{i}")]
    return counts.select(*by, *out)


def dates_parsed(df: DataFrame, layouts: dict[str, list[str]], by: list[str] = ()) -> DataFrame:
    """Columns with known layouts as dates; with several, a value is read by the layout of its scope."""
    mixed = {c: lays for c, lays in layouts.items() if len(lays) > 1}
    out = df.withColumns(
        {c: F.col(c).cast("date") if lays[0] == "date" else dates.parse_date(F.col(c), lays[0]) for c, lays in layouts.items() if c not in mixed}
    )
    if not mixed:
        return out
    chosen = scope_layouts(df, mixed, by).select(*by, *[f"layout_{i}" for i in range(len(mixed))])
    out = null_safe_join(out, chosen, list(by))
    for i, (c, lays) in enumerate(mixed.items()):
        own = [F.when(F.col(f"layout_{i}") == lay, dates.parse_date(F.col(c), lay)) for lay in lays]
        out = out.withColumn(c, F.coalesce(*own))
    return out.select(*df.columns)


def date_columns_by_share(df: DataFrame) -> list[str]:
    """Text columns in which more than 70 % of the non-empty values look like dates, and date columns."""
    typed = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not text:
        return typed
    row = df.agg(*[dates.date_share(F.col(c)).alias(c) for c in text]).first()
    hits = {c for c in text if row[c] is not None and row[c] > dates.DATE_SHARE} | set(typed)
    return [c for c in df.columns if c in hits]


def has_multiple_date_columns(df: DataFrame) -> bool:
    return len(date_columns_by_share(df)) > 1


def promote_numbers(df: DataFrame, pattern: str = r"^[0-9.]+$", comma: bool = False) -> DataFrame:
    """Text columns whose values all look numeric become doubles; one aggregate."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not text:
        return df

    def number(c: str) -> Column:
        raw = F.regexp_replace(F.col(c), ",", ".") if comma else F.col(c)
        return raw.try_cast("double")

    row = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in text],
        *[F.count_if(F.col(c).rlike(pattern) & number(c).isNotNull()).alias(f"k_{c}") for c in text],
    ).first()
    hits = [c for c in text if 0 < row[f"n_{c}"] == row[f"k_{c}"]]
    return df.withColumns({c: number(c) for c in hits}) if hits else df


def drop_null_columns(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Drop columns without any value."""
    row = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if c in keep or row[c] > 0])


def years_columns(df: DataFrame, start: Column | int, end: Column | int, by: list[str] = ()) -> DataFrame:
    """Numeric or date columns with their range and whether all values lie in [start, end].

    ``start`` and ``end`` may be columns of ``df`` (joined from the experiment metadata).
    """
    cols = [f for f in df.schema if f.name not in by and isinstance(f.dataType, NUMBERS + (T.DateType,))]
    as_year = {f.name: F.year(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name) for f in cols}
    lo = start if isinstance(start, Column) else F.lit(start)
    hi = end if isinstance(end, Column) else F.lit(end)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"lo_{c}").alias("min_value"),
                F.col(f"hi_{c}").alias("max_value"),
                F.col(f"ok_{c}").alias("in_range"),
            )
            for c in as_year
        ]
    )
    aggs = []
    for c, y in as_year.items():
        aggs += [
            F.min(y).cast("double").alias(f"lo_{c}"),
            F.max(y).cast("double").alias(f"hi_{c}"),
            F.bool_and(F.coalesce(y.between(lo, hi), F.lit(False))).alias(f"ok_{c}"),
        ]
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def distinct_profile(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Exact number of distinct values (null is one) per scope and column.

    Values are made unique per (scope, column, value) first, so a hot value costs one row
    per input partition.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    long = df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.column_name", "p.v").distinct()
    return long.groupBy(*by, "column_name").agg(F.count(F.lit(1)).alias("n_distinct"))


def columns_with_count(df: DataFrame, n: int, by: list[str] = ()) -> list[str]:
    """Columns whose number of distinct values is ``n`` in every scope (plots, replicates)."""
    by = list(by)
    prof = distinct_profile(df, by, [c for c in df.columns if c not in by])
    rows = prof.groupBy("column_name").agg(F.bool_and(F.col("n_distinct") == n).alias("hit")).filter("hit").collect()
    hits = {r["column_name"] for r in rows}
    return [c for c in df.columns if c in hits]


def treatment_columns(
    design: DataFrame, year: str, plot: str, by: list[str] = (), key: list[str] = ()
) -> DataFrame:
    """Replicates per candidate column: rows per value and year, without the plot column.

    A treatment has the same number of rows for each value, and fewer replicates than plots.
    """
    by = list(by)
    cols = [c for c in design.columns if c not in {*by, *key, year, plot}]
    sizes = distinct_profile(design, by, [year, plot])

    def size_of(c: str) -> Column:
        return F.max(F.when(F.col("column_name") == c, F.col("n_distinct")))

    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols])
    counts = (
        design.drop(plot)
        .distinct()
        .select(*by, F.explode(pairs).alias("p"))
        .groupBy(*by, "p.column_name", "p.v")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*by, "column_name")
        .agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"))
    )
    if by:
        size = sizes.groupBy(*by).agg(size_of(year).alias("n_years"), size_of(plot).alias("n_plots"))
        joined = null_safe_join(counts, size, by)
    else:
        joined = counts.withColumns(
            {"n_years": sizes.agg(size_of(year)).scalar(), "n_plots": sizes.agg(size_of(plot)).scalar()}
        )
    reps = F.col("n_min") / F.col("n_years")
    return joined.select(
        *by,
        "column_name",
        reps.alias("reps"),
        ((F.col("n_min") == F.col("n_max")) & (reps < F.col("n_plots"))).alias("is_treatment"),
    )
