"""Table classes: by content (management or observed) and by name."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroloom.operators.scale import null_safe_join

MAX_EVENTS = 8  # distinct records per year up to which a table counts as management


def year_counts(df: DataFrame, year: str, by: list[str] = ()) -> DataFrame:
    """Rows per year."""
    return df.groupBy(*by, year).agg(F.count(F.lit(1)).alias("n_rows"))


def tag_years(
    df: DataFrame, year: str, plot: str, plots: int | DataFrame, key: list[str] = (), by: list[str] = (), max_events: float = MAX_EVENTS
) -> DataFrame:
    """One row per scope and year: distinct records, rows and tag.

    Few distinct records a year (mean over the years) mean management. Other tables hold
    a summary in years with at most one row per plot, a time series in the rest.
    ``plots`` is the number of plots, or a DataFrame (scope, n_plots).
    """
    by = list(by)
    rest = [c for c in df.columns if c not in {*by, year, plot, *key}]
    record = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    # identical records are combined first; the rows are counted on the way
    records = df.groupBy(*by, year, record.alias("__rec")).agg(F.count(F.lit(1)).alias("__n"))
    yearly = records.groupBy(*by, year).agg(F.count(F.lit(1)).alias("n_records"), F.sum("__n").alias("n_rows"))
    if by:
        mean = yearly.groupBy(*by).agg(F.avg("n_records").alias("__mean"))
        yearly = null_safe_join(yearly, mean, by)
    else:
        yearly = yearly.withColumn("__mean", yearly.agg(F.avg("n_records")).scalar())
    if isinstance(plots, DataFrame):
        yearly = null_safe_join(yearly, plots.select(*by, "n_plots"), by)
    else:
        yearly = yearly.withColumn("n_plots", F.lit(plots))
    tag = (
        F.when(F.col("__mean") <= max_events, "management")
        .when(F.col("n_rows") <= F.col("n_plots"), "observed_summary")
        .otherwise("observed_timeseries")
    )
    return yearly.select(*by, year, "n_records", "n_rows", tag.alias("tag"))


def tag_tables(
    db: dict[str, DataFrame], year: str, plot: str, plots, keys: dict[str, list[str]], by: list[str] = (), max_events: float = MAX_EVENTS
) -> dict[str, dict[str, DataFrame]]:
    """tag -> table -> rows. Tables without year or plot are ``other``; a table may appear under
    several tags, as the tag can change from year to year."""
    out: dict[str, dict[str, DataFrame]] = {}
    linked = {n: df for n, df in sorted(db.items()) if year in df.columns and plot in df.columns}
    tagged_years = {n: tag_years(df, year, plot, plots, keys.get(n, []), by, max_events) for n, df in linked.items()}
    with ThreadPoolExecutor(max_workers=8) as pool:
        # three names at most per table
        found = dict(zip(linked, pool.map(lambda d: d.select("tag").distinct().collect(), tagged_years.values())))
    for name, df in sorted(db.items()):
        if name not in linked:
            out.setdefault("other", {})[name] = df
            continue
        tags = tagged_years[name]
        seen = sorted(r["tag"] for r in found[name])
        if len(seen) == 1:
            out.setdefault(seen[0], {})[name] = df
            continue
        tagged = null_safe_join(df, tags.select(*by, year, "tag"), [*by, year])
        for t in seen:
            out.setdefault(t, {})[name] = tagged.filter(F.col("tag") == t).drop("tag")
    return out


def treatment_years(
    df: DataFrame, year: str, plot: str | None, key: list[str] = (), by: list[str] = ()
) -> DataFrame:
    """(scope, year, is_trt): do the plots of a year differ in their sequence of events?

    Events of a plot are ordered by date and record, and the date is part of the record, so
    two plots have the same sequence exactly when they hold the same records equally often.
    A year is uniform when every record occurs in all plots of the table, the same number of
    times in each. That needs grouped counts only: no sort, no pivot, no pairs of plots.
    """
    by = list(by)
    if plot is None:
        df, plot = df.withColumn("__plot", F.lit(1)), "__plot"
    rest = [c for c in df.columns if c not in {*by, year, plot, *key}]
    record = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    # one pass over the rows; everything after works on the distinct (plot, record) counts
    held = df.groupBy(*by, year, plot, record.alias("__rec")).agg(F.count(F.lit(1)).alias("__n"))
    spread = held.groupBy(*by, year, "__rec").agg(
        F.count(F.lit(1)).alias("__plots"), F.min("__n").alias("__lo"), F.max("__n").alias("__hi")
    )
    plots = df.select(*by, plot).distinct()
    if by:
        joined = null_safe_join(spread, plots.groupBy(*by).agg(F.count(F.lit(1)).alias("__all")), by)
    else:
        joined = spread.withColumn("__all", plots.agg(F.count(F.lit(1))).scalar())
    differs = (F.col("__plots") < F.col("__all")) | (F.col("__lo") < F.col("__hi"))
    return joined.groupBy(*by, year).agg(F.bool_or(differs).alias("is_trt"))


def table_years(
    db: dict[str, DataFrame], year: str, plot: str, plots: DataFrame, keys: dict[str, list[str]], by: list[str], max_events: float = MAX_EVENTS, own_plots: DataFrame | None = None
) -> DataFrame:
    """One row per table, scope and year: n_records, n_rows, tag (:func:`tag_years`) and is_trt (:func:`treatment_years`).

    The rows of all tables go through one grouped pass: records are told apart by a digest, equal ones are combined before the
    shuffle. ``year`` comes as text, as its type may differ from table to table. ``plots``: (scope, n_plots); ``own_plots``: (table,
    scope, n_own), the plots that each table has, counted here if it is not given.
    """
    by = list(by)
    parts = []
    for n, df in sorted(db.items()):
        rest = [c for c in df.columns if c not in {*by, year, plot, *keys.get(n, [])}]
        record = F.sha2(F.to_json(F.struct(*rest)), 256) if rest else F.lit("")
        parts.append(
            df.select(F.lit(n).alias("table"), *by, F.col(year).cast("string").alias(year), F.col(plot).cast("string").alias("__plot"), record.alias("__rec"))
        )
    group = ["table", *by]
    held = reduce(DataFrame.unionByName, parts).groupBy(*group, year, "__plot", "__rec").agg(F.count(F.lit(1)).alias("__n"))
    spread = held.groupBy(*group, year, "__rec").agg(
        F.count(F.lit(1)).alias("__plots"), F.min("__n").alias("__lo"), F.max("__n").alias("__hi"), F.sum("__n").alias("__n")
    )
    yearly = spread.groupBy(*group, year).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum("__n").alias("n_rows"), F.min("__plots").alias("__least"), F.bool_or(F.col("__lo") < F.col("__hi")).alias("__uneven")
    )
    if own_plots is None:
        own_plots = held.select(*group, "__plot").distinct().groupBy(*group).agg(F.count(F.lit(1)).alias("n_own"))
    # a window holds the years of one table and scope
    out = yearly.withColumn("__mean", F.avg("n_records").over(Window.partitionBy(*group)))
    out = null_safe_join(out, own_plots.select(*group, "n_own"), group)
    out = null_safe_join(out, plots.select(*by, "n_plots"), by)
    tag = (
        F.when(F.col("__mean") <= max_events, "management")
        .when(F.col("n_rows") <= F.col("n_plots"), "observed_summary")
        .otherwise("observed_timeseries")
    )
    is_trt = F.col("__uneven") | (F.col("__least") < F.col("n_own"))
    return out.select(*group, year, "n_records", "n_rows", tag.alias("tag"), is_trt.alias("is_trt"))


def split_by_tag(db: dict[str, DataFrame], years: DataFrame, year: str, by: list[str]) -> dict[str, dict[str, DataFrame]]:
    """tag -> table -> rows, from the result of :func:`table_years` (kept, as it is read for every table). The tags
    in use, three at most per table, come to the driver."""
    out: dict[str, dict[str, DataFrame]] = {}
    seen: dict[str, list[str]] = {}
    for r in years.select("table", "tag").distinct().collect():
        seen.setdefault(r["table"], []).append(r["tag"])
    for name, tags in sorted(seen.items()):
        if len(tags) == 1:
            out.setdefault(tags[0], {})[name] = db[name]
            continue
        mine = years.where(F.col("table") == name).select(*by, F.col(year).alias("__year"), "tag")
        tagged = null_safe_join(db[name].withColumn("__year", F.col(year).cast("string")), mine, [*by, "__year"]).drop("__year")
        for t in sorted(tags):
            out.setdefault(t, {})[name] = tagged.filter(F.col("tag") == t).drop("tag")
    return out


# First match wins; class, sub-class, pattern.
NAME_RULES = [
    ("balance", "NITROGEN", "STICKSTOFFBILANZ|N_BILANZ|NBILANZ"),
    ("balance", "ENERGY", "ENERGIEBILANZ|E_BILANZ|EBILANZ"),
    ("management", "", "ERNTE|DUENGUNG|BODENBEARBEITUNG|AUSSAAT|FRUCHTFOLGE"),
    ("observation", "CLIMATE", "KLIMADATEN"),
    ("observation", "CROP_ASSESSMENT", "BONITUR"),
    ("observation", "", "PFLANZENSCHUTZ|BODENBIOLOGIE|PROBENAHME|LABORWERTE"),
]

# Name patterns of the table roles.
ROLE_PATTERNS = {
    "design": "VERSUCHSAUFBAU|design",
    "fertilization": "DUENGUNG|fertilization",
    "tillage": "BODENBEARBEITUNG|tillage",
    "sowing": "AUSSAAT|sowing",
    "harvest": "ERNTE|harvest",
    "plant_sampling": "PFLANZE|plant",
    "soil_sampling": "BODEN|soil",
    "yield": "ERTRAG|yield",
}
MANAGEMENT_ROLES = ("fertilization", "tillage", "sowing", "harvest")
OBSERVED_ROLES = ("plant_sampling", "soil_sampling", "yield")
DESIGN_COLUMNS = ("Year", "Plot_id", "Treatment_id")


def classify_names(names: DataFrame, column: str, rules=NAME_RULES) -> DataFrame:
    """Class and sub-class of every table name in a DataFrame; null when no rule fits."""
    kind, sub = F.lit(None).cast("string"), F.lit(None).cast("string")
    for cls, part, pattern in reversed(rules):
        hit = F.upper(F.col(column)).rlike(pattern)
        kind = F.when(hit, cls).otherwise(kind)
        sub = F.when(hit, part).otherwise(sub)
    return names.withColumns({"table_class": kind, "table_part": sub})


def class_of(name: str, rules=NAME_RULES) -> tuple[str, str] | None:
    return next(((c, p) for c, p, pat in rules if re.search(pat, name, re.I)), None)


def _role(name: str, roles: tuple[str, ...]) -> bool:
    return any(re.search(ROLE_PATTERNS[r], name, re.I) for r in roles)


def key_tables(columns: dict[str, list[str]], dated: dict[str, bool]) -> dict[str, list[str]]:
    """Role of every table: design by name, else by its columns; others by name, then dates.

    ``dated`` tells which tables have more than one date column.
    """
    names = list(columns)
    design = next((n for n in names if _role(n, ("design",))), None)
    if design is None:
        design = next((n for n in names if set(DESIGN_COLUMNS) <= set(columns[n])), None)
    out = {"design": [design] if design else [], "management": [], "observed_summary": [], "observed_timeseries": [], "other": []}
    for n in names:
        if n == design:
            continue
        if _role(n, MANAGEMENT_ROLES):
            out["management"].append(n)
        elif _role(n, OBSERVED_ROLES):
            out["observed_summary"].append(n)
        elif dated.get(n):
            out["observed_timeseries"].append(n)
        else:
            out["other"].append(n)
    return out


# Columns that link laboratory values to their samples.
LINK_COLUMNS = ("Proben_ID", "Probe_ID", "Sample_ID")


def link_tables(roles: dict[str, list[str]], columns: dict[str, list[str]], links=LINK_COLUMNS):
    """Move tables that share a link column with a sample table from other to observed summary.

    Returns the new roles and {table: (sample table, link column)}.
    """
    found: dict[str, tuple[str, str]] = {}
    for sample in roles["observed_summary"]:
        link = next((c for c in links if c in columns[sample]), None)
        if link is None:
            continue
        for other in roles["other"]:
            if other not in found and link in columns[other]:
                found[other] = (sample, link)
    moved = dict(roles)
    moved["other"] = [n for n in roles["other"] if n not in found]
    moved["observed_summary"] = roles["observed_summary"] + list(found)
    return moved, found
