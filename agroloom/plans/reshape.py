"""Undocumented experiment tables into standard sections, many experiments at once.

Column roles are found for every experiment alone and kept as a table; the rows of all of them then run
through one lazy plan per section.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroloom.functions.text import site_code
from agroloom.operators.columns import qualify
from agroloom.operators.ids import management_ids
from agroloom.operators.merge import chain_left, fold_attributes, merge_tables, on_design, union_padded
from agroloom.operators.roles import STANDARD, Names, Projection, link_name, names_in, solve_roles
from agroloom.operators.scale import dense_ids, null_safe_join
from agroloom.operators.tagging import MAX_EVENTS, split_by_tag, table_years
from agroloom.session import checkpointed, written

# Names beside those of the Java runtime's country list.
OTHER_NAMES = {
    "Czech Republic": "CZ", "USA": "US", "United States of America": "US", "UK": "GB", "Great Britain": "GB", "Turkey": "TR", "Russian Federation": "RU",
    "Korea": "KR", "Viet Nam": "VN", "Iran, Islamic Republic of": "IR", "The Netherlands": "NL",
}
_COUNTRIES: dict[str, str] = {}


def country_codes(spark: SparkSession) -> dict[str, str]:
    """English country name -> two-letter code, for all countries that the Java runtime lists."""
    if not _COUNTRIES:
        locale = spark.sparkContext._jvm.java.util.Locale
        for code in locale.getISOCountries():
            _COUNTRIES[locale("en", code).getDisplayCountry(locale.ENGLISH)] = code
        _COUNTRIES.update(OTHER_NAMES)
    return _COUNTRIES


@dataclass
class Roles:
    """Source columns of the design where they are known; what is None is searched for in every experiment."""

    year: str | None = None
    plot: str | None = None
    treatment: str | None = None
    rep: str | None = None


def standard_tables(db: dict[str, DataFrame], shape: Projection, names: Names, by: list[str]) -> tuple[dict[str, DataFrame], dict[str, dict]]:
    """Tables with standard design names, dates and qualified columns, and their catalog."""
    with ThreadPoolExecutor(max_workers=8) as pool:  # plans only, no jobs
        named = dict(zip(db, pool.map(shape.standardized, db.values(), db)))
    own = {n: link_name(n, names) for n in db}
    keys = {k for k in own.values() if k} | set(STANDARD.values())
    uses: dict[str, int] = {}
    for df in named.values():
        for c in df.columns:
            uses[c] = uses.get(c, 0) + 1
    join_keys = [c for c in keys if uses.get(c, 0) > 1] + ["Rep_no", *by]
    out = {n: qualify(df, n, join_keys) for n, df in named.items()}
    cat = {}
    for n, df in out.items():
        key = own[n] if own[n] in (None, *join_keys) else f"{n}__{own[n]}"
        cat[n] = {"columns": list(df.columns), "key": [key] if key in df.columns else []}
    return out, cat


def fields_section(
    tables: dict[str, DataFrame], roles: DataFrame, names: Names, metadata: DataFrame, by: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Fields (distinct plot attributes with ``FL_ID``) and the field of every plot.

    Columns that are unique in an experiment are no attributes there; columns that hold the experiment's
    coordinates on all plots are its ``FL_LON`` and ``FL_LAT``, which come from the metadata.
    """
    parts = []
    for t in names.plots_tables:
        mine = roles.where(F.col("plots_table") == t).select(*by, F.struct("unique", "lon", "lat").alias("__r"))
        rows = null_safe_join(tables[t], mine, by, "inner")
        source = {c: c.removeprefix(f"{t}__") for c in rows.columns}
        for c, raw in source.items():
            if names.unique.get(raw) or names.sites.get(raw):  # in every experiment
                rows = rows.drop(c)
            elif raw in names.unique or raw in names.sites:
                known = F.array_contains("__r.unique", raw) | F.coalesce((F.col("__r.lon") == raw) | (F.col("__r.lat") == raw), F.lit(False))
                rows = rows.withColumn(c, F.when(~known, F.col(c)))
        parts.append(rows.drop("__r"))
    plots = union_padded(*parts)
    attrs = [c for c in plots.columns if c not in {*by, *STANDARD.values()}]
    numbered = dense_ids(plots, attrs, "FL_ID", by)
    fields = numbered.select(*by, "FL_ID", *attrs).distinct()
    site = metadata.select(*by, F.col("longitude").alias("FL_LON"), F.col("latitude").alias("FL_LAT"))
    return null_safe_join(fields, site, by), numbered.select(*by, "Plot_id", "FL_ID").distinct()


def treatment_matrix(
    design: DataFrame,
    id_tables: list[DataFrame],
    plot_fields: DataFrame | None,
    by: list[str],
) -> DataFrame:
    """Management ids per plot and year; no event is id 0; ``TRTNO`` numbers the treatments."""
    out = chain_left(design.drop("Rep_no").distinct(), id_tables)
    if plot_fields is not None:
        out = null_safe_join(out, plot_fields, [*by, "Plot_id"])
    ids = [c for c in out.columns if c.endswith("_ID")]
    out = out.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType)) for c in ids}
    )
    return dense_ids(out, ["Treatment_id"], "TRTNO", by)


def observed_section(
    design: DataFrame, tables: dict[str, DataFrame], cat: dict[str, dict], by: list[str], long: bool = False
) -> DataFrame:
    """Observations with the treatment and replicate of their plot, numbered by treatment; every year of the design is there.

    Summaries have one row per plot and year and are joined. Series (``long``) have several, so each row stands for itself, with
    its table in ``source``.
    """
    slim = {n: df.drop(*[k for k in cat[n]["key"] if k not in (*by, *STANDARD.values())]) for n, df in tables.items()}
    facts = ["Treatment_id", *[c for c in ("Rep_no",) if c in design.columns]]
    joined = on_design(design, slim, [*by, "Year", "Plot_id"], facts, long)
    return dense_ids(joined, ["Treatment_id"], "TRTNO", by).distinct()


def general_section(metadata: DataFrame, by: list[str]) -> DataFrame:
    """One row per experiment with contacts, site and notes."""
    notes = F.array(
        F.concat(F.lit("Data files mapped on "), F.date_format(F.current_date(), "yyyy-MM-dd")),
        F.concat(F.lit("Source data DOI: "), F.coalesce("doi", F.lit("NA"))),
    )
    return metadata.select(
        *by,
        F.col("contact_name").alias("PERSONS"),
        F.col("contact_email").alias("EMAIL"),
        F.col("trial_institution").alias("ADDRESS"),
        F.col("site").alias("SITE"),
        F.col("country").alias("COUNTRY"),
        F.col("size_plots").alias("PLTA"),
        F.col("doi").alias("DOI"),
        notes.alias("NOTES"),
    )


def header_section(metadata: DataFrame, by: list[str], countries: dict[str, str] | None = None) -> DataFrame:
    """Experiment title and site code: two letters of the site, two of the country (``countries``: name -> code)."""
    countries = country_codes(metadata.sparkSession) if countries is None else countries
    pairs = [F.lit(x) for kv in countries.items() for x in kv]
    iso = F.try_element_at(F.create_map(*pairs), F.col("country"))
    return metadata.select(*by, F.col("name").alias("EXP_DETAILS"), site_code(F.col("site"), iso).alias("SITE_CODE"))


def reshape_experiments(
    db: dict[str, DataFrame],
    metadata: DataFrame,
    design: str,
    by: list[str] = ("experiment_id",),
    roles: Roles | None = None,
    max_events: float = MAX_EVENTS,
    observed: bool = True,
    materialize: bool = False,
) -> dict[str, DataFrame]:
    """The section bundle of all experiments in ``db``, each as if it were alone.

    Every table has the scope columns ``by``; ``metadata`` has one row per scope (see :func:`design_columns` and
    :func:`general_section` for its columns). Keys, design columns, factors, date layouts and conflicts between tables are settled for
    each experiment; names that only some have are null in the others. Experiments whose design can't be found are left out and
    listed with the reason in ``PROBLEMS``; only if none is left an error is raised. ``materialize=True`` writes
    the joined data tables to the checkpoint folder, as several sections read them.
    ``observed=False`` leaves the observed sections out.
    """
    by = list(by)
    given = {k: v for k, v in vars(roles).items() if v} if roles else {}
    solved = solve_roles(db, metadata, design, by, given)
    names = names_in(solved, {n: df.columns for n, df in db.items()})
    if not names.roles["year"]:
        raise LookupError("; ".join(names.problems) or "no experiments")
    shape = Projection(solved, names, by)
    tables, cat = standard_tables(db, shape, names, by)

    # the design with the columns of its plots and treatments; its own columns count
    design_tables = [n for n in dict.fromkeys([*names.treatments_tables, *names.plots_tables]) if n != design]
    mine = [c for c in STANDARD.values() if c in tables[design].columns]
    parts = {n: shape.keyed(tables[n].drop(*[c for c in mine if c not in cat[n]["key"]]), n) for n in design_tables}
    sub = {n: {"columns": list(df.columns), "key": cat[n]["key"]} for n, df in (parts | {design: tables[design]}).items()}
    full = merge_tables({design: tables[design]}, parts, sub, "child-parent", False, by)[0][design]
    links = {c: f"{t}_KEY" for t, cs in shape.several.items() for c in cs}
    # factor -> its column in the plan
    placed = {f: next((c for c in (links.get(f, f), *(f"{t}__{f}" for t in ts)) if c in full.columns), None) for f, ts in names.factors.items()}
    factors = list(dict.fromkeys(c for c in placed.values() if c))
    plan = full.select(*by, *[c for c in STANDARD.values() if c in full.columns], *factors).distinct()

    others = {n: df for n, df in tables.items() if n != design and n not in design_tables}
    data = {n: rows for n, df in others.items() if (rows := shape.linked(df, n, True)) is not None}
    attrs = {n: shape.keyed(rows, n) for n, df in others.items() if (rows := shape.linked(df, n, False)) is not None}
    attrs = fold_attributes(attrs, cat, by)
    folded = cat | {n: {"columns": list(df.columns), "key": cat[n]["key"]} for n, df in attrs.items()}
    data, _ = merge_tables(data, attrs, folded, "bidirectional", True, by)
    if materialize:
        data = {n: checkpointed(df) for n, df in data.items()}

    keys = {n: [k for k in cat[n]["key"] if k in df.columns] for n, df in data.items()}
    dated = {n: df for n, df in data.items() if "Year" in df.columns and "Plot_id" in df.columns}
    tagged: dict[str, dict[str, DataFrame]] = {}
    if dated:
        own_plots = solved.select(*by, F.explode("own_plots").alias("o")).select(*by, "o.*")
        years = written(table_years(dated, "Year", "Plot_id", solved.select(*by, "n_plots"), keys, by, max_events, own_plots), "years")
        tagged = split_by_tag(dated, years, "Year", by)

    management: dict[str, DataFrame] = {}
    id_tables: list[DataFrame] = []
    levels = [*factors, *(["Treatment_id"] if names.no_factors or not factors else [])]
    used = None
    if names.factor_sets > 1:  # experiments differ in their factors
        mapped = F.create_map(*[F.lit(x) for f, c in placed.items() if c for x in (f, c)]) if factors else F.create_map(F.lit(""), F.lit(""))
        known = F.filter(F.transform("factors", lambda f: F.try_element_at(mapped, f)), lambda c: c.isNotNull())
        used = solved.select(*by, F.when(F.size("factors") > 0, known).otherwise(F.array(F.lit("Treatment_id"))).alias("__used"))
    for n, df in sorted(tagged.get("management", {}).items()):
        name = f"{n}_ID"
        flags = years.where(F.col("table") == n).select(*by, F.col("Year").cast(df.schema["Year"].dataType).alias("Year"), "is_trt")
        flags = null_safe_join(flags, used, by) if used is not None else flags
        extra = [c for c in plan.columns if c not in df.columns or c in (*by, "Year", "Plot_id")]
        rows = null_safe_join(df, plan.select(*extra), [*by, "Year", "Plot_id"])
        marked = management_ids(rows, flags, levels, name, by, used="__used" if used is not None else None)
        drops = {*keys[n], "Treatment_id", "Rep_no", *factors}
        slim = marked.select(name, *[c for c in marked.columns if c not in drops and c != name])
        management[n] = slim.drop("Plot_id").distinct()
        id_tables.append(slim.select(*by, "Year", "Plot_id", name).distinct())

    fields, plot_fields = fields_section(tables, solved, names, metadata, by)
    matrix = treatment_matrix(plan, id_tables, plot_fields, by)
    usable = solved.where(F.col("problem").isNull()).select(*by)
    described = null_safe_join(metadata, usable, by, "left_semi")
    bundle = {
        "HEADER": header_section(described, by),
        "GENERAL": general_section(described, by),
        "FIELDS": fields,
        "TREATMENTS": matrix.drop("Plot_id", "Treatment_id").distinct(),
        **management,
    }
    if observed:
        bundle["OBSERVED_Summary"] = observed_section(plan, tagged.get("observed_summary", {}), cat, by)
        bundle["OBSERVED_TimeSeries"] = observed_section(plan, tagged.get("observed_timeseries", {}), cat, by, long=True)
    loose = {n: df for n, df in data.items() if n not in dated} | attrs
    bundle |= {f"OTHER_{n}": df for n, df in sorted(loose.items())}
    bundle = {n: shape.restored(df) for n, df in bundle.items()}
    return bundle | {"PROBLEMS": solved.where(F.col("problem").isNotNull()).select(*by, "problem")}
