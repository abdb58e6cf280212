"""Column roles of many experiments at once, found for each of them alone.

The cells of all tables are summarised in one grouped pass (scope, column, value), the summaries of a scope become one row, and that
row is solved by expressions: keys, design columns, factors, date layouts, or the reason why there are none. The
result is a table of roles with a row per scope; only the names that occur in any scope come to the driver, as a plan needs
its columns. Scopes may differ in every role.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.functions import dates
from agroloom.operators.profile import INTEGERS, NUMBERS
from agroloom.operators.scale import null_safe_join
from agroloom.session import written

#: standard names of the design columns, by role
STANDARD = {"year": "Year", "plot": "Plot_id", "treatment": "Treatment_id", "rep": "Rep_no"}
#: roles that tie a table to the design
LINKS = ("year", "plot", "treatment")


@dataclass(frozen=True)
class Place:
    """A column of a table, with the kind of its type."""

    table: str
    column: str
    kind: str


def places(db: dict[str, DataFrame], by: list[str]) -> list[Place]:
    def kind(t: T.DataType) -> str:
        if isinstance(t, NUMBERS):
            return "int" if isinstance(t, INTEGERS) else "number"
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "date"
        return "text" if isinstance(t, T.StringType) else "other"

    return [Place(n, f.name, kind(f.dataType)) for n, df in db.items() for f in df.schema if f.name not in by and not isinstance(f.dataType, T.MapType)]


def _quoted(text: str, mark: str = "'") -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'") if mark == "'" else text.replace("`", "``")
    return f"{mark}{escaped}{mark}"


def _of(values: list[str], at: str) -> Column:
    """One of some fixed texts."""
    return F.expr(f"get(array({', '.join(map(_quoted, values))}), {at})")


def _cells(columns: dict[str, str], name: str) -> Column:
    """Array of the columns of a row as text, each with what stands for it (an SQL literal)."""
    return F.expr("array(" + ", ".join(f"named_struct('{name}', {mark}, 'v', cast({_quoted(c, '`')} AS string))" for c, mark in columns.items()) + ")")


def column_facts(db: dict[str, DataFrame], by: list[str], known: list[Place]) -> DataFrame:
    """One row per scope and column: rows, nulls, exact distinct values (null is one), range of its numbers or years, and the first date
    layout that fits all values.

    All tables go through one pass: equal values of a scope and column are combined before the shuffle, so neither a hot
    scope nor a hot value reaches one task, and layouts are tried on distinct values only.
    """
    parts = []
    for table, df in db.items():
        own = {p.column: str(i) for i, p in enumerate(known) if p.table == table}
        if own:
            parts.append(df.select(*by, F.explode(_cells(own, "cell")).alias("c")).select(*by, "c.cell", "c.v"))
    values = reduce(DataFrame.unionByName, parts).groupBy(*by, "cell", "v").agg(F.count(F.lit(1)).alias("n"))
    kind = _of([p.kind for p in known], "cell")
    v = F.col("v")
    number = F.when(kind.isin("int", "number"), v.try_cast("double")).when(kind == "date", F.year(v.try_cast("timestamp")).cast("double"))
    lays = list(dates.DATE_LAYOUTS)
    tried = [(kind == "text") | ((kind == "int") & F.lit(x == "yyyyMMdd")) for x in lays]
    misfits = [F.count_if(~may | (v.isNotNull() & dates.parse_date(F.when(may, v), x).isNull())).alias(f"m{i}") for i, (x, may) in enumerate(zip(lays, tried))]
    facts = values.groupBy(*by, "cell").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(v.isNull(), F.col("n"))), F.lit(0).cast("long")).alias("n_null"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        *misfits,
    )
    layout = F.coalesce(F.when(kind == "date", "date"), *[F.when(F.col(f"m{i}") == 0, x) for i, x in enumerate(lays)])
    return facts.select(
        *by, "cell", _of([p.table for p in known], "cell").alias("table"), _of([p.column for p in known], "cell").alias("column"),
        kind.alias("kind"), "n_rows", "n_null", "n_distinct", "low", "high", layout.alias("layout"),
    )


def _first(options: Column) -> Column:
    return F.try_element_at(options, F.lit(1))


def _preferred(options: Column, better) -> Column:
    """The first option that is ``better``, else the first."""
    return F.coalesce(_first(F.filter(options, better)), _first(options))


def _owners(column: Column) -> Column:
    """Tables whose key is a column."""
    return F.filter("keys", lambda k: k["column"] == column)


def _is_key(c: Column) -> Column:
    return F.exists("keys", lambda k: k["column"] == c["column"])


def design_columns(facts: DataFrame, metadata: DataFrame, design: str, tables: list[str], by: list[str], given: dict[str, str]) -> DataFrame:
    """One row per scope: its columns with their facts, its keys, and year and plot column of the design table.

    A column without any value is not there. The key of a table is its first column with a value of its own in every row; the year column lies
    in the years of the experiment (one that varies goes first); the plot column has as many values as there are plots (the key
    of a table goes first). ``given`` names roles that are not searched.
    """
    rest = [c for c in facts.columns if c not in by]
    facts_of = ["start_year", "end_year", "number_plots", "replication", "latitude", "longitude"]
    own = [(F.col(c) if c in metadata.columns else F.lit(None)).cast("double").alias(c) for c in facts_of]
    both = facts.select(*by, F.struct(*rest).alias("cell")).unionByName(
        metadata.select(*by, F.struct(*own, F.lit(True).alias("described")).alias("meta")), allowMissingColumns=True
    )
    rows = both.groupBy(*by).agg(F.array_sort(F.collect_list("cell")).alias("cells"), F.max("meta").alias("meta")).select(*by, "cells", "meta.*")
    rows = rows.withColumn("cells", F.filter("cells", lambda c: c["n_null"] < c["n_rows"]))
    rows = rows.withColumn("unique", F.filter("cells", lambda c: c["n_distinct"] == c["n_rows"]))
    names = F.expr(f"array({', '.join(map(_quoted, tables))})")
    key_of = F.transform(names, lambda t: F.struct(t.alias("table"), _first(F.filter("unique", lambda c: c["table"] == t))["column"].alias("column")))
    rows = rows.withColumn("keys", F.filter(key_of, lambda k: k["column"].isNotNull()))
    design_key = _first(F.filter("keys", lambda k: k["table"] == design))["column"]
    rows = rows.withColumn("design_key", design_key).withColumn(
        "free", F.filter("cells", lambda c: (c["table"] == design) & ~c["column"].eqNullSafe(F.col("design_key")))
    )
    in_years = F.filter(
        "free", lambda c: (c["n_null"] == 0) & c["kind"].isin("int", "number", "date") & (c["low"] >= F.col("start_year")) & (c["high"] <= F.col("end_year"))
    )
    year = _preferred(in_years, lambda c: c["n_distinct"] > 1)
    if "year" in given:
        year = _first(F.filter("cells", lambda c: (c["table"] == design) & (c["column"] == given["year"])))
    rows = rows.withColumn("y", year).withColumn("n_plots", F.coalesce(F.col("number_plots"), F.col("y")["n_rows"] / F.col("y")["n_distinct"]))
    sized = F.filter("free", lambda c: (c["n_distinct"] == F.col("n_plots")) & (c["column"] != F.col("y")["column"]))
    plot = _preferred(sized, _is_key)
    if "plot" in given:
        plot = _first(F.filter("cells", lambda c: (c["table"] == design) & (c["column"] == given["plot"])))
    return rows.withColumn("p", plot).withColumns({"year": F.col("y")["column"], "plot": F.col("p")["column"]})


def repetitions(design: DataFrame, solved: DataFrame, by: list[str]) -> DataFrame:
    """Per scope the least and largest number of rows of a value in each design column, without the plot column and repeated rows."""
    cells = _cells({c: _quoted(c) for c in design.columns if c not in by}, "column")
    rows = null_safe_join(design, solved.where(F.col("plot").isNotNull()).select(*by, F.col("plot").alias("__plot")), by, "inner")
    kept = rows.select(*by, F.filter(cells, lambda x: x["column"] != F.col("__plot")).alias("r")).distinct()
    counts = kept.select(*by, F.explode("r").alias("c")).groupBy(*by, "c.column", "c.v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by, "column").agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"))


def solve_roles(
    db: dict[str, DataFrame], metadata: DataFrame, design: str, by: list[str], given: dict[str, str] | None = None
) -> DataFrame:
    """The roles of every scope, one row each, written to the checkpoint folder.

    year, plot, treatment, rep: columns of the design (rep of the plots table, may be null); plots_table, treatments_table; factors; keys
    (table, column); unique (columns of the plots table with a value of their own in every row); lon, lat: columns of the plots table
    that hold the experiment's coordinates; cells (table, column, layout) of all columns with values; problem: why the scope has
    no roles, else null.
    """
    given = given or {}
    known = places(db, by)
    facts = column_facts(db, by, known)
    found = written(design_columns(facts, metadata, design, list(db), by, given), "facts")
    repeats = repetitions(db[design], found, by).select(*by, F.struct("column", "n_min", "n_max").alias("repeat"))
    facts_of = F.struct(*[c for c in found.columns if c not in by])
    both = found.select(*by, facts_of.alias("row")).unionByName(repeats, allowMissingColumns=True)
    rows = both.groupBy(*by).agg(F.first("row", ignorenulls=True).alias("row"), F.collect_list("repeat").alias("repeats")).select(*by, "row.*", "repeats")

    def repeated(c: Column) -> Column:
        return _first(F.filter("repeats", lambda r: r["column"] == c))

    n_years = F.col("y")["n_distinct"]
    regular = F.filter(
        "free",
        lambda c: (c["column"] != F.col("year"))
        & (c["column"] != F.col("plot"))
        & F.exists("repeats", lambda r: (r["column"] == c["column"]) & (r["n_min"] == r["n_max"]) & (r["n_min"] / n_years < F.col("p")["n_distinct"])),
    )
    treatment = _preferred(regular, _is_key)["column"]
    rows = rows.withColumn("treatment", F.lit(given["treatment"]) if "treatment" in given else treatment)
    rows = rows.withColumns({"plot_owners": _owners(F.col("plot")), "treatment_owners": _owners(F.col("treatment"))})
    rows = rows.withColumns({"plots_table": _first(F.col("plot_owners"))["table"], "treatments_table": _first(F.col("treatment_owners"))["table"]})
    reps = F.coalesce(F.col("replication"), repeated(F.col("treatment"))["n_min"] / n_years)
    rows = rows.withColumn("n_reps", reps)
    in_plots = F.filter("cells", lambda c: c["table"] == F.col("plots_table"))
    rep = _first(F.filter(in_plots, lambda c: (c["n_distinct"] == F.col("n_reps")) & ~c["column"].isin(F.col("plot"), F.col("treatment"))))["column"]
    own_key = _first(F.filter("keys", lambda k: k["table"] == F.col("treatments_table")))["column"]
    factors = F.filter(
        "cells",
        lambda c: (c["table"] == F.col("treatments_table"))
        & ~c["column"].isin(F.col("plot"), F.col("treatment"))
        & ~c["column"].eqNullSafe(own_key)
        & F.exists("keys", lambda k: (k["table"] != F.col("treatments_table")) & (k["column"] == c["column"])),
    )

    def constant(value: str) -> Column:
        same = F.filter(in_plots, lambda c: c["kind"].isin("int", "number") & (c["n_null"] == 0) & (c["low"] == F.col(value)) & (c["high"] == F.col(value)))
        return _first(same)["column"]

    def several(owners: str, what: str) -> Column:
        names = F.array_join(F.transform(owners, lambda k: k["table"]), ", ")
        return F.when(F.size(owners) != 1, F.concat(F.size(owners).cast("string"), F.lit(f" tables have the {what} as their key: "), names))

    problem = F.coalesce(
        F.when(F.col("described").isNull(), F.lit("no metadata")),
        F.when(~F.exists("cells", lambda c: c["table"] == design), F.lit(f"no rows in {design}")),
        F.when(F.col("year").isNull(), F.lit(f"no column of {design} lies in the years of the experiment")),
        F.when(F.col("plot").isNull(), F.lit(f"no column of {design} has as many values as there are plots")),
        several("plot_owners", "plot"),
        F.when(F.col("treatment").isNull(), F.lit(f"no column of {design} repeats like a treatment")),
        several("treatment_owners", "treatment"),
    )
    out = rows.select(
        *by, "year", "plot", "treatment", (F.lit(given["rep"]) if "rep" in given else rep).alias("rep"), "plots_table", "treatments_table",
        F.transform(factors, lambda c: c["column"]).alias("factors"), "keys", F.col("p.n_distinct").alias("n_plots"),
        F.transform(
            F.filter("cells", lambda c: c["column"] == F.col("plot")), lambda c: F.struct(c["table"].alias("table"), c["n_distinct"].alias("n_own"))
        ).alias("own_plots"),
        F.transform(F.filter("unique", lambda c: c["table"] == F.col("plots_table")), lambda c: c["column"]).alias("unique"),
        constant("longitude").alias("lon"), constant("latitude").alias("lat"),
        F.transform("cells", lambda c: F.struct(c["table"].alias("table"), c["column"].alias("column"), c["layout"].alias("layout"))).alias("cells"),
        problem.alias("problem"),
    )
    return written(out, "roles")


@dataclass
class Names:
    """What occurs in any scope: the names that the plan of a batch is built from."""

    roles: dict[str, list[str]]  # role -> source columns
    some: set[str]  # roles that not every scope has
    left: set[str]  # columns that are no design column in some scope that has them
    keys: dict[str, list[str]]  # table -> key columns under their standard names
    unkeyed: set[str]  # tables that have no key in some scope with rows
    layouts: dict[tuple[str, str], list[str | None]]  # (table, column) -> layouts, null where values are no dates
    plots_tables: list[str]
    treatments_tables: list[str]
    factors: dict[str, list[str]]  # factor column -> treatment tables that have it
    factor_sets: int
    no_factors: bool  # a scope without any
    linked: dict[str, list[bool]]  # table -> whether it has design columns, in the scopes that have the table
    unique: dict[str, bool]  # column of a plots table -> whether unique wherever it has values
    sites: dict[str, bool]  # column of a plots table with coordinates -> whether it holds them wherever it has values
    problems: list[str] = field(default_factory=list)


def standard(column: Column) -> Column:
    """Name of a source column in the scope's standard names."""
    out = column
    for role, name in reversed(STANDARD.items()):
        out = F.when(column == F.col(role), F.lit(name)).otherwise(out)
    return out


def names_in(roles: DataFrame, order: dict[str, list[str]]) -> Names:
    """The distinct names of all scopes, in one pass over the table of roles. ``order``: the columns of the tables, by which
    lists are sorted."""
    used = F.array(*[F.col(r) for r in STANDARD])
    none = F.lit(None).cast("string")

    def item(what: str, a: Column = none, b: Column = none, c: Column = none) -> Column:
        return F.struct(F.lit(what).alias("what"), a.cast("string").alias("a"), b.cast("string").alias("b"), c.cast("string").alias("c"))

    in_plots = F.filter("cells", lambda c: c["table"] == F.col("plots_table"))
    with_rows = F.array_distinct(F.transform("cells", lambda c: c["table"]))
    site = lambda c: F.coalesce((c["column"] == F.col("lon")) | (c["column"] == F.col("lat")), F.lit(False))
    items = F.concat(
        F.array(*[item(r, F.col(r)) for r in STANDARD], item("plots", F.col("plots_table")), item("treatments", F.col("treatments_table"))),
        F.transform("keys", lambda k: item("key", k["table"], standard(k["column"]))),
        F.transform(F.filter(with_rows, lambda t: ~F.exists("keys", lambda k: k["table"] == t)), lambda t: item("unkeyed", t)),
        F.transform("cells", lambda c: item("layout", c["table"], c["column"], c["layout"])),
        F.transform(F.filter("cells", lambda c: ~F.coalesce(F.array_contains(used, c["column"]), F.lit(False))), lambda c: item("left", c["column"])),
        F.transform(with_rows, lambda t: item("linked", t, F.exists("cells", lambda c: (c["table"] == t) & c["column"].isin(*[F.col(r) for r in LINKS])))),
        F.transform("factors", lambda f: item("factor", f, F.col("treatments_table"))),
        F.array(item("factors", F.array_join(F.array_sort("factors"), "\n"))),
        F.transform(in_plots, lambda c: item("unique", c["column"], F.array_contains("unique", c["column"]))),
        F.transform(in_plots, lambda c: item("site", c["column"], site(c))),
    )
    shown = F.when(F.col("problem").isNull(), items).otherwise(F.array(item("problem", F.col("problem"))))
    found: dict[str, list[tuple]] = {}
    for r in roles.select(F.explode(shown).alias("i")).select("i.*").distinct().collect():
        found.setdefault(r["what"], []).append((r["a"], r["b"], r["c"]))
    place = {c: i for i, c in enumerate(dict.fromkeys(c for cs in order.values() for c in cs))}

    def sort(names) -> list[str]:
        return sorted({n for n in names if n is not None}, key=lambda c: (place.get(c, -1), c))

    def firsts(what: str) -> list:
        return [x[0] for x in found.get(what, [])]

    def marked(what: str) -> dict[str, bool]:
        """Names that are marked in some scope; whether they are in all that have them."""
        hits = {c for c, hit, _ in found.get(what, []) if hit == "true"}
        return {c: (c, "false", None) not in found[what] for c in hits}

    keys: dict[str, list[str]] = {}
    for t, c, _ in found.get("key", []):
        keys.setdefault(t, []).append(c)
    layouts: dict[tuple[str, str], list[str | None]] = {}
    for t, c, layout in sorted(found.get("layout", []), key=str):
        layouts.setdefault((t, c), []).append(layout)
    return Names(
        roles={r: sort(firsts(r)) for r in STANDARD},
        some={r for r in STANDARD if None in firsts(r)},
        left=set(firsts("left")),
        keys={t: sort(cs) for t, cs in keys.items()},
        unkeyed=set(firsts("unkeyed")),
        layouts=layouts,
        plots_tables=sort(firsts("plots")),
        treatments_tables=sort(firsts("treatments")),
        factors={c: sorted({t for x, t, _ in found["factor"] if x == c}) for c in sort(firsts("factor"))},
        factor_sets=len(set(firsts("factors"))),
        no_factors="" in firsts("factors"),
        linked={t: sorted(b == "true" for x, b, _ in found["linked"] if x == t) for t in sort(firsts("linked"))},
        unique=marked("unique"),
        sites=marked("site"),
        problems=sorted(firsts("problem")),
    )


def link_name(table: str, names: Names) -> str | None:
    """Column by which a table is referred to: its key's name, or one of its own where scopes use several."""
    keys = names.keys.get(table, [])
    return (keys[0] if len(keys) == 1 else f"{table}_KEY") if keys else None


class Projection:
    """Tables of a batch under standard names: every scope's own columns move to the columns that the plan uses."""

    def __init__(self, roles: DataFrame, names: Names, by: list[str]):
        self.names, self.by = names, by
        self.roles = roles.where(F.col("problem").isNull())
        #: tables whose key has several names, with those that are no design columns
        self.several = {t: [c for c in ks if c not in STANDARD.values()] for t, ks in names.keys.items() if len(ks) > 1}

    def standardized(self, df: DataFrame, table: str) -> DataFrame:
        """Rows of scopes with roles; design columns and keys under their standard names, date columns as dates.

        A column that is a date in some scopes only stays text, with the dates in year-month-day form.
        """
        names, by = self.names, self.by
        own = [c for c in df.columns if c not in by]
        moves: dict[str, dict[str, Column]] = {}  # new column -> source column -> where it is taken
        for role, new in STANDARD.items():
            sources = [c for c in names.roles[role] if c in own]
            if sources:
                moves[new] = {c: F.col(f"__r.{role}") == c for c in sources}
        for t, keys in self.several.items():
            key = F.try_element_at(F.filter("__r.keys", lambda k: k["table"] == t), F.lit(1))["column"]  # noqa: B023
            design = [c for role, new in STANDARD.items() if new in names.keys[t] for c in names.roles[role]]
            sources = [c for c in dict.fromkeys([*keys, *design]) if c in own]
            if sources:
                moves[f"{t}_KEY"] = {c: key == c for c in sources}
        plain = {
            c: n for n, m in moves.items() for c in m
            if len(m) == 1 and n in STANDARD.values() and len(names.roles[_role(n)]) == 1 and _role(n) not in names.some
        }
        day = {c: [x for x in names.layouts.get((table, c), [])] for c in own if c not in plain}
        day = {c: lays for c, lays in day.items() if any(lays) and not self._linked(c)}
        new: dict[str, Column] = {}
        for c in own:
            if c in plain:
                new[plain[c]] = F.col(f"`{c}`")
                continue
            moved = [m[c] for n, m in moves.items() if c in m]
            value = self._dated(table, c, day[c]) if c in day else F.col(f"`{c}`")
            if moved:
                value = F.when(~reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in moved]), value)
            new[c] = value
        for n, m in moves.items():
            if n not in plain.values():
                kinds = {df.schema[c].dataType for c in m}
                same = len(kinds) == 1 or all(isinstance(k, NUMBERS) for k in kinds)
                new[n] = F.coalesce(*[F.when(hit, F.col(f"`{c}`") if same else F.col(f"`{c}`").cast("string")) for c, hit in m.items()])
        gone = [c for c in own if c not in plain and self._always_moved(c, moves)]
        shown = [v.alias(n) for n, v in new.items() if n not in gone]
        if not names.problems and len(plain) == sum(len(m) for m in moves.values()) and all(len(x) == 1 for x in day.values()):
            return df.select(*by, *shown)  # all scopes agree
        mine = self.roles.select(*by, F.struct("year", "plot", "treatment", "rep", "keys", "cells").alias("__r"))
        return null_safe_join(df, mine, by, "inner").select(*by, *shown)

    def _linked(self, c: str) -> bool:
        """Design columns and keys are not read as dates."""
        return any(c in m for m in self.names.roles.values()) or any(c in ks for ks in self.names.keys.values())

    def _always_moved(self, c: str, moves: dict) -> bool:
        """It is a design column in every scope that has it, or the key of a table that is known by other names elsewhere."""
        if not any(c in m for m in moves.values()):
            return False
        return c not in self.names.left or (any(c in ks for ks in self.several.values()) and not any(ks == [c] for ks in self.names.keys.values()))

    def _dated(self, table: str, c: str, lays: list[str | None]) -> Column:
        value, known = F.col(f"`{c}`"), [x for x in lays if x]

        def day(layout: str) -> Column:
            return value.try_cast("date") if layout == "date" else dates.parse_date(value, layout)

        if len(lays) == 1:
            return day(known[0])
        mine = F.try_element_at(F.filter("__r.cells", lambda x: (x["table"] == table) & (x["column"] == c)), F.lit(1))["layout"]
        parsed = F.coalesce(*[F.when(mine == x, day(x)) for x in known])
        return parsed if None not in lays else F.coalesce(parsed.cast("string"), F.when(mine.isNull(), value.cast("string")))

    def linked(self, df: DataFrame, table: str, wanted: bool) -> DataFrame | None:
        """Rows of the scopes in which the table has design columns (or has none); None if there are no such scopes."""
        kinds = self.names.linked.get(table, [False])
        if wanted not in kinds:
            return None
        if len(kinds) == 1:
            return df
        tied = F.exists("cells", lambda c: (c["table"] == table) & c["column"].isin(*[F.col(r) for r in LINKS]))
        return null_safe_join(df, self.roles.where(tied == wanted).select(*self.by), self.by, "left_semi")

    def keyed(self, df: DataFrame, table: str) -> DataFrame:
        """Rows that others can refer to: those of scopes in which the table has a key."""
        if table not in self.names.unkeyed:
            return df
        has = self.roles.where(F.exists("keys", lambda k: k["table"] == table)).select(*self.by)
        return null_safe_join(df, has, self.by, "left_semi")

    def restored(self, df: DataFrame) -> DataFrame:
        """Keys with several names under the name that each scope has for them."""
        mine = {t: cs for t, cs in self.several.items() if f"{t}_KEY" in df.columns}
        if not mine:
            return df
        out = null_safe_join(df, self.roles.select(*self.by, F.col("keys").alias("__keys")), self.by)
        for t, cs in mine.items():
            key = F.try_element_at(F.filter("__keys", lambda k: k["table"] == t), F.lit(1))["column"]  # noqa: B023
            for c in cs:
                value = F.when(key == c, F.col(f"{t}_KEY"))
                out = out.withColumn(c, F.coalesce(F.col(c), value) if c in out.columns else value)
        return out.drop("__keys", *[f"{t}_KEY" for t in mine])


def _role(name: str) -> str:
    return next(r for r, n in STANDARD.items() if n == name)

