"""Joins between the tables of an experiment. Null keys match null keys throughout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.operators.areas import inside_ring, locate_points  # noqa: F401
from agroloom.operators.profile import parent_edges
from agroloom.operators.scale import null_safe_join


def merge_keys(parent: dict, child: dict, kind: str) -> list[str]:
    """Join columns of a pair of catalog entries (``columns``, ``key``)."""
    down = [k for k in parent["key"] if k in child["columns"]]
    up = [c for c in parent["columns"] if c in child["key"]]
    if kind == "parent-child":
        return down
    if kind == "child-parent":
        return up
    if kind == "bidirectional":
        return list(dict.fromkeys(down + up))
    raise ValueError(f"unknown relation {kind!r}")


def agreeing_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> list[bool]:
    """Whether two columns never differ where both have a value; one aggregate for all pairs."""
    row = df.agg(
        *[F.bool_and(F.coalesce(F.col(x) == F.col(y), F.lit(True))).alias(f"p{i}") for i, (x, y) in enumerate(pairs)]
    ).first()
    return [row[f"p{i}"] is not False for i in range(len(pairs))]


def merge_pair(parent: DataFrame, child: DataFrame, keys: list[str]) -> DataFrame:
    """Left join; columns in both tables collapse to the child's value when they agree,
    else both stay with ``_x`` and ``_y``."""
    shared = [c for c in child.columns if c in parent.columns and c not in keys]
    left = parent.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = child.withColumnsRenamed({c: f"{c}_y" for c in shared})
    out = null_safe_join(left, right, keys)
    if shared:
        same = agreeing_pairs(out, [(f"{c}_x", f"{c}_y") for c in shared])
        for c, ok in zip(shared, same):
            if ok:
                out = out.drop(f"{c}_x").withColumnRenamed(f"{c}_y", c)
    return out


def merge_settled(parent: DataFrame, child: DataFrame, keys: list[str], by: list[str] = ()) -> DataFrame:
    """As :func:`merge_pair`, settled inside the plan and for each scope ``by`` alone.

    Columns in both tables travel side by side as (own, other); whether they agree is an aggregate per scope that is joined
    back, so no job runs before the result is read. Where a scope's values agree the column holds the child's value; where
    they don't, it is null and ``_x`` and ``_y`` hold both. The three columns are always there.
    """
    by = list(by)
    shared = [c for c in child.columns if c in parent.columns and c not in keys]
    if not shared:
        return null_safe_join(parent, child, keys)

    def packed(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[c for c in df.columns if c not in shared], F.struct(*shared).alias(name))

    out = null_safe_join(packed(parent, "__own"), packed(child, "__other"), keys)
    agree = {f"__same_{i}": F.bool_and(F.coalesce(F.col(f"__own.{c}") == F.col(f"__other.{c}"), F.lit(True))) for i, c in enumerate(shared)}
    if by:
        out = null_safe_join(out, out.groupBy(*by).agg(*[v.alias(k) for k, v in agree.items()]), by)
    else:
        out = out.withColumns({k: out.agg(v.alias(k)).scalar() for k, v in agree.items()})
    settled: dict[str, Column] = {}
    for bit, c in zip(agree, shared):
        own, other = F.col(f"__own.{c}"), F.col(f"__other.{c}")
        settled |= {c: F.when(F.col(bit), other), f"{c}_x": F.when(~F.col(bit), own), f"{c}_y": F.when(~F.col(bit), other)}
    return out.withColumns(settled).drop("__own", "__other", *agree)


def merge_tables(
    parents: dict[str, DataFrame],
    children: dict[str, DataFrame],
    cat: dict[str, dict],
    kind: str,
    drop_keys: bool = True,
    by: list[str] = (),
) -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """Left-join every linked child to every parent, children in name order; no job runs.

    Keys come from the catalog; with ``drop_keys`` they go after the last child, so
    two children may share a key. Columns in both tables are settled per scope (:func:`merge_settled`). Returns the tables and
    the names joined to each.
    """
    out, joined = {}, {}
    for p, df in sorted(parents.items()):
        used: list[str] = []
        names: list[str] = []
        for c, child in sorted(children.items()):
            keys = merge_keys(cat[p], cat[c], kind) if p != c else []
            if keys:
                df = merge_settled(df, child, [*by, *keys], by)
                used += [k for k in keys if k not in used]
                names.append(c)
        out[p] = df.drop(*used) if drop_keys and used else df
        joined[p] = names
    return out, joined


def fold_order(cat: dict[str, dict]) -> list[tuple[str, list[str]]]:
    """Tables with their parents, parents first. Mutual links are broken by name; a longer
    cycle is an error."""
    links: dict[str, set[str]] = {n: set() for n in cat}
    for child, parent, _ in parent_edges(cat):
        links[child].add(parent)
    for a in sorted(links):
        for b in sorted(links[a]):
            if a < b and a in links[b]:
                links[a].discard(b)
    order: list[tuple[str, list[str]]] = []
    done: set[str] = set()
    while len(done) < len(links):
        ready = sorted(n for n in links if n not in done and links[n] <= done)
        if not ready:
            raise ValueError(f"tables refer to each other in a circle: {sorted(set(links) - done)}")
        order += [(n, sorted(links[n])) for n in ready]
        done |= set(ready)
    return order


def fold_attributes(tables: dict[str, DataFrame], cat: dict[str, dict], by: list[str] = (), drop_keys: bool = True) -> dict[str, DataFrame]:
    """Attribute tables with the attributes of their parents, over any number of levels.

    The links are settled on the catalog first, so the rows see one plan of left joins.
    A table keeps its own primary key, by which others refer to it.
    """
    mine = {n: cat[n] for n in tables}
    out: dict[str, DataFrame] = {}
    for name, parents in fold_order(mine):
        df = tables[name]
        used: list[str] = []
        for p in parents:
            keys = [k for k in mine[p]["key"] if k in mine[name]["columns"]]
            df = merge_settled(df, out[p], [*by, *keys], by)
            used += keys
        drops = [k for k in used if k not in mine[name]["key"]]
        out[name] = df.drop(*drops) if drop_keys and drops else df
    return out


def chain_left(base: DataFrame, tables: list[DataFrame], keys: list[str] | None = None) -> DataFrame:
    """Left joins on the shared names (or ``keys``), each table reduced to distinct rows first."""
    out = base
    for t in tables:
        on = keys or [c for c in out.columns if c in t.columns]
        out = null_safe_join(out, t.distinct(), on)
    return out


def own_names(tables: dict[str, DataFrame], keys: list[str], taken: list[str] = ()) -> dict[str, DataFrame]:
    """Columns that several tables (or ``taken``) have beside the keys carry their table's name; the names alone decide."""
    uses: dict[str, int] = {c: 1 for c in taken if c not in keys}
    for t in tables.values():
        for c in t.columns:
            uses[c] = uses.get(c, 0) + 1
    return {
        n: t.withColumnsRenamed({c: f"{n}__{c}" for c in t.columns if c not in keys and uses[c] > 1}) for n, t in tables.items()
    }


def full_join(tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of all tables on common keys. Rows of a key are paired, so this is for tables with one row
    per key; see :func:`stacked` for the others."""
    out = None
    for t in own_names(tables, keys).values():
        if out is None:
            out = t
            continue
        rest = [c for c in (*out.columns, *t.columns) if c not in keys]
        twins = {k: f"__r_{i}" for i, k in enumerate(keys)}
        right = t.withColumnsRenamed(twins)
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in twins.items()])
        both = out.withColumn("__left", F.lit(True)).join(right, on, "full")
        first = F.col("__left").isNotNull()
        out = both.select(*[F.when(first, F.col(k)).otherwise(F.col(r)).alias(k) for k, r in twins.items()], *rest)
    return out


def stacked(tables: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Long form: every row of every table once, with the name of its table in ``source``."""
    named = own_names(tables, keys)
    return union_padded(*[t.withColumn("source", F.lit(n)) for n, t in named.items()])


def on_design(design: DataFrame, tables: dict[str, DataFrame], keys: list[str], facts: list[str], long: bool) -> DataFrame:
    """Observed tables with the ``facts`` of the design, seeded with the design: its rows without any observation stay.

    A table's own column called like a fact counts where the design does not know the key; where both differ the table's
    value is kept as ``TABLE__name``. ``long`` stacks the tables (:func:`stacked`), else they are joined
    (:func:`full_join`).
    """
    base = design.select(*keys, *facts).distinct()
    known = [f for f in facts if any(f in t.columns for t in tables.values())]
    named = {n: t.withColumnsRenamed({f: f"__own_{f}" for f in known if f in t.columns}) for n, t in tables.items()}

    def settled(df: DataFrame, names: dict[str, str]) -> DataFrame:
        """``names``: column with a table's own value -> the name under which a different value stays."""
        for own, stay in names.items():
            fact = own.split("__own_")[1]
            df = df.withColumn(stay, F.when(F.col(own) != F.col(fact), F.col(own)))
            df = df.withColumn(fact, F.coalesce(F.col(fact), F.col(own))).drop(own)
        return df

    if not long:
        qualified = {n: t.withColumnsRenamed({f"__own_{f}": f"{n}__own_{f}" for f in known}) for n, t in named.items()}
        out = full_join({"": base, **own_names(qualified, keys, facts)}, keys)
        return settled(out, {f"{n}__own_{f}": f"{n}__{f}" for n, t in tables.items() for f in known if f in t.columns})
    parts = {}
    for n, t in own_names(named, [*keys, *[f"__own_{f}" for f in known]], facts).items():
        rows = null_safe_join(t, base, keys)
        parts[n] = settled(rows, {f"__own_{f}": f"{n}__{f}" for f in known if f"__own_{f}" in t.columns})
    if not parts:
        return base.withColumn("source", F.lit(None).cast("string"))
    seen = reduce(DataFrame.union, [t.select(*keys) for t in tables.values()]).distinct()
    out = stacked(parts, [*keys, *facts, *[f"{n}__{f}" for n in parts for f in known]])
    return union_padded(out, null_safe_join(base, seen, keys, "left_anti"))


def union_padded(*tables: DataFrame) -> DataFrame:
    """Rows of all tables by column name, absent columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def merged_order(headers: list[list[str]]) -> list[str]:
    """All names, each header's in its own order where the headers don't contradict each other."""
    out: list[str] = []
    for names in headers:
        at = 0
        for c in names:
            if c in out:
                at = out.index(c) + 1
            else:
                out.insert(at, c)
                at += 1
    return out


def union_in_order(*tables: DataFrame) -> DataFrame:
    """:func:`union_padded` with the columns of every table in their own order, on which its key depends."""
    return union_padded(*tables).select(*[f"`{c}`" for c in merged_order([t.columns for t in tables])])


def rows_in_one(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows found in only one of two tables, compared on the shared columns; copies are kept."""
    on = [c for c in a.columns if c in b.columns]
    only_a = null_safe_join(a, b.select(*on).distinct(), on, "left_anti")
    only_b = null_safe_join(b, a.select(*on).distinct(), on, "left_anti")
    return only_a.unionByName(only_b, allowMissingColumns=True)


def contained_values(new: DataFrame, existing: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``new`` that are contained in a value of ``existing``; a null matches a null.

    Each existing value is cut into its substrings of the lengths that occur among the new ones, so the two meet in an
    equi join. Codes and names are short: a value of n characters has at most n substrings per length.
    """
    wanted = new.select(F.col(column).cast("string").alias("v")).distinct()
    sizes = wanted.agg(F.collect_set(F.length("v")).alias("n")).scalar()
    text = existing.select(F.col(column).cast("string").alias("t")).distinct().withColumn("sizes", sizes)
    cuts = F.transform(
        F.filter("sizes", lambda n: n <= F.length("t")),
        lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("t") - n + 1, F.lit(1))), lambda i: F.substr("t", i, n)),
    )
    have = text.select(F.explode_outer(F.when(F.col("t").isNotNull(), F.flatten(cuts))).alias("v")).distinct()
    known = null_safe_join(wanted, have, ["v"], "left_semi")
    return known.select(F.col("v").cast(new.schema[column].dataType).alias(column))


def guarded_insert(existing: DataFrame, new: DataFrame, unique: list[str]) -> tuple[DataFrame, DataFrame]:
    """Append records whose code and name are new; return (table, refused records).

    A record is refused if its value is contained in one of the table, in any of the ``unique`` columns. Of several new
    records with one code or name, the smallest by column order is taken.
    """
    refused = []
    accepted = new
    for c in unique:
        known = contained_values(accepted, existing, c)
        refused.append(null_safe_join(accepted, known, [c], "left_semi"))
        accepted = null_safe_join(accepted, known, [c], "left_anti")
        rest = [x for x in accepted.columns if x != c]
        firsts = accepted.groupBy(c).agg(F.min(F.struct(*rest)).alias("s")).select(c, "s.*").select(*new.columns)
        refused.append(accepted.exceptAll(firsts))
        accepted = firsts
    return existing.unionByName(accepted, allowMissingColumns=True), reduce(DataFrame.unionByName, refused)


def broadcast_header(rows: DataFrame, header: DataFrame, on: list[str]) -> DataFrame:
    """The header records of a scope on each of its rows."""
    return null_safe_join(rows, header, on)
