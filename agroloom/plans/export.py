"""Model input: conformed sections, print lines and partitioned fixed-width text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.functions.dates import to_doy
from agroloom.functions.text import cell
from agroloom.operators.columns import conform
from agroloom.operators.ids import reset_ids
from agroloom.operators.merge import broadcast_header
from agroloom.operators.nesting import collapse_columns
from agroloom.operators.profile import INTEGERS, NUMBERS, drop_null_columns
from agroloom.operators.scale import null_safe_join
from agroloom.plans import templates as tpl

YEARLESS = ("GENERAL", "FIELDS", "SOIL_Header", "SOIL_Layers")


def split_by_year(
    sections: dict[str, DataFrame], by: list[str], year: str = "Year"
) -> dict[str, DataFrame]:
    """Sections ready for yearly export; the year stays a column and becomes a folder on writing.

    Columns without any value go, observed tables go in the years in which they hold keys only,
    ids restart in each year.
    """
    out: dict[str, DataFrame] = {}
    for name, df in sections.items():
        if name in YEARLESS or year not in df.columns:
            out[name] = df
            continue
        slim = drop_null_columns(df, keep=[*by, year])
        if name.startswith("OBSERVED"):
            values = [c for c in slim.columns if c not in {*by, year, "TRTNO", "DATE"}]
            if not values:
                continue
            filled = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in values])
            slim = null_safe_join(slim, slim.filter(filled).select(*by, year).distinct(), [*by, year], "left_semi")
        ids = tpl.SECTION_IDS if name in tpl.SECTION_DDL else ()
        if name == "TREATMENTS":
            ids = ids + tpl.TREATMENT_IDS
        cols = [c for c in slim.columns if c in ids]
        out[name] = reset_ids(slim, cols, [*by, year]) if cols else slim
    return out


def format_section(df: DataFrame, template: T.StructType, by: list[str], order: list[str] = ()) -> DataFrame:
    """A section in its template: layer columns nested, types cast, missing columns null.

    Layers are nested per combination of the remaining input columns, ordered by ``order`` (the
    layer columns by default).
    """
    nested = [f.name for f in template if isinstance(f.dataType, T.ArrayType) and f.name in df.columns]
    flat = [f.name for f in template if not isinstance(f.dataType, T.ArrayType) and f.name in df.columns]
    plain = [f.name for f in template if f.name in nested and not isinstance(df.schema[f.name].dataType, T.ArrayType)]
    keys = [*by, *flat]
    if plain:
        rows = df.select(*keys, *plain, *[c for c in order if c not in [*keys, *plain]])
        packed = collapse_columns(rows, plain, list(order) or plain, by=keys)
        df = packed.select(*keys, *[F.col("items")[c].alias(c) for c in plain])
    extra = [c for c in keys if c not in template.names]
    shaped = T.StructType([df.schema[c] for c in extra] + list(template))
    return conform(df, shaped)


def treatment_defaults(df: DataFrame) -> DataFrame:
    """Null factor levels and section ids of the treatment table as their defaults."""
    return df.fillna({"R": 1.0, "O": 0.0, "C": 0.0, "SM": 1.0}).fillna(
        0.0, subset=[f.name for f in tpl.SECTIONS["TREATMENTS"] if isinstance(f.dataType, T.DoubleType)]
    )


def build_management(
    sections: dict[str, DataFrame], by: list[str], year: str = "Year"
) -> tuple[dict[str, DataFrame], list[str]]:
    """All management sections conformed and in file order, plus warnings for absent ones.

    An absent required section, the description and the simulation controls get one row of
    defaults per scope and year.
    """
    out: dict[str, DataFrame] = {}
    notes: list[str] = []
    yearly = [df.select(*by, year) for n, df in sections.items() if n in tpl.SECTION_DDL and year in df.columns]
    scopes = reduce(DataFrame.union, yearly).distinct() if yearly else None

    def defaults(name: str) -> None:
        if scopes is not None:
            given = tpl.SECTION_DEFAULTS[name]
            row = [F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in tpl.SECTIONS[name]]
            out[name] = scopes.select(*by, year, *row)

    for name in tpl.SECTION_ORDER:
        if name in sections:
            given = sections[name]
            if year not in given.columns and scopes is not None:
                # what holds for all years is printed in the file of each
                given = broadcast_header(scopes, given, by).filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in given.columns if c not in by]))
            keys = [c for c in [*by, year] if c in given.columns]
            out[name] = format_section(given, tpl.SECTIONS[name], keys)
            if name == "TREATMENTS":
                out[name] = treatment_defaults(out[name])
        elif name in tpl.REQUIRED_SECTIONS:
            notes.append(f"required section {name} is missing")
            defaults(name)
        elif name == "GENERAL":
            notes.append("no description of the experiment is given")
            defaults(name)
        elif name == "SIMULATION_CONTROLS":
            notes.append("simulation controls are set to their defaults")
            defaults(name)
    return {n: out[n] for n in tpl.SECTION_ORDER if n in out}, notes


def file_name(site_code: Column, year: Column, extension: Column | str) -> Column:
    ext = F.lit(extension) if isinstance(extension, str) else extension
    return F.concat(site_code, F.lpad((year % 100).cast("string"), 2, "0"), F.lit("01."), ext)


def _dates_as_codes(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: to_doy(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.DateType)})


def build_summary(observed: DataFrame, by: list[str], year: str = "Year") -> DataFrame:
    """Observed summary with dates as day-of-year codes; all columns stay."""
    first = [c for c in (*by, year, "TRTNO") if c in observed.columns]
    return _dates_as_codes(observed.select(*first, *[c for c in observed.columns if c not in first]))


def build_series(observed: DataFrame, by: list[str], year: str = "Year") -> DataFrame:
    """Observed time series with dates as day-of-year codes; all columns stay."""
    first = [c for c in (*by, year, "DATE", "TRTNO") if c in observed.columns]
    return _dates_as_codes(observed.select(*first, *[c for c in observed.columns if c not in first]))


def observed_formats(df: DataFrame, scope: list[str], known: dict[str, str]) -> dict[str, str]:
    """Print formats of all columns beside the scope: the known ones, else by type, at least six wide."""
    out = {}
    for f in df.schema:
        if f.name in scope:
            continue
        wide = max(6, len(f.name) + 1)
        kind = f"%{wide}.0f" if isinstance(f.dataType, INTEGERS) else f"%{wide}.2f" if isinstance(f.dataType, NUMBERS) else f"%{wide}s"
        out[f.name] = known.get(f.name, kind)
    return out


def build_soil(header: DataFrame, layers: DataFrame, on: list[str], order: str = "SLB") -> DataFrame:
    """Profile rows: the header of a soil repeated on its layers, layers nested by depth."""
    rows = null_safe_join(layers, header, on)
    rows = rows.withColumnsRenamed({"SCS FAMILY": "SCS_FAMILY"})
    return format_section(rows, tpl.SOIL, [c for c in on if c not in tpl.SOIL.names], [order])


def build_weather(daily: DataFrame, by: list[str], year: str = "Year") -> DataFrame:
    """Daily weather in the weather template with the date as a code."""
    shaped = T.StructType([daily.schema[c] for c in [*by, year]] + list(tpl.WEATHER))
    return _dates_as_codes(conform(daily, shaped))


def print_line(formats: dict[str, str], missing: str = "-99") -> Column:
    """All cells of a row in one fixed-width line."""
    return F.concat(*[cell(F.col(f"`{c}`"), f, missing) for c, f in formats.items()])


def header_line(formats: dict[str, str], mark: str = "@") -> str:
    """Column heads right-aligned over their cells, with the block mark in front."""
    text = "".join(c.rjust(int(f.lstrip("%-").split(".")[0].rstrip("sf"))) for c, f in formats.items())
    return mark + text[len(mark) :] if text.startswith(" ") else mark + text


def sort_key(df: DataFrame, order: list[str]) -> Column:
    """Typed sort key: numbers and dates by value, text by code point, null last."""
    parts = []
    for c in order:
        kind = df.schema[c].dataType
        number = F.col(c).cast("double") if isinstance(kind, NUMBERS) else F.lit(None).cast("double")
        if isinstance(kind, T.DateType):
            number = F.unix_date(c).cast("double")
        text = F.lit(None).cast("string") if isinstance(kind, (*NUMBERS, T.DateType)) else F.col(c).cast("string")
        parts.append(F.struct(F.col(c).isNull().alias("none"), number.alias("number"), text.alias("text")))
    return F.array(*parts).cast("array<struct<none:boolean,number:double,text:string>>")


def _line(df: DataFrame, scope: list[str], block: int, kind: int, order: list[str], line: Column) -> DataFrame:
    return df.select(*scope, F.lit(block).alias("block_no"), F.lit(kind).alias("kind"), sort_key(df, order).alias("sort"), line.alias("line"))


def _with_heads(rows: DataFrame, df: DataFrame, scope: list[str], block: int, heads: list[str]) -> DataFrame:
    """Rows with the lines above them, once per scope."""
    marks = F.explode(F.array(*[F.struct(F.lit(i - len(heads)).alias("kind"), F.lit(t).alias("line")) for i, t in enumerate(heads)])).alias("h")
    above = df.select(*scope).distinct().select(*scope, F.lit(block).alias("block_no"), marks)
    empty = sort_key(df, []).alias("sort")
    return rows.unionByName(above.select(*scope, "block_no", "h.kind", empty, "h.line"))


def present_columns(df: DataFrame, scope: list[str], columns: list[str], name: str = "present") -> DataFrame:
    """Per scope a list of bits: which of the columns hold a value there."""
    return df.groupBy(*scope).agg(F.array(*[F.count(f"`{c}`") > 0 for c in columns]).alias(name))


def text_lines(
    df: DataFrame, formats: dict[str, str], scope: list[str], order: list[str], block: int, title: str | None = None, drop_empty: bool = False
) -> DataFrame:
    """Lines of one block in columns of fixed width: (scope, block_no, kind, sort, line); heads have a negative kind.

    With ``drop_empty`` a column without any value in a scope is absent from its lines and head; the first column always stays.
    """
    have = {c: f for c, f in formats.items() if c in df.columns}
    if drop_empty and len(have) > 1:
        first, *rest = have
        known = present_columns(df, scope, rest, "__present")
        shown = [F.when(F.get("__present", F.lit(i)), cell(F.col(f"`{c}`"), have[c], "-99")).otherwise("") for i, c in enumerate(rest)]
        line = F.concat(cell(F.col(f"`{first}`"), have[first], "-99"), *shown)
        rows = _line(null_safe_join(df, known, scope), scope, block, 0, order, line)
        names = [F.when(F.get("__present", F.lit(i)), header_line({c: have[c]}, "")).otherwise("") for i, c in enumerate(rest)]
        head = known.select(*scope, F.concat(F.lit(header_line({first: have[first]})), *names).alias("head"))
        above = _line(head, scope, block, -1, [], F.col("head"))
        if title:
            above = above.unionByName(_line(head, scope, block, -2, [], F.lit(title)))
        return rows.unionByName(above)
    rows = _line(df, scope, block, 0, order, print_line(have))
    return _with_heads(rows, df, scope, block, [*([title] if title else []), header_line(have)])


def head_cells(head: str) -> list[tuple[str, int, int, bool]]:
    """Columns of a head line: name, blanks before the cell, width, whether it is left-aligned.

    A right-aligned cell reaches from the end of the name before to the end of its own name; a left-aligned one starts with
    its name and may fill the blanks before the next left-aligned one.
    """
    found = [(m.group().strip("@."), m.start(), m.end()) for m in re.finditer(r"[^\s@]\S*|@\S+", head)]
    out, last = [], 0
    for i, (name, start, end) in enumerate(found):
        left = name in tpl.LEFT_CELLS
        if left and i + 1 < len(found) and found[i + 1][0] in tpl.LEFT_CELLS:
            end = found[i + 1][1] - 1
        start = 0 if head[start] == "@" and left else start
        out.append((name, start - last, end - start, True) if left else (name, 0, end - last, False))
        last = end
    return out


def printed_cell(df: DataFrame, name: str, blanks: int, width: int, left: bool, missing: str = "-99") -> Column:
    kind = df.schema[name].dataType
    value = F.format_string(f"%.{tpl.DECIMALS.get(name, 0)}f", F.col(name).cast("double")) if isinstance(kind, NUMBERS) else F.col(name).cast("string")
    shown = F.coalesce(F.when(F.col(name).isNotNull(), value), F.lit(missing))
    pad = F.rpad if left else F.lpad
    # a value wider than its cell is printed whole
    fitted = F.when(F.length(shown) < width, pad(shown, width, " ")).otherwise(shown)
    return F.concat(F.lit(" " * blanks), fitted)


def head_lines(df: DataFrame, head: str, scope: list[str], order: list[str], block: int, title: str | None = None) -> DataFrame:
    """Lines of one block whose cells lie under the names of a fixed head; columns that ``df`` lacks are missing values."""
    cells = head_cells(head)
    full = df.withColumns({n: F.lit(None).cast("string") for n, *_ in cells if n not in df.columns})
    line = F.rtrim(F.concat(*[printed_cell(full, *c) for c in cells]))
    return _with_heads(_line(full, scope, block, 0, order, line), df, scope, block, [*([title] if title else []), head])


def layer_rows(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per layer or event of the list columns, in order, beside the ``keep`` columns."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in nested])
    lists = [F.coalesce(c, F.array().cast(df.schema[c].dataType)) for c in nested]
    zipped = F.posexplode(F.arrays_zip(*lists)).alias("layer_no", "layer")
    fields = [F.col("layer").getField(str(i)).alias(c) for i, c in enumerate(nested)]
    return df.filter(some).select(*keep, zipped).select(*keep, "layer_no", *fields)


def title_line(text: Column, df: DataFrame, scope: list[str], block: int, kind: int = 0) -> DataFrame:
    """One line per scope from an expression over ``df``."""
    return _line(df, scope, block, kind, [], text).distinct()


def management_lines(sections: dict[str, DataFrame], scope: list[str], header: DataFrame | None = None) -> DataFrame:
    """The management file: title, then every section with its heads, layers and events in a block of their own.

    ``header`` holds the title per scope (``EXP_DETAILS``). A blank line precedes every section.
    """
    parts = []
    if header is not None:
        parts.append(title_line(F.concat(F.lit("*EXP.DETAILS: "), "EXP_DETAILS"), header, scope, 0))
    block = 1
    for name in [n for n in tpl.SECTION_HEADS if n in sections]:
        df = sections[name]
        if not set(scope) <= set(df.columns):
            continue
        parts.append(title_line(F.lit(""), df, scope, block))
        dated = _dates_as_codes(df)
        heads = tpl.SECTION_HEADS[name]
        first = head_cells(heads[0])[0][0]
        order = [c for c in dict.fromkeys([first, *[c for c, *_ in head_cells(heads[0])]]) if c in df.columns and not isinstance(df.schema[c].dataType, T.ArrayType)]
        for i, head in enumerate(heads):
            block += 1
            parts.append(head_lines(dated, head, scope, order, block, tpl.SECTION_TITLES[name] if i == 0 else None))
        if name in tpl.LIST_HEADS and any(isinstance(f.dataType, T.ArrayType) for f in df.schema):
            block += 1
            index = [] if name == "GENERAL" else [first]
            layers = _dates_as_codes(layer_rows(df, [*scope, *index]))
            parts.append(head_lines(layers, tpl.LIST_HEADS[name], scope, [*index, "layer_no"], block))
        block += 1
    return reduce(DataFrame.unionByName, parts)


def observed_lines(observed: DataFrame, formats: dict[str, str], scope: list[str], header: DataFrame, kind: str) -> DataFrame:
    """An observed file: ``kind`` is A for summaries and T for time series; columns without a format get one by their type. A
    column that is empty in one scope is absent in that scope's file only."""
    title = title_line(F.concat(F.lit(f"*EXP. DATA ({kind}): "), "EXP_DETAILS"), header, scope, 0)
    blank = title_line(F.lit(""), header, scope, 1)
    order = [c for c in ("TRTNO", "DATE") if c in observed.columns]
    lines = text_lines(observed, observed_formats(observed, scope, formats), scope, [*order, *[c for c in observed.columns if c not in (*order, *scope)]], 2, drop_empty=True)
    return title.unionByName(blank).unionByName(lines)


def weather_lines(daily: DataFrame, header: DataFrame, comments: DataFrame, scope: list[str]) -> DataFrame:
    """A weather file: place, station comments, station header and the days.

    ``header``: scope, SITE, INSI, LAT, LONG, ELEV, TAV, AMP, REFHT, WNDHT; ``comments``: scope,
    comment; ``daily`` comes from :func:`build_weather`.
    """
    title = title_line(F.concat(F.lit("*WEATHER: "), "SITE"), header, scope, 0)
    notes = _line(comments, scope, 0, 1, ["comment"], F.concat(F.lit("! "), "comment"))
    station = text_lines(header, tpl.HEADER_FORMATS, scope, ["INSI"], 2)
    days = text_lines(daily, tpl.WEATHER_FORMATS, scope, ["DATE"], 4)
    blanks = [title_line(F.lit(""), header, scope, i) for i in (1, 3)]
    return reduce(DataFrame.unionByName, [title, notes, station, days, *blanks])


def soil_lines(soil: DataFrame, scope: list[str]) -> DataFrame:
    """Soil profiles: identity, site, surface and layers; ``soil`` comes from :func:`build_soil`."""
    name = F.concat(F.lit("*"), *[F.rpad(F.coalesce(c, F.lit("-99")), n, " ") for c, n in (("PEDON", 12), ("SOURCE", 13), ("TEXTURE", 6))])
    ident = F.concat(name, cell(F.col("DEPTH"), "%6.0f"), F.lit(" "), F.coalesce("DESCRIPTION", F.lit("-99")))
    parts = [title_line(ident, soil, scope, 0)]
    for i, formats in enumerate(tpl.SOIL_BLOCKS):
        once = soil.select(*scope, *[c for c in formats if c not in scope]).distinct()
        parts.append(text_lines(once, formats, scope, list(formats)[:1], i + 1))
    parts.append(text_lines(layer_rows(soil, scope), tpl.LAYER_FORMATS, scope, ["layer_no"], len(tpl.SOIL_BLOCKS) + 1))
    return reduce(DataFrame.unionByName, parts)


def by_scope(df: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """Rows placed for writing folders: each scope whole and in order in one task, scopes spread evenly.

    The number of partitions is given, as writing many small files costs time rather than bytes.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartitionByRange(n, *scope).sortWithinPartitions(*scope, *order)


def write_text(lines: DataFrame, path: str, scope: list[str], order: list[str] = ("block_no", "kind", "sort")) -> None:
    """Folders per scope, one file each, lines in order."""
    by_scope(lines, scope, list(order)).select(*scope, "line").write.mode("overwrite").partitionBy(*scope).text(path)


def write_sections(sections: dict[str, DataFrame], path: str, by: list[str], year: str = "Year") -> None:
    """Every section as parquet, foldered by scope and year where it has them."""
    for name, df in sections.items():
        keys = [c for c in [*by, year] if c in df.columns]
        if keys:
            by_scope(df, keys, []).write.mode("overwrite").partitionBy(*keys).parquet(f"{path}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
