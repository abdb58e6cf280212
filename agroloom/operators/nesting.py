"""Lists in cells: nesting, unnesting and joined text.

The nested forms make one cell of a group and are for groups that are small by nature, as the layers of a soil. Lists of any length stay
long: numbered items, and cells in pieces of bounded size that only a printer puts together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.operators.scale import nulls_last, row_numbers

PIECE_ITEMS = 1000  # items of a cell that are put together in one row


def collapse_columns(df: DataFrame, columns: list[str], order: list[str], by: list[str] | None = None) -> DataFrame:
    """Nest ``columns`` into one array of structs (``items``) per combination of the rest.

    Structs keep the columns aligned and keep nulls; ``order`` gives the position of an item (null last), and the nested
    columns break ties, so that a list comes out the same on every run.
    """
    group = by if by is not None else [c for c in df.columns if c not in columns]
    sort = list(dict.fromkeys([*order, *columns]))
    place = F.struct(*[x for i, c in enumerate(sort) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])
    cell = F.array_sort(F.collect_list(F.struct(place.alias("place"), *[F.col(c) for c in columns])))
    nested = df.groupBy(*group).agg(cell.alias("items"))
    return nested.withColumn("items", F.transform("items", lambda s: F.struct(*[s[c].alias(c) for c in columns])))


def unnest(df: DataFrame, column: str = "items") -> DataFrame:
    """One row per item of an array of structs; rows with an empty list stay, with nulls."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode_outer(column).alias("__item")).select(*rest, "__item.*")


def zip_lists(df: DataFrame, columns: list[str]) -> DataFrame:
    """Unnest several list columns in step."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.explode_outer(F.arrays_zip(*columns)).alias("__item")).select(*rest, "__item.*")


def joined_text(df: DataFrame, by: list[str], column: str, name: str = "text", sep: str = "; ") -> DataFrame:
    """Distinct non-null values of a group in sorted order as one text."""
    values = df.select(*by, column).filter(F.col(column).isNotNull()).distinct()
    return values.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(column)), sep).alias(name))


def numbered_items(df: DataFrame, columns: list[str], order: list[str], by: list[str], name: str = "number") -> DataFrame:
    """The items of :func:`collapse_columns` one per row, with their place in the list (1..n).

    The places come from range partitions, so a group may hold any share of the rows.
    """
    sort = list(dict.fromkeys([*order, *columns]))
    return row_numbers(df.select(*by, *columns), list(by), nulls_last(sort), name, spread=True)


def list_pieces(items: DataFrame, columns: list[str], by: list[str], name: str = "number", most: int = PIECE_ITEMS) -> DataFrame:
    """Numbered items as lists of at most ``most`` (``items``), with the place of the piece (``piece``, from 0)."""
    placed = items.withColumn("piece", F.floor((F.col(name) - 1) / most))
    cell = F.array_sort(F.collect_list(F.struct(F.col(name).alias("at"), F.struct(*columns).alias("v"))))
    return placed.groupBy(*by, "piece").agg(F.transform(cell, lambda x: x["v"]).alias("items"))


def text_pieces(df: DataFrame, by: list[str], column: str, name: str = "text", sep: str = "; ", most: int = PIECE_ITEMS) -> DataFrame:
    """:func:`joined_text` in pieces: a group's texts in the order of ``piece``, one after the other, are its whole text."""
    values = df.select(*by, column).filter(F.col(column).isNotNull()).distinct()
    pieces = list_pieces(numbered_items(values, [column], [column], by), [column], by, most=most)
    text = F.array_join(F.transform("items", lambda x: x[column].cast("string")), sep)
    return pieces.select(*by, "piece", F.concat(F.when(F.col("piece") > 0, sep).otherwise(""), text).alias(name))
