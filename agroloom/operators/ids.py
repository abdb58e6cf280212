"""Ids, event numbers and flags that depend on order inside a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroloom.operators.scale import null_safe_join, nulls_last, row_numbers


def event_numbers(df: DataFrame, group: list[str], date: str, tie: list[str], name: str = "event_no") -> DataFrame:
    """1..n per group by date; ``tie`` columns make the order total."""
    order = [F.col(date).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie]
    return row_numbers(df, group, order, name, spread=True)


def latest_flag(df: DataFrame, group: list[str], date: str, name: str = "is_latest") -> DataFrame:
    """True on the last date of the group, false on earlier ones, null on a null date.

    The last date comes from a grouped maximum, so no group is sorted.
    """
    last = df.groupBy(*group).agg(F.max(date).alias("__max_date"))
    out = null_safe_join(df, last, group)
    return out.withColumn(name, F.col(date) == F.col("__max_date")).drop("__max_date")


def previous_year_value(df: DataFrame, group: list[str], year: str, value: str, name: str) -> DataFrame:
    """Value of the row exactly one year before, else null (one row per group and year).

    A self join on the shifted year instead of a window: no order inside the group is needed.
    """
    before = df.select(*group, (F.col(year) + 1).alias(year), F.col(value).alias(name))
    return null_safe_join(df, before, [*group, year])


def reset_ids(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Shift positive ids so that the smallest non-zero id of the scope is 1; zero stays."""
    by = list(by)
    lows = {f"__min_{c}": F.min(F.when(F.col(c) != 0, F.col(c))) for c in columns}
    if by:
        out = null_safe_join(df, df.groupBy(*by).agg(*[v.alias(k) for k, v in lows.items()]), by)
    else:
        out = df.withColumns({k: df.agg(v).scalar() for k, v in lows.items()})

    def shifted(c: str) -> Column:
        return F.when(F.col(c) > 0, F.col(c) - F.col(f"__min_{c}") + 1).otherwise(F.col(c))

    return out.withColumns({c: shifted(c) for c in columns}).drop(*[f"__min_{c}" for c in columns])


def management_ids(
    df: DataFrame, flags: DataFrame, factors: list[str], name: str, by: list[str] = (), year: str = "Year", used: str | None = None
) -> DataFrame:
    """Id of a management record: factor ids joined by ``_`` in treatment years, else the year id.

    ``flags`` holds (scope, year, is_trt) and, with ``used``, the names of the factors that a scope has. All ids are ranks on the distinct (scope, year, factors), which meet
    the rows in one join.
    """
    by = list(by)
    levels = [f for f in factors if f not in (*by, year)]
    keys = df.select(*by, year, *levels).distinct()
    keys = null_safe_join(keys, flags.select(*by, year, "is_trt", *([used] if used else [])), [*by, year])

    def rank(*cols: str) -> Column:
        order = nulls_last([c for c in dict.fromkeys(cols) if c not in by])
        return F.dense_rank().over(Window.partitionBy(*by).orderBy(*order)).cast("string")

    parts = [F.when(F.array_contains(used, f), rank(year, f)) if used else rank(year, f) for f in factors]
    value = F.when(F.col("is_trt"), F.concat_ws("_", *parts)).otherwise(rank(year))
    return null_safe_join(df, keys.withColumn(name, value).drop("is_trt", *([used] if used else [])), [*by, year, *levels])


def sequence_ids(df: DataFrame, order: list[str], name: str, by: list[str] = (), spread: bool = True) -> DataFrame:
    """1..n in the order of explicit key columns; ``spread=False`` for scopes with few rows."""
    return row_numbers(df, list(by), nulls_last(order), name, spread)


def first_row(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first row per group by key order: a grouped minimum of a struct, no sort."""
    rest = [c for c in df.columns if c not in group]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    # nulls sort first in a struct comparison; the order columns are keys and not null
    return df.groupBy(*group).agg(F.min(packed).alias("s")).select(*group, "s.*").select(*df.columns)

