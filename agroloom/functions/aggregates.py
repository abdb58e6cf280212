"""Aggregates with the null rules of the source data model.

``nulls="poison"`` makes one missing reading blank the whole group (the default,
as the gap is filled later by interpolation); ``"skip"`` ignores missing readings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _single(c: Column) -> Column:
    """Value of a group that must hold one row."""
    many = F.raise_error(F.lit("identity aggregate over more than one row")).cast("double")
    return F.when(F.count(F.lit(1)) > 1, many).otherwise(F.max(c))


# whitelist: the mapping tables name the aggregate as text
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "identity": _single,
}


def aggregate(
    value: Column, fun: str | Callable[[Column], Column], nulls: str = "poison", where: Column | None = None
) -> Column:
    """Aggregate ``value`` by a whitelisted name or a Column -> Column callable.

    ``where`` restricts the rows, so that several long-form variables can be
    aggregated in one pass over one shuffle.
    """
    if isinstance(fun, str):
        if fun not in AGGREGATES:
            raise ValueError(f"aggregate {fun!r} is not one of {sorted(AGGREGATES)}")
        call = AGGREGATES[fun]
    else:
        call = fun
    picked = value if where is None else F.when(where, value)
    if where is not None and fun == "identity":
        n = F.count(F.when(where, F.lit(1)))
        many = F.raise_error(F.lit("identity aggregate over more than one row")).cast("double")
        out = F.when(n > 1, many).otherwise(F.max(picked))
    else:
        out = call(picked)
    if nulls == "skip":
        return out
    if nulls != "poison":
        raise ValueError("nulls must be 'poison' or 'skip'")
    rows = F.count(F.lit(1)) if where is None else F.count(F.when(where, F.lit(1)))
    return F.when(F.count(picked) == rows, out)
