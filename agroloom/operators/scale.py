"""Building blocks that stay balanced when one key holds a large share of the rows.

* Joins compare keys null-safely. Spark turns ``<=>`` into derived key
  expressions, so both inputs get an exchange of their own, even one that was just
  aggregated on the key; that is the shape in which the adaptive skew join can split
  a hot partition.
* Ranks and ids over all rows, or with ``spread``, never sort a whole group in one task: the rows are
  range-partitioned, counted per partition and offset.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroloom.session import checkpointed

_KEY = "__rk_"


def matching(on: list[str]) -> Column:
    """Null-safe equality of ``k`` and its renamed right twin."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(_KEY + str(i))) for i, k in enumerate(on)])


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi join in which null equals null. Right keys are dropped."""
    twins = {k: _KEY + str(i) for i, k in enumerate(on)}
    renamed = right.withColumnsRenamed(twins)
    out = left.join(renamed, matching(on), how)
    return out if how in ("left_semi", "left_anti") else out.drop(*twins.values())


def rename_join(left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str = "left") -> DataFrame:
    """Join on differently named keys (``left name -> right name``)."""
    return null_safe_join(left, right.withColumnsRenamed({r: l for l, r in pairs.items()}), list(pairs), how)


def nulls_last(cols: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def _offsets(parts: DataFrame, by: list[str]) -> DataFrame:
    """Rows before each range partition of a group (one row per partition and group)."""
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"))
    return counts.select(*by, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))


def range_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in range partitions of ``order``, numbered by ``__part``.

    The input partition comes last in the order, so that even equal rows can be cut apart; the checkpoint then fixes which row is
    in which part.
    """
    placed = df.withColumn("__in", F.spark_partition_id()).repartitionByRange(*order, F.col("__in").asc()).drop("__in")
    return checkpointed(placed.withColumn("__part", F.spark_partition_id()))


def row_numbers(df: DataFrame, by: list[str], order: list[Column], name: str, spread: bool = False) -> DataFrame:
    """1..n per group in a total order (``order`` must have no ties).

    Without a group, or with ``spread`` where a group may hold a large share of the rows, they lie in range partitions:
    number within the partition plus the rows of the partitions before. Else one window per group.
    """
    if by and not spread:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    parts = range_parts(df, [F.col(b).asc_nulls_last() for b in by] + list(order))
    local = Window.partitionBy(*by, "__part").orderBy(*order)
    numbered = parts.withColumn("__i", F.row_number().over(local))
    out = null_safe_join(numbered, _offsets(parts, by), [*by, "__part"])
    return out.withColumn(name, (F.col("__i") + F.col("__off")).cast("long")).drop("__part", "__i", "__off")


def key_ids(df: DataFrame, keys: list[str], name: str, by: list[str] = (), spread: bool = False) -> DataFrame:
    """The distinct keys with their dense ids 1..n (sorted, null last) per scope."""
    by = list(by)
    keys = [k for k in keys if k not in by]
    distinct = df.select(*by, *keys).distinct()
    if not keys:
        return distinct.withColumn(name, F.lit(1).cast("long"))
    return row_numbers(distinct, by, nulls_last(keys), name, spread)


def dense_ids(df: DataFrame, keys: list[str], name: str, by: list[str] = (), spread: bool = False) -> DataFrame:
    """Append the dense id of ``keys``: numbered on the distinct keys, then joined back."""
    by = list(by)
    ids = key_ids(df, keys, name, by, spread)
    return null_safe_join(df, ids, by + [k for k in keys if k not in by])
