"""Comparisons: simulated with observed values, and table with table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.operators.profile import NUMBERS
from agroloom.operators.scale import null_safe_join, row_numbers
from agroloom.session import checkpointed


def paired_values(sim: DataFrame, obs: DataFrame, on: list[str], variables: list[str]) -> DataFrame:
    """Long table (keys, variable, simulated, observed) for keys in both."""
    left = sim.select(*on, *[F.col(v).alias(f"__s_{v}") for v in variables])
    right = obs.select(*on, *[F.col(v).alias(f"__o_{v}") for v in variables])
    both = null_safe_join(left, right, on, "inner")
    pairs = F.array(
        *[
            F.struct(
                F.lit(v).alias("variable"),
                F.col(f"__s_{v}").cast("double").alias("simulated"),
                F.col(f"__o_{v}").cast("double").alias("observed"),
            )
            for v in variables
        ]
    )
    return both.select(*on, F.explode(pairs).alias("p")).select(*on, "p.*")


def fit_metrics(pairs: DataFrame, by: list[str] = ("variable",)) -> DataFrame:
    """Number of pairs, bias, RMSE and mean absolute error."""
    d = F.col("simulated") - F.col("observed")
    return pairs.groupBy(*by).agg(
        F.count(d).alias("n"), F.avg(d).alias("bias"), F.sqrt(F.avg(d * d)).alias("rmse"), F.avg(F.abs(d)).alias("mae")
    )


def compare_tables(a: DataFrame, b: DataFrame, on: list[str], digits: dict[str, int] | int = 0) -> DataFrame:
    """Per column: keys in both tables, differing cells, keys in one table only.

    Numbers may differ by one unit of the last printed decimal (``digits``); other values must
    be equal, null equals null.
    """
    cols = [c for c in a.columns if c in b.columns and c not in on]
    left = a.select(*on, *[F.col(c).alias(f"__a{i}") for i, c in enumerate(cols)], F.lit(True).alias("__ina"))
    right = b.select(*on, *[F.col(c).alias(f"__b{i}") for i, c in enumerate(cols)], F.lit(True).alias("__inb"))
    both = null_safe_join(left, right, on, "full")
    matched = F.col("__ina") & F.col("__inb")
    exprs = [F.count_if(matched).alias("__n"), F.count_if(F.col("__ina").isNull() | F.col("__inb").isNull()).alias("__one")]
    for i, c in enumerate(cols):
        x, y = F.col(f"__a{i}"), F.col(f"__b{i}")
        if isinstance(a.schema[c].dataType, NUMBERS) and isinstance(b.schema[c].dataType, NUMBERS):
            d = digits if isinstance(digits, int) else digits.get(c, 0)
            # half a unit of slack for the binary form of the decimals
            same = (x.isNull() & y.isNull()) | F.coalesce(F.abs(x - y) <= F.lit(1.0000001 * 10.0**-d), F.lit(False))
        else:
            same = x.eqNullSafe(y)
        exprs.append(F.count_if(matched & ~same).alias(f"__d{i}"))
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"__d{i}").alias("n_differ")) for i, c in enumerate(cols)]
    )
    return both.agg(*exprs).select(
        F.explode(rows).alias("r"), F.col("__n").alias("n_matched"), F.col("__one").alias("n_one_side")
    ).select("r.*", "n_matched", "n_one_side")


def _digest(df: DataFrame, other: DataFrame, on: list[str], cols: list[str]) -> DataFrame:
    """Rows with a hash of all compared values (``__h``) and one of another kind (``__s``); numbers of any type compare as doubles."""

    def value(c: str) -> Column:
        both = (df.schema[c].dataType, other.schema[c].dataType)
        return F.col(c).cast("double") if all(isinstance(t, NUMBERS) for t in both) else F.col(c).cast("string")

    # nulls take part by their place, or the hash would pass over them
    parts = [x for c in (*on, *cols) for x in (F.col(c).isNull(), value(c))]
    return df.withColumns({"__h": F.xxhash64(*parts), "__s": F.crc32(F.to_json(F.struct(*[value(c).alias(c) for c in (*on, *cols)])).cast("binary"))})


def compare_by_checksum(
    a: DataFrame, b: DataFrame, on: list[str], digits: dict[str, int] | int = 0, bits: int = 14, levels: int = 2
) -> DataFrame:
    """As :func:`compare_tables`, for large tables that differ in few places.

    Both tables are summed up in a hash tree: ranges of a hash of the whole row, with the number of rows, the sum and the exclusive or
    of their digests, first ``2 ** bits`` ranges, then as many below each one that differs. Only rows of differing
    ranges are joined cell by cell, so equal tables cost one narrow aggregate and no join. A key with many rows is spread by
    its values. Rows that share a key are paired in the order of their values, each with one row at most.
    """
    on = list(on)
    cols = [c for c in a.columns if c in b.columns and c not in on]
    left, right = _digest(a.select(*on, *cols), b, on, cols), _digest(b.select(*on, *cols), a, on, cols)
    same_rows = None
    for level in range(levels):
        cell = F.shiftrightunsigned("__h", 64 - bits * (level + 1)).alias("__cell")
        sides = left.select(cell, "__h", "__s", F.lit(1).alias("__w")).unionByName(right.select(cell, "__h", "__s", F.lit(-1).alias("__w")))
        sums = sides.groupBy("__cell").agg(
            F.sum("__w").alias("n"), F.bit_xor("__h").alias("x"), F.sum(F.col("__w") * F.col("__s")).alias("s"), F.count_if(F.col("__w") > 0).alias("rows")
        )
        differs = (F.col("n") != 0) | (F.col("x") != 0) | (F.col("s") != 0)
        # a row per range: bounded by the tree, not by the tables
        sums = checkpointed(sums.select("__cell", "rows", differs.alias("differs")))
        equal = sums.agg(F.coalesce(F.sum(F.when(~F.col("differs"), F.col("rows"))), F.lit(0).cast("long")).alias("n")).scalar()
        same_rows = equal if same_rows is None else same_rows + equal
        open_ = sums.where("differs").select("__cell")
        left, right = (x.withColumn("__cell", cell).join(open_, "__cell", "left_semi").drop("__cell") for x in (left, right))
    order = [F.col("__h").asc(), F.col("__s").asc()]
    paired = [row_numbers(x, on, order, "__nth", spread=True).drop("__h", "__s") for x in (left, right)]
    found = compare_tables(*paired, [*on, "__nth"], digits)
    return found.withColumn("n_matched", F.col("n_matched") + same_rows)


def midpoints(params: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Middle of the smallest and largest value of each parameter."""
    return params.groupBy(*by).agg(*[((F.min(c) + F.max(c)) / 2).alias(c) for c in columns])


def section_dates(sections: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """Earliest date and number of years over every ``*DAT*`` column of all sections."""
    parts = []
    for df in sections.values():
        cols = [c for c in df.columns if "DAT" in c and c not in by]
        if cols:
            days = F.array(*[F.col(c).cast("date") for c in cols])
            parts.append(df.select(*by, F.explode(days).alias("d")).filter("d IS NOT NULL"))
    if not parts:
        raise ValueError("no section has a date column")
    days = parts[0]
    for p in parts[1:]:
        days = days.unionByName(p)
    return days.groupBy(*by).agg(F.min("d").alias("first_date"), F.count_distinct(F.year("d")).alias("n_years"))
