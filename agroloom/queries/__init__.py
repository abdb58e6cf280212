"""Registered queries over the given tables, each next to the SQL that gives the same rows.

Where the tables lack a shape (gaps, coordinates, a design), the query derives it from the rows
by a rule that SQL can repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of :class:`Tables` under its name, with its SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


from agroloom.queries import (  # noqa: E402,F401
    exports,
    ids,
    joins,
    landed,
    mappings,
    profiles,
    trials,
    weather,
)
