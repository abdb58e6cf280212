"""Sensor observations and their metadata from landed JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.operators.scale import rename_join

OBSERVATION = T.StructType(
    [
        T.StructField("stream_id", T.LongType()),
        T.StructField("obs_id", T.LongType()),
        T.StructField("phenomenonTime", T.StringType()),
        T.StructField("result", T.StringType()),
    ]
)


def readings(raw: DataFrame) -> DataFrame:
    """Typed observations: time zone aware stamps, numbers; JSON nulls stay null."""
    return raw.select(
        "stream_id",
        "obs_id",
        F.try_to_timestamp("phenomenonTime").alias("ts"),
        F.col("result").try_cast("double").alias("value"),
    )


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return readings(spark.read.schema(OBSERVATION).json(path))


def stream_observations(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    raw = spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", files_per_batch).json(path)
    return readings(raw)


def parse_object(c: Column, schema: T.StructType) -> Column:
    """A JSON text as a struct; unreadable text gives nulls."""
    return F.from_json(c, schema)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct columns as plain columns ``outer_inner``, at any depth."""
    out = df
    while any(isinstance(f.dataType, T.StructType) for f in out.schema):
        cols = []
        for f in out.schema:
            if isinstance(f.dataType, T.StructType):
                cols += [F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}{sep}{g.name}") for g in f.dataType]
            else:
                cols.append(F.col(f"`{f.name}`"))
        out = out.select(*cols)
    return out


def stream_metadata(datastreams: DataFrame, devices: DataFrame, sensors: DataFrame, properties: DataFrame) -> DataFrame:
    """One row per datastream with its device, sensor and observed property."""
    out = datastreams
    for dim, key in ((devices, "device_id"), (sensors, "sensor_id"), (properties, "property_id")):
        prefix = key.removesuffix("_id")
        named = dim.select(F.col("id").alias(key), *[F.col(c).alias(f"{prefix}_{c}") for c in dim.columns if c != "id"])
        out = rename_join(out, named, {key: key})
    return out
