"""Continuous daily statistics of sensor readings.

A batch run of :func:`agroloom.operators.weather.daily_stats` over the landed files corrects days
that received readings later than the watermark allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agroloom.operators.scale import null_safe_join


def deduplicated(readings: DataFrame, key: list[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Each observation id once, remembered for as long as the watermark needs."""
    timed = readings.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def daily_stats_stream(readings: DataFrame, by: list[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Daily minimum, maximum, mean and count; a day is emitted once when the watermark passes it.

    ``readings`` must carry a watermark on ``ts``.
    """
    return (
        readings.groupBy(F.window(ts, "1 day"), *by)
        .agg(
            F.min(value).alias("TMIN"), F.max(value).alias("TMAX"), F.avg(value).alias("TMEAN"), F.count(value).alias("n")
        )
        .select(*by, F.to_date("window.start").alias("day"), "TMIN", "TMAX", "TMEAN", "n")
    )


def with_metadata(stream: DataFrame, metadata: DataFrame, on: list[str]) -> DataFrame:
    """Stream-static join with the device metadata."""
    return null_safe_join(stream, metadata, on)


def write_stream(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process everything available, then stop. Files and state commit together per batch."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
