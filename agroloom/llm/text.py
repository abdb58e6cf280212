"""Helpers shared by the corpus operators: bounded Arrow slices, words, ragged arrays."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about ``most`` bytes of ``column`` (one row at least)."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The text column with nulls as empty texts."""
    return pc.fill_null(batch.column(column), "")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, and how many each text has."""
    split = pc.ascii_split_whitespace(texts)
    flat, parents = split.flatten(), pc.list_parent_indices(split).to_numpy()
    some = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(some, min_count=0).as_py():
        parents, flat = parents[some.to_numpy(zero_copy_only=False)], flat.filter(some)
    return flat, np.bincount(parents, minlength=len(texts)).astype(np.int64)


def listed(array: pa.Array) -> list:
    """The strings of an array; much faster than ``to_pylist``."""
    return array.to_numpy(zero_copy_only=False).tolist()


def joined(words: pa.Array) -> bytes:
    """All words in one buffer, a space between them."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(whole, " ")[0].as_buffer().to_pybytes()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``starts[i] .. starts[i] + lengths[i]`` one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def sums_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each row's run of ``values``; rows without any get 0."""
    ends = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    last = np.cumsum(counts)
    return ends[last] - ends[last - counts]


# Names that results and helper columns of the row stages have.
HELPERS = frozenset("id host hash kept group_size ties text_sha256 keep_id text_hash root taken size part epochs parts words".split())


def own_columns(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """For functions from documents to some of their rows: columns of the caller that are called like a helper column travel under
    other names and come back under their own."""

    @wraps(fn)
    def run(docs: DataFrame) -> DataFrame:
        clash = {c: f"own {i}" for i, c in enumerate(docs.columns) if c.lower() in HELPERS or c.startswith("__")}
        return fn(docs.withColumnsRenamed(clash)).toDF(*docs.columns) if clash else fn(docs)

    return run


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package once per application; Spark copies the file to each of them."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    package = os.path.join(tempfile.mkdtemp(prefix="agroloom-"), "agroloom.zip")
    with zipfile.ZipFile(package, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(package)
    _SHIPPED.add(app)


BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20), str(8 << 20)


def small_batches(spark: SparkSession) -> None:
    """Batches of 8 MB between Spark and its Python workers, unless the session has its own limit: texts are long, and
    several batches are in memory on both sides at once."""
    if spark.conf.get(BATCH_KEY).rstrip("b") == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def map_arrow(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors, also for column names that need quotes."""
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    if isinstance(schema, str) or not any("." in c or "`" in c for c in df.columns):
        return df.mapInArrow(fn, schema)
    plain = {c: re.sub("[.`]", "\u2024", c) for c in df.columns}
    inner = T.StructType([T.StructField(plain.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])
    return df.toDF(*plain.values()).mapInArrow(fn, inner).toDF(*schema.names)
