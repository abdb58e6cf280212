"""Quality rules with the frequency of lines across the documents of a host."""

from __future__ import annotations

from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.llm.text import map_arrow, own_columns, slices, sums_by_row, texts_of, words_of
from agroloom.operators.scale import null_safe_join
from agroloom.session import checkpointed

SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
LINE_DOCUMENTS = 10  # a line goes if more documents of its host than this have it,
LINE_SHARE = 0.1  # and more than this share of them
CLEAN_SHARE = 0.01  # out of a text a line goes if more than LINE_DOCUMENTS have it, and more than this share of the host's,
CLEAN_MOST = 100  # or more documents than this, however large the host is
REMAINING_SHARE = 0.2  # a document with fewer of its words left is rejected

_MEASURED = (
    "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<hash:long,words:long>>"
)
_LINES = pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int64())]))


def equal_windows(ids: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` ids inside a row, sorted so that equal windows of a row lie together, and
    whether each equals the one before it. Exact: hashes order the windows, the ids decide."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, bool)
    starts = np.flatnonzero(row[:n] == row[size - 1 :])
    if not len(starts):
        return starts, np.empty(0, bool)
    mixed = row[starts].astype(np.uint64)
    for j in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[starts + j].astype(np.uint64)
        mixed ^= mixed >> np.uint64(29)
    by = np.argsort(mixed, kind="stable")
    starts, mixed = starts[by], mixed[by]
    near = mixed[1:] == mixed[:-1]
    same = near & (row[starts[1:]] == row[starts[:-1]])
    for j in range(size):
        same &= ids[starts[1:] + j] == ids[starts[:-1] + j]
    if (near != same).any():  # two windows share a hash: order by the ids themselves
        by = np.lexsort([ids[starts + j] for j in range(size)] + [row[starts]])
        starts = starts[by]
        same = row[starts[1:]] == row[starts[:-1]]
        for j in range(size):
            same &= ids[starts[1:] + j] == ids[starts[:-1] + j]
    return starts, np.concatenate(([False], same))


def covered_words(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of ``starts``."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + size, -1)
    return np.cumsum(steps[:-1]) > 0


def repeated_words(flat: pa.Array, counts: np.ndarray) -> np.ndarray:
    """Words of each text in 5-word windows that it has at least twice."""
    ids = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    starts, same = equal_windows(ids, row, WINDOW)
    twice = same | np.append(same[1:], False) if len(same) else same
    return sums_by_row(covered_words(len(ids), starts[twice], WINDOW).astype(np.int64), counts)


def line_hash(normal: bytes) -> int:
    return xxhash.xxh64_intdigest(normal) - (1 << 63)


def lines_of(text: str) -> tuple[int, list[tuple[int, int]]]:
    """Lines equal to an earlier one, and (hash, words) of each distinct normalised line.

    Lines without a word don't count. Normalised: words joined by one space, A-Z in lower case.
    """
    seen, repeats = set(), 0
    words: dict[bytes, int] = {}
    for line in text.encode().split(b"\n"):
        parts = line.split()
        if parts:
            repeats += line in seen
            seen.add(line)
            key = b" ".join(parts).lower()
            words[key] = words.get(key, 0) + len(parts)
    return repeats, [(line_hash(k), n) for k, n in words.items()]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = texts_of(part, "text")
            flat, counts = words_of(texts)
            lines = [lines_of(t) for t in texts.to_pylist()]
            found = [
                part.column("doc_id"),
                part.column("host"),
                part.column("text_hash"),
                pa.array(counts, pa.int64()),
                pa.array(sums_by_row(pc.utf8_length(flat).to_numpy().astype(np.int64), counts), pa.int64()),
                pc.count_substring_regex(texts, SYMBOLS).cast(pa.int64()),
                pa.array([r for r, _ in lines], pa.int64()),
                pa.array(repeated_words(flat, counts), pa.int64()),
                pa.array([[{"hash": h, "words": n} for h, n in x] for _, x in lines], _LINES),
            ]
            names = [f.split()[0] for f in _MEASURED.split(", ")]
            yield pa.RecordBatch.from_arrays(found, names)


def measured(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """One row per document with its base counts and distinct lines; no shuffle."""
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return map_arrow(rows, _measure, _MEASURED)


def common_lines(rows: DataFrame, share: float = LINE_SHARE, most: int | None = None) -> DataFrame:
    """host, hash of the lines in more than LINE_DOCUMENTS documents, and in more than the share of their host's or in more than
    ``most``. Documents with equal texts count as one, so copies don't make their own lines common."""
    texts = rows.groupBy("host", "text_hash").agg(F.any_value("lines").alias("lines"))
    hosts = texts.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    counts = texts.select("host", F.explode("lines.hash").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where(F.col("n") > LINE_DOCUMENTS)
    above = F.col("n") > share * F.col("documents")
    if most is not None:
        above |= F.col("n") > most
    return null_safe_join(counts, hosts, ["host"], "inner").where(above).select("host", "hash")


def frequent_lines(rows: DataFrame) -> DataFrame:
    """host, common: hashes of the lines above the limits; one row per host that has any.

    A host's list is short: each of its lines is in a tenth of the documents, so it has at most ten times as many as its
    documents have on average.
    """
    return common_lines(rows).groupBy("host").agg(F.collect_list("hash").alias("common"))


def judged(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """doc_id, text_hash, the counts, base_failed, n_common_words and kept of every row.

    Null and empty texts have no words and fail. A null host is a host of its own. Repeated rows get equal verdicts.
    """
    rows = checkpointed(measured(docs, key, host, text))
    rows = null_safe_join(rows, frequent_lines(rows), ["host"])
    common = F.filter("lines", lambda x: F.array_contains("common", x["hash"]))
    removed = F.aggregate(common, F.lit(0).cast("long"), lambda n, x: n + x["words"])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = rows.withColumns({"n_common_words": F.coalesce(removed, F.lit(0)), "base_failed": failed})
    depleted = F.col("n_words") - F.col("n_common_words") < REMAINING_SHARE * F.col("n_words")
    return rows.withColumn("kept", ~F.col("base_failed") & ~depleted)


def rule_verdicts(docs: DataFrame) -> DataFrame:
    """The digest columns of every document, with n_common_words."""
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_common_words", "kept"
    )


@own_columns
def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns (whatever they are called) and whole texts. Repeated rows
    share a verdict; an empty table stays empty."""
    good = judged(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("host").alias("__host"), F.col("text_hash").alias("__hash"))
    marked = docs.withColumns(
        {"__id": F.col("doc_id").cast("long"), "__host": F.col("source").cast("string"), "__hash": F.coalesce(F.xxhash64("text"), F.lit(0))}
    )
    out = null_safe_join(marked, good.distinct(), ["__id", "__host", "__hash"], "left_semi")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _distinct_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            lines = [[{"hash": h, "words": n} for h, n in lines_of(t)[1]] for t in texts_of(part, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("host"), part.column("text_hash"), pa.array(lines, _LINES)], ["host", "text_hash", "lines"])


def without_lines(text: str, common: Container[int]) -> tuple[str, int, int]:
    """The text without its lines whose hash is common, how many these are and how many words they have. The other lines
    stay as they are."""
    left, lines, words = [], 0, 0
    for line in text.split("\n"):
        parts = line.encode().split()
        if parts and line_hash(b" ".join(parts).lower()) in common:
            lines, words = lines + 1, words + len(parts)
        else:
            left.append(line)
    return "\n".join(left) if lines else text, lines, words


COMMON_LINES = 1 << 20  # up to so many pairs of host and line go to every task


def clean_texts(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """doc_id, kept, n_removed_lines and the text without the common lines of its host, of every row.

    What counts as common doesn't loosen with the size of the host (``CLEAN_MOST``), unlike in ``judged``. Null texts become
    empty ones. Not kept: what fails the base rules or has too few of its words left. Texts only move where the common lines
    are too many to broadcast.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"),
        F.col(text).alias("text"),
    )
    lines = checkpointed(map_arrow(rows.select("host", "text_hash", "text"), _distinct_lines, f"host string, text_hash long, {_MEASURED.split(', ')[-1]}"))
    common = checkpointed(common_lines(lines, CLEAN_SHARE, CLEAN_MOST))
    shared = None
    if common.count() <= COMMON_LINES:
        by_host: dict[str | None, set[int]] = {}
        for r in common.collect():
            by_host.setdefault(r["host"], set()).add(r["hash"])
        shared = docs.sparkSession.sparkContext.broadcast(by_host)
    else:
        found = lines.select("host", "text_hash", F.explode("lines.hash").alias("hash"))
        found = null_safe_join(found, common, ["host", "hash"], "left_semi").groupBy("host", "text_hash").agg(F.collect_set("hash").alias("common"))
        rows = null_safe_join(rows, found, ["host", "text_hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part, "text")
                flat, counts = words_of(texts)
                if shared is None:
                    lists = map(set, (x or () for x in part.column("common").to_pylist()))
                else:
                    lists = (shared.value.get(h, ()) for h in part.column("host").to_pylist())
                out = [without_lines(t, c) if c else (t, 0, 0) for t, c in zip(texts.to_pylist(), lists)]
                removed = np.array([w for _, _, w in out], np.int64)
                failed = (counts < LEAST_WORDS) | (100 * repeated_words(flat, counts) > REPEAT_PERCENT * counts)
                kept = ~failed & (counts - removed >= REMAINING_SHARE * counts)
                arrays = [part.column("doc_id"), pa.array(kept), pa.array([n for _, n, _ in out], pa.int64()), pa.array([t for t, _, _ in out], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "kept", "n_removed_lines", "text"])

    return map_arrow(rows, run, "doc_id long, kept boolean, n_removed_lines long, text string")
