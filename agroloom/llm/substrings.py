"""Substring dedup with super-k-mers.

A window of 20 words goes to the bucket of its minimiser, the least hash of the 3-word sequences inside it. Consecutive
windows with the same minimiser travel as one packed string; a task sends the strings of a bucket in compressed blocks. A
window's text alone decides its bucket, so equal windows meet, and sorting the windows of a bucket shows exactly which of them
start earlier elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.llm.text import joined, listed, map_arrow, ragged, slices, texts_of, words_of
from agroloom.operators.scale import null_safe_join
from agroloom.session import checkpointed

WINDOW = 20
MINIMISER = 3
RUN = 256  # windows in one packed string at most
BUCKET_BYTES = 2_600_000  # text bytes per bucket; its packed strings are about three times as long
BUCKETS = 256  # buckets at least
BUCKET_WINDOWS = 3_000_000  # windows of a bucket that a task sorts; beyond, each of its windows goes on its own
SLICE = 4 << 20  # text bytes whose strings a task packs together

_PACKED = "bucket long, doc_id long, text_hash long, first long, until long, block binary"
_FOUND = "doc_id long, text_hash long, first long, until long, packed string"


def _batch(columns: list, ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def word_hashes(flat: pa.Array) -> np.ndarray:
    coded = flat.dictionary_encode()
    digest = xxhash.xxh64_intdigest
    words = listed(coded.dictionary)
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))[coded.indices.to_numpy()]


def minimisers(hashes: np.ndarray) -> np.ndarray:
    """Least mixed hash of the 3-word sequences in the window that starts at each word (ends are cut off)."""
    n = len(hashes) - MINIMISER + 1
    mixed = np.zeros(max(n, 0), np.uint64)
    for j in range(MINIMISER):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
        mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    width, have = WINDOW - MINIMISER + 1, 1
    while have < width:  # least of ever longer stretches
        step = min(have, width - have)
        mixed = np.minimum(mixed[:-step], mixed[step:]) if len(mixed) > step else mixed[:0]
        have += step
    return mixed


def _block(ids: np.ndarray, texts: np.ndarray, first: np.ndarray, packed: list[bytes]) -> bytes:
    head = b"".join(x.astype(np.int64).tobytes() for x in (np.array([len(packed)]), ids, texts, first))
    return zstandard.ZstdCompressor(level=5).compress(head + b"\n".join(packed))


def _unpacked(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """doc_id, text_hash, first and packed string of all blocks."""
    places, packed = [[], [], []], []
    for block in blocks:
        raw = zstandard.ZstdDecompressor().decompress(block)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        for i, column in enumerate(places):
            column.append(np.frombuffer(raw, np.int64, n, 8 + 8 * n * i))
        packed += raw[8 + 24 * n :].split(b"\n")
    return *(np.concatenate(x) for x in places), pa.array(packed, pa.binary()).cast(pa.string())


def super_kmers(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of packed strings. Where a slice of the input has a string twice only the earliest travels; the others are known
    to repeat it and go on as found stretches (``until`` is set, ``block`` is null)."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            flat, counts = words_of(texts_of(part, "text"))
            if len(flat) < WINDOW:
                continue
            row = np.repeat(np.arange(len(counts)), counts)
            least = minimisers(word_hashes(flat))
            starts = np.flatnonzero(row[: len(least)] == row[WINDOW - 1 :])
            if not len(starts):
                continue
            value, owner = least[starts], row[starts]
            new = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
            place = np.arange(len(starts)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            new |= place % RUN == 0
            heads = np.flatnonzero(new)
            sizes = np.diff(np.append(heads, len(starts)))
            raw = joined(flat)
            ends = np.cumsum(pc.binary_length(flat).to_numpy().astype(np.int64) + 1) - 1
            begins = np.concatenate(([0], ends[:-1] + 1))
            a = starts[heads]
            left, right = begins[a].tolist(), ends[a + sizes + WINDOW - 2].tolist()
            ids = pc.fill_null(part.column("doc_id"), 2**63 - 1).to_numpy()[owner[heads]]
            texts = part.column("text_hash").to_numpy()[owner[heads]]
            first = a - (np.cumsum(counts) - counts)[owner[heads]]
            packed = [raw[x:y] for x, y in zip(left, right)]
            seen: dict[bytes, int] = {}
            by = np.lexsort((first, texts, ids))
            before = np.fromiter((seen.setdefault(packed[i], i) for i in by.tolist()), np.int64, len(by))
            travel = by[before == by]
            late, lead = by[before != by], before[before != by]
            late = late[(ids[late] != ids[lead]) | (texts[late] != texts[lead]) | (first[late] != first[lead])]  # not the same row
            spread = (ids[late] ^ first[late]) % buckets
            yield _batch([spread, ids[late], texts[late], first[late], first[late] + sizes[late] + WINDOW - 1, [None] * len(late)], _PACKED)
            bucket = (value[heads[travel]] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            travel, bucket = travel[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            groups = np.split(travel, cuts)
            blocks = [_block(ids[g], texts[g], first[g], [packed[i] for i in g.tolist()]) for g in groups]
            none = [None] * len(blocks)
            yield _batch([bucket[np.append(0, cuts)], none, none, none, none, blocks], _PACKED)


def first_windows(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For windows in the order of their places: whether no equal window comes earlier. Exact: hashes sort, words decide."""
    mixed = np.zeros(len(starts), np.uint64)
    for j in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + words[starts + j].astype(np.uint64)
        mixed ^= mixed >> np.uint64(29)
    by = np.argsort(mixed, kind="stable")
    after = np.flatnonzero(mixed[by][1:] == mixed[by][:-1])
    same = np.ones(len(after), bool)
    for j in range(WINDOW):
        same &= words[starts[by[after]] + j] == words[starts[by[after + 1]] + j]
    first = np.ones(len(starts), bool)
    if same.all():
        first[by[after + 1]] = False
    else:  # different windows share a hash
        matrix = words[starts[:, None] + np.arange(WINDOW)]
        first[:] = False
        first[np.unique(matrix, axis=0, return_index=True)[1]] = True
    return first


def stretches(first: np.ndarray, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of repeated windows of a packed string: its row, first word and the word after the last."""
    rep = np.flatnonzero(~first)
    if not len(rep):
        return rep, rep, rep
    new = np.concatenate(([True], (row[rep][1:] != row[rep][:-1]) | (at[rep][1:] != at[rep][:-1] + 1)))
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(rep)) - 1
    return row[rep][heads], at[rep][heads], at[rep][tails] + WINDOW


def _sorted_out(blocks: list[bytes]) -> pa.RecordBatch:
    """Repeated windows of a complete bucket."""
    ids, texts, first, packed = _unpacked(blocks)
    by = np.lexsort((first, texts, ids))
    again = (np.diff(ids[by]) == 0) & (np.diff(texts[by]) == 0) & (np.diff(first[by]) == 0)
    by = by[np.concatenate(([True], ~again))]  # repeated rows are one document
    ids, texts, first = ids[by], texts[by], first[by]
    flat, counts = words_of(packed.take(pa.array(by)))
    words = flat.dictionary_encode().indices.to_numpy()
    sizes = counts - WINDOW + 1
    starts = ragged(np.cumsum(counts) - counts, sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    owner, a, b = stretches(first_windows(words, starts), row, ragged(first, sizes))
    return _batch([ids[owner], texts[owner], a, b, [None] * len(owner)], _FOUND)


def _single_windows(block: bytes) -> pa.RecordBatch:
    """Each window of a block on its own, to be counted by its text."""
    out: tuple[list, ...] = ([], [], [], [], [])
    ids, texts, first, packed = _unpacked([block])
    for i, t, at, text in zip(ids.tolist(), texts.tolist(), first.tolist(), packed.to_pylist()):
        words = text.split(" ")
        for j in range(len(words) - WINDOW + 1):
            for column, x in zip(out, (i, t, at + j, at + j + WINDOW, " ".join(words[j : j + WINDOW]))):
                column.append(x)
    return _batch(list(out), _FOUND)


def bucket_sort(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket. A complete bucket is sorted out in one go; the windows of one that has more than ``most``
    go on one by one; found stretches pass."""
    here, held, size, large = None, [], 0, False
    for batch in batches:
        found = batch.filter(pc.is_valid(batch.column("until")))
        if found.num_rows:
            yield _batch([*(found.column(c) for c in ("doc_id", "text_hash", "first", "until")), [None] * found.num_rows], _FOUND)
        blocks = batch.filter(pc.is_valid(batch.column("block")))
        for bucket, block in zip(blocks.column("bucket").to_pylist(), blocks.column("block")):
            if bucket != here:
                if held:
                    yield _sorted_out(held)
                here, held, size, large = bucket, [], 0, False
            block = block.as_py()
            if large:
                yield _single_windows(block)
                continue
            held.append(block)
            raw = zstandard.frame_content_size(block)
            size += raw // 22  # a window has about this many packed bytes
            if size > most:
                yield from map(_single_windows, held)
                held, large = [], True
    if held:
        yield _sorted_out(held)


def bucket_count(rows: DataFrame) -> int:
    """Enough buckets for the text's bytes, so that one is sorted in bounded memory at any size."""
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(BUCKETS, total // BUCKET_BYTES)


def repeated_stretches(rows: DataFrame, buckets: int | None = None, most: int = BUCKET_WINDOWS) -> DataFrame:
    """doc_id, text_hash, first, until: words covered by windows that also start earlier. ``rows``: doc_id, text_hash, text.

    ``buckets`` and ``most`` bound a task's memory and don't change the result.
    """
    n = buckets or bucket_count(rows)
    kmers = map_arrow(rows, lambda batches: super_kmers(batches, n), _PACKED)
    dealt = kmers.repartition("bucket").sortWithinPartitions("bucket")
    found = checkpointed(map_arrow(dealt, lambda batches: bucket_sort(batches, most), _FOUND))
    ready = found.where("packed is null").drop("packed")
    single = found.where("packed is not null").withColumn("place", F.struct("doc_id", "text_hash", "first"))
    earliest = single.groupBy("packed").agg(F.min("place").alias("earliest"))
    late = null_safe_join(single, earliest, ["packed"], "inner").where("place > earliest")
    return ready.unionByName(late.select("doc_id", "text_hash", "first", "until"))


def _strip(text: str):
    """Rows with their stretches to kept text and counts; other columns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                flat, counts = words_of(texts_of(part, text))
                last = np.cumsum(counts)
                gone = np.zeros(len(flat) + 1, np.int32)
                for i, found in enumerate(part.column("__gone").to_pylist()):
                    for x in found or ():
                        gone[int(last[i] - counts[i]) + x["first"]] += 1
                        gone[int(last[i] - counts[i]) + x["until"]] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                ends = np.concatenate(([0], np.cumsum(stay)))
                kept = ends[last] - ends[last - counts]
                words = listed(flat.filter(pa.array(stay)))
                upto = np.cumsum(kept)
                texts = [" ".join(words[b - n : b]) for n, b in zip(kept.tolist(), upto.tolist())]
                names = [n for n in part.schema.names if n not in (text, "__gone")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(counts), pa.array(counts - kept), pa.array(texts, pa.string())],
                    [*names, "n_words", "n_removed", "kept_text"],
                )

    return run


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None, most: int = BUCKET_WINDOWS) -> DataFrame:
    """All rows of ``df`` with n_words, n_removed and kept_text in place of the text.

    A word goes if a window of 20 words over it also starts earlier: in a smaller key, in the same document, or (of rows
    with the same key) in a smaller text hash. Rows equal in key and text are one document. Null keys come last;
    null and empty texts have no words. Columns called n_words, n_removed or kept_text are replaced.
    """
    df = df.drop("n_words", "n_removed", "kept_text", "__gone")
    place = F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1))
    hashed = F.coalesce(F.xxhash64(text), F.lit(0))
    whole = df.select(place.alias("doc_id"), hashed.alias("text_hash"), F.col(text).alias("text"))
    found = repeated_stretches(whole, buckets, most)
    gone = found.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    gone = gone.agg(F.collect_list(F.struct("first", "until")).alias("__gone"))
    rows = null_safe_join(df.withColumns({"__id": place, "__hash": hashed}), gone, ["__id", "__hash"]).drop("__id", "__hash")
    fields = [f for f in rows.schema.fields if f.name not in (text, "__gone")]
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    return map_arrow(rows, _strip(text), T.StructType([*fields, *added]))


def substring_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    out = without_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
