"""Exact dedup: partitions by length and content hash, each owned by a compressed radix trie of full texts."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroloom.llm.text import map_arrow, own_columns, slices
from agroloom.operators.scale import null_safe_join

SPILL_BYTES = 32 << 20  # texts a trie holds before finished subtrees leave it
LOCAL_BYTES = 8 << 20  # texts combined in one trie before the shuffle


class Node:
    __slots__ = ("edges", "best", "ties", "count")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.best: int | None = None
        self.ties = self.count = 0  # count 0: no text ends here


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Patricia trie of byte strings; a terminal node holds the group's chosen id, its repeats and the group size."""

    def __init__(self, largest: bool = True):
        self.largest = largest
        self.clear()

    def clear(self) -> None:
        self.root, self.held = Node(), 0

    def insert(self, key: bytes, best: int | None, ties: int, count: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            edge = node.edges.get(key[at])
            if edge is None:
                leaf = Node()
                node.edges[key[at]] = (key[at:], leaf)
                self.held += len(key) - at
                node, at = leaf, len(key)
                continue
            label, child = edge
            if not key.startswith(label, at):
                n = shared_prefix(label, key[at : at + len(label)])
                middle = Node()
                middle.edges[label[n]] = (label[n:], child)
                node.edges[key[at]] = (label[:n], middle)
                label, child = label[:n], middle
            node, at = child, at + len(label)
        self._settle(node, best, ties, count)

    def _settle(self, node: Node, best: int | None, ties: int, count: int) -> None:
        if node.count == 0:
            node.best, node.ties = best, ties
        elif best == node.best:
            node.ties += ties
        elif node.best is None or (best is not None and (best > node.best) == self.largest):
            node.best, node.ties = best, ties
        node.count += count

    def items(self) -> Iterator[tuple[bytes, Node]]:
        stack = [(b"", self.root)]
        while stack:
            prefix, node = stack.pop()
            if node.count:
                yield prefix, node
            stack += [(prefix + label, child) for label, child in node.edges.values()]


_LOCAL = "n_bytes int, hash long, content binary, best long, ties long, n long"
_OWNED = "text_sha256 string, keep_id long, ties long, group_size long"


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in ddl.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _combined(largest: bool):
    """Equal texts of a slice of input become one row, so a hot text sends a row per slice, not per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "content", LOCAL_BYTES):
                trie = RadixTrie(largest)
                for i, n, h, content in zip(*(part.column(c).to_pylist() for c in ("id", "n_bytes", "hash", "content"))):
                    trie.insert(struct.pack(">Iq", n, h) + content, i, 1, 1)
                yield _table([(*struct.unpack(">Iq", k[:12]), k[12:], x.best, x.ties, x.count) for k, x in trie.items()], _LOCAL)

    return run


def _owners(largest: bool):
    """Rows come sorted by length and hash, so a subtree is finished once its length and hash are past.

    Above ``SPILL_BYTES`` all finished subtrees leave the trie; only groups of two and more are reported.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = RadixTrie(largest), None

        def finished() -> pa.RecordBatch:
            rows = [(hashlib.sha256(k[12:]).hexdigest(), x.best, x.ties, x.count) for k, x in trie.items() if x.count > 1]
            trie.clear()
            return _table(rows, _OWNED)

        for batch in batches:
            for part in slices(batch, "content"):
                for n, h, content, best, ties, count in zip(*(part.column(i).to_pylist() for i in range(6))):
                    head = struct.pack(">Iq", n, h)
                    if trie.held > SPILL_BYTES and head != last:
                        yield finished()
                    trie.insert(head + content, best, ties, count)
                    last = head
        yield finished()

    return run


def repeated_texts(df: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = True) -> DataFrame:
    """text_sha256, keep_id, ties, group_size of every text that occurs at least twice (null counts as empty)."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).cast("long").alias("id"),
        F.octet_length(content).alias("n_bytes"),
        F.xxhash64(content).alias("hash"),
        content.cast("binary").alias("content"),
    )
    local = map_arrow(rows, _combined(largest), _LOCAL)
    dealt = local.repartition("n_bytes", "hash").sortWithinPartitions("n_bytes", "hash")
    return map_arrow(dealt, _owners(largest), _OWNED)


def mark_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", largest: bool = True) -> DataFrame:
    """All rows and columns of ``df`` with text_sha256, keep_id, group_size and kept.

    Of equal texts the row with the largest ``key`` stays (the smallest with ``largest=False``); a null key comes after
    all others, and of rows with the same key and text one stays. Null texts equal empty ones. Columns
    of these four names are replaced.
    """
    owned = repeated_texts(df, key, text, largest)
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    rows = df.drop("keep_id", "group_size", "kept", "ties").withColumn("text_sha256", sha)
    joined = null_safe_join(rows, owned, ["text_sha256"])
    chosen = F.col("group_size").isNull() | F.col(key).eqNullSafe(F.col("keep_id"))
    joined = joined.withColumn("kept", chosen)
    several = F.col("kept") & (F.coalesce("ties", F.lit(1)) > 1)
    once = joined.where(~several)
    # rows that repeat the chosen key and text, usually none: the first of them stays
    repeats = Window.partitionBy("text_sha256").orderBy(key)
    tied = joined.where(several).withColumn("kept", F.row_number().over(repeats) == 1)
    out = once.unionByName(tied)
    return (
        out.withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col(key)).otherwise(F.col("keep_id")))
        .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
        .drop("ties")
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    return mark_repeats(docs.select("doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@own_columns
def drop_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns, also those that are called like a result of ``mark_repeats``. An
    empty table stays empty; ties, nulls and repeated rows as there."""
    return mark_repeats(docs).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])
