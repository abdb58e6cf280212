"""Merkle manifest of a dataset: per-source hash trees of 16 children, stored as blocks in van Emde Boas layout.

A tree is cut into aligned blocks of up to ``16 ** (HEIGHT - 1)`` leaves. Each block is one flat array of digests in which the
upper half of its levels comes first and the subtrees below follow one after the other, each laid out the same way. The
roots of the blocks are the leaves of the next layer of blocks, until one block is left; the trees' roots are the leaves of the
tree over the sources. Siblings are read from a block by address arithmetic, and the path above a block is the same for
all its leaves, so it is worked out once, from the top down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroloom.llm.text import map_arrow
from agroloom.operators.scale import null_safe_join, row_numbers
from agroloom.session import checkpointed, scratch_path

FANOUT = 16
HEIGHT = 4  # levels of a block: 4096 leaves
DIGEST = 64  # a digest as hex text


def sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


@lru_cache(maxsize=None)
def nodes_in(height: int) -> int:
    return sum(FANOUT**d for d in range(height))


def address(depth: int, index: np.ndarray, height: int) -> np.ndarray:
    """Places of nodes of one depth (the root has 0) in the layout of a complete tree of ``height`` levels.

    The levels are split at half: the upper tree lies first, the trees below it follow in order, each again in this layout.
    """
    if height == 1:
        return np.zeros_like(index)
    upper = height // 2
    if depth < upper:
        return address(depth, index, upper)
    lower = height - upper
    tree = index // FANOUT ** (depth - upper)
    inside = address(depth - upper, index % FANOUT ** (depth - upper), lower)
    return nodes_in(upper) + tree * nodes_in(lower) + inside


@lru_cache(maxsize=None)
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """Places of all nodes by depth."""
    return tuple(address(d, np.arange(FANOUT**d), height) for d in range(height))


def leaves_in(height: int) -> int:
    return FANOUT ** (height - 1)


def least_height(leaves: int) -> int:
    """Levels of a tree that holds so many leaves."""
    return next(h for h in range(1, 64) if leaves_in(h) >= leaves)


class Block(NamedTuple):
    """Digests of an aligned subtree in van Emde Boas layout; places of absent nodes hold zero bytes."""

    height: int
    leaves: int
    nodes: np.ndarray  # (nodes, DIGEST) bytes

    @property
    def root(self) -> bytes:
        return self.nodes[0].tobytes()

    def counts(self) -> list[int]:
        """Nodes there are at each depth."""
        return [-(-self.leaves // FANOUT ** (self.height - 1 - d)) for d in range(self.height)]

    def run(self, depth: int, index: int) -> tuple[int, bytes]:
        """Place in its run and digests of the run of a node: the up to 16 children of its parent."""
        first = index // FANOUT * FANOUT
        last = min(first + FANOUT, self.counts()[depth])
        return index - first, self.nodes[addresses(self.height)[depth][first:last]].tobytes()

    def siblings(self, leaf: int) -> list[tuple[bytes, bytes]]:
        """Digests left and right of the path from a leaf to the root, level by level."""
        out, index = [], leaf
        for depth in range(self.height - 1, 0, -1):
            at, run = self.run(depth, index)
            out.append((run[: at * DIGEST], run[(at + 1) * DIGEST :]))
            index //= FANOUT
        return out


def built(leaves: list[bytes], height: int) -> Block:
    """The block over its leaves, level by level into the layout."""
    block = Block(height, len(leaves), np.zeros((nodes_in(height), DIGEST), np.uint8))
    block.nodes[addresses(height)[-1][: len(leaves)]] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, DIGEST)
    counts = block.counts()
    for depth in range(height - 1, 0, -1):
        for parent in range(counts[depth - 1]):
            _, run = block.run(depth, parent * FANOUT)
            block.nodes[addresses(height)[depth - 1][parent]] = np.frombuffer(sha(run), np.uint8)
    return block


def folded(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf gives with its siblings."""
    return reduce(lambda x, sides: sha(sides[0] + x + sides[1]), path, leaf)


def packed(path: list[tuple[bytes, bytes]]) -> bytes:
    """Siblings as one text: two hexadecimal digits for how many there are on each side of a level, then their digests."""
    return b"".join(b"%02x%02x" % (len(x) // DIGEST, len(y) // DIGEST) + x + y for x, y in path)


def unpacked(data: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(data):
        left, right = (int(data[at + k : at + k + 2], 16) * DIGEST for k in (0, 2))
        at += 4
        out.append((data[at : at + left], data[at + left : at + left + right]))
        at += left + right
    return out


_BLOCK = "tree string, block long, total long, leaves long, root string, nodes binary"


def _record(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _blocks(height: int):
    """Blocks from leaves that come sorted by tree, block and place.

    A tree that is one block has only as many levels as it takes; the blocks of others have all, so that they join on one level.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaves = None, []

        def done() -> pa.RecordBatch:
            tree, block, total = key
            made = built(leaves, least_height(total) if total <= leaves_in(height) else height)
            return _record([(tree, block, total, len(leaves), made.root.decode(), made.nodes.tobytes())], _BLOCK)

        for tree, block, total, leaf in _streamed(batches):
            if (tree, block, total) != key:
                if leaves:
                    yield done()
                key, leaves = (tree, block, total), []
            leaves.append(leaf.encode())
        if leaves:
            yield done()

    return run


def _block_of(height: int) -> Column:
    return F.expr(f"place div {leaves_in(height)}")


def blocks_of(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Blocks over leaves (tree, place from 0, total leaves of the tree, digest)."""
    dealt = leaves.withColumn("block", _block_of(height)).repartition("tree", "block")
    ordered = dealt.sortWithinPartitions("tree", "block", "place")
    return map_arrow(ordered.select("tree", "block", "total", "digest"), _blocks(height), _BLOCK)


class Layers(NamedTuple):
    """Paths of the layers of blocks, lowest first, and the roots (tree, total, root)."""

    paths: list[str]
    roots: DataFrame


def stored_layers(spark: SparkSession, leaves: DataFrame, largest: int, height: int = HEIGHT) -> Layers:
    """Write the blocks over the leaves, then those over their roots, until every tree is one block.

    ``largest`` is the number of leaves of the largest tree; it decides how many layers there are (three hold 6.8e10 leaves).
    A tree that is done earlier stays as it is.
    """
    most, paths, roots = leaves_in(height), [], []
    while True:
        path = scratch_path(spark, "manifest")
        blocks_of(leaves, height).write.parquet(path)
        paths.append(path)
        layer = spark.read.parquet(path)
        roots.append(layer.where(F.col("total") <= most).select("tree", "root"))
        largest = -(-largest // most)
        if largest <= 1:
            return Layers(paths, reduce(DataFrame.unionByName, roots))
        leaves = layer.where(F.col("total") > most).select(
            "tree", F.col("block").alias("place"), F.expr(f"(total + {most - 1}) div {most}").alias("total"), F.col("root").alias("digest")
        )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _opened(leaves: int, nodes: bytes) -> Block:
    data = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    return Block(next(h for h in range(1, 64) if nodes_in(h) == len(data)), leaves, data)


_PATHS = "tree string, place long, path binary"


def _lowered(height: int):
    """Path of every child of a block: its siblings in the block, then the path of the block.

    Rows come sorted by tree and block, the block itself first, then its children with a null ``nodes``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, above, rows = None, b"", []
        for tree, _, place, leaves, nodes, path, _, _ in _streamed(batches):
            if nodes is not None:
                block, above = _opened(leaves, nodes), path
                continue
            rows.append((tree, place, packed(block.siblings(place % leaves_in(height))) + above))
            if len(rows) >= 512:
                yield _record(rows, _PATHS)
                rows = []
        yield _record(rows, _PATHS)

    return run


_CHECKED = "id long, digest string, tree string, place long, proof_sha256 string, folded_root string"


def _proven(height: int):
    """Digest of the siblings of every leaf, and the root that its (altered) digest gives with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, above, siblings, rows = None, [], b"", []
        for tree, id_, place, leaves, nodes, path, digest, altered in _streamed(batches):
            if nodes is not None:
                block, above = _opened(leaves, nodes), unpacked(path)
                siblings = b"".join(x + y for x, y in above)
                continue
            inside = block.siblings(place % leaves_in(height))
            proof = hashlib.sha256(b"".join(x + y for x, y in inside))
            proof.update(siblings)
            root = folded(folded((altered or digest).encode(), inside), above)
            rows.append((id_, digest, tree, place, proof.hexdigest(), root.decode()))
            if len(rows) >= 4096:
                yield _record(rows, _CHECKED)
                rows = []
        yield _record(rows, _CHECKED)

    return run


def _rows(df: DataFrame, **given: Column | str) -> DataFrame:
    """The columns that a task reads, in order; those not given are null."""
    kinds = {"tree": "string", "id": "long", "place": "long", "leaves": "long", "nodes": "binary", "path": "binary", "digest": "string", "altered": "string"}
    cols = {c: F.col(given[c]) if isinstance(given.get(c), str) else given.get(c, F.lit(None)) for c in kinds}
    return df.select(*[x.cast(kinds[c]).alias(c) for c, x in cols.items()], given["block"].alias("block"))


def _met(layer: DataFrame, above: DataFrame, children: DataFrame) -> DataFrame:
    """Blocks with the path above them (tree, place, path), each followed by its children; one shuffle deals out both."""
    placed = null_safe_join(layer, above.withColumnRenamed("place", "block"), ["tree", "block"], "inner")
    first = _rows(placed, tree="tree", leaves="leaves", nodes="nodes", path="path", block=F.col("block"))
    both = first.unionByName(children).repartition("tree", "block")
    return both.sortWithinPartitions("tree", "block", F.col("place").asc_nulls_first()).drop("block")


def child_paths(spark: SparkSession, layers: Layers, top: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Paths above the blocks of the lowest layer (tree, place, path), from ``top``: the path above each tree (tree, path).

    Each layer hands every child block its siblings and the path of its own block.
    """
    one = top.select("tree", F.lit(0).cast("long").alias("place"), "path")
    paths = one
    for k in range(len(layers.paths) - 1, 0, -1):
        layer, below = (spark.read.parquet(layers.paths[i]) for i in (k, k - 1))
        children = below.where(F.col("total") > leaves_in(height)).withColumnRenamed("block", "place")
        rows = _rows(children, tree="tree", place="place", block=_block_of(height))
        lowered = map_arrow(_met(layer, paths, rows), _lowered(height), _PATHS)
        # trees that are one block of the lower layer keep the path they have
        done = below.where(F.col("total") <= leaves_in(height)).select("tree")
        paths = lowered.unionByName(null_safe_join(one, done, ["tree"], "left_semi"))
    return paths


def field_text(c: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, ``-`` for null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def record_digest(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*columns.values()), 256)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest_proofs(rows: DataFrame, tree: str, key: str, digest: str, altered: str, height: int = HEIGHT) -> DataFrame:
    """Proofs of all rows in the manifest over a table of digests; the blocks are written to the shared folder.

    Per ``tree`` (null is a tree of its own) the digests ascend by ``key``, null first, then by digest; equal rows are leaves of
    their own. Trees are ordered by their name, null first. Returns tree, id, place, digest, subroot, root, proof_sha256,
    folded_root (from ``altered`` where it is not null, else from the digest, with the original siblings) and verified. An
    empty table gives no rows.
    """
    spark = rows.sparkSession
    plain = rows.select(F.col(tree).alias("tree"), F.col(key).alias("id"), F.col(digest).alias("digest"), F.col(altered).alias("altered"))
    order = [F.col("id").asc_nulls_first(), F.col("digest").asc()]
    numbered = row_numbers(plain, ["tree"], order, "place", spread=True).withColumn("place", F.col("place") - 1)
    totals = checkpointed(numbered.groupBy("tree").agg((F.max("place") + 1).alias("total")))
    leaves = null_safe_join(numbered.select("tree", "place", "digest"), totals, ["tree"])
    lower = stored_layers(spark, leaves, totals.agg(F.max("total")).first()[0] or 0, height)
    # the tree over the trees, as a tree without a name
    named = row_numbers(lower.roots, [], [F.col("tree").asc_nulls_first()], "place").withColumn("place", F.col("place") - 1)
    count = named.count()
    over = named.select(
        F.lit(None).cast("string").alias("tree"), "place", F.lit(count).cast("long").alias("total"), F.col("root").alias("digest")
    )
    upper = stored_layers(spark, over, count, height)
    start = spark.createDataFrame([(None, bytearray())], "tree string, path binary")
    members = _rows(over, place="place", block=_block_of(height))
    tops = map_arrow(_met(spark.read.parquet(upper.paths[0]), child_paths(spark, upper, start, height), members), _lowered(height), _PATHS)
    above = checkpointed(named.join(tops.select("place", "path"), "place").select("tree", F.col("root").alias("subroot"), "path"))
    paths = child_paths(spark, lower, above.select("tree", "path"), height)
    own = _rows(numbered, tree="tree", id="id", place="place", digest="digest", altered="altered", block=_block_of(height))
    checked = map_arrow(_met(spark.read.parquet(lower.paths[0]), paths, own), _proven(height), _CHECKED)
    top = upper.roots.first()
    out = null_safe_join(checked, above.select("tree", "subroot"), ["tree"])
    out = out.withColumn("root", F.lit(top and top["root"]).cast("string"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    A leaf is the digest of the five columns of a document, in the order of ``FIELDS``; other columns are not read. Rows whose
    crc32 of the decimal doc_id is divisible by 5 are tampered with: their text is lower-cased (A-Z); rows
    without a doc_id are not. Ties and repeated rows are as in :func:`manifest_proofs`.
    """
    written = {c: field_text(F.col(c)) for c in FIELDS}
    changed = {**written, "text": field_text(lower_ascii(F.col("text")))}
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.select(
        "source",
        F.col("doc_id").cast("long").alias("doc_id"),
        record_digest(written).alias("leaf"),
        F.when(touched, record_digest(changed)).alias("altered"),
    )
    out = manifest_proofs(rows, "source", "doc_id", "leaf", "altered")
    return out.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified"
    )
