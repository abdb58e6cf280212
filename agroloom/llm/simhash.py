"""SimHash near-dedup with BK-trees.

A BK-tree keys the children of a node by their Hamming distance to it; a search from distance d follows only edges
d - r .. d + r. One tree over all fingerprints would be searched almost whole at 64 bits, and broadcasting all shard trees
would grow with the corpus. So shards are cut by content: two fingerprints within r bits agree in all but r
of some blocks of bits, and each choice of agreeing blocks deals the distinct fingerprints to shard trees that hold all their
possible partners. The trees of a task are built and searched together, level by level, in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.llm.components import component_roots
from agroloom.llm.text import joined, map_arrow, own_columns, slices, texts_of, words_of
from agroloom.operators.scale import null_safe_join
from agroloom.session import checkpointed

SHINGLE = 4
MAX_BITS = 4
SEED = 42
FOREST = 50_000  # fingerprints whose trees are searched together, unless a single tree is larger
FRONTIER = 200_000  # (query, node) pairs looked at together
SLICE = 1 << 20  # text bytes whose shingle bits are unpacked together
CROWD = 2_000  # fingerprints of a shard from which close neighbours are probed before its tree is searched


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if more than half the shingle hashes have it; 0 without words."""
    flat, counts = words_of(pc.ascii_lower(texts))
    out = np.zeros(len(counts), np.uint64)
    if not len(flat):
        return out
    raw = memoryview(joined(flat))
    lengths = pc.binary_length(flat).to_numpy().astype(np.int64)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = np.cumsum(counts)
    shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    row = np.repeat(np.arange(len(counts)), shingles)
    nth = np.arange(int(shingles.sum())) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = (last - counts)[row] + nth
    until = np.minimum(first + shingle, last[row]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[until].tolist())), np.uint64, len(first))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    some = np.flatnonzero(shingles)
    sums = np.add.reduceat(bits, (np.cumsum(shingles) - shingles)[some], axis=0, dtype=np.int32)
    majority = (2 * sums > shingles[some, None]).astype(np.uint8)
    out[some] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def text_hash(text: str):
    return F.coalesce(F.xxhash64(text), F.lit(0))


def with_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp of every row; null counts as empty. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                fp = fingerprints(texts_of(part, "text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp)], ["doc_id", "text_hash", "fp"])

    rows = df.select(F.col(key).cast("long").alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    return map_arrow(rows, run, "doc_id long, text_hash long, fp long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def bk_forest(fp: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A BK-tree per shard (shards lie together): the root of each node's tree, and its children by distance."""
    n = len(fp)
    first = np.concatenate(([True], shard[1:] != shard[:-1]))
    root = np.flatnonzero(first)[np.cumsum(first) - 1]
    child = np.full((n, 65), -1, np.int32)
    free = np.flatnonzero(~first)
    at = root[free]
    while len(free):
        slot = at * 65 + distance(fp[free], fp[at])
        taken, lead = np.unique(slot, return_index=True)
        child.reshape(-1)[taken] = free[lead]
        at = child.reshape(-1)[slot]
        rest = at != free
        free, at = free[rest], at[rest]
    return root, child


def close_pairs(
    fp: np.ndarray, root: np.ndarray, child: np.ndarray, radius: int, before: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, node) within the radius, found along the edges that can lead to one.

    A query looks for nodes placed earlier than ``before`` (by default than itself, so a pair is found once); 0 asks for nothing.
    """
    steps = np.arange(-radius, radius + 1)
    before = np.arange(len(fp)) if before is None else before
    stack = [(q, root[q]) for q in np.array_split(np.flatnonzero(before > root), max(1, len(fp) * 16 // FRONTIER))]
    while stack:
        query, node = stack.pop()
        if len(query) > FRONTIER:
            half = len(query) // 2
            stack += [(query[:half], node[:half]), (query[half:], node[half:])]
            continue
        d = distance(fp[query], fp[node]).astype(np.int64)
        hit = (d <= radius) & (node != query)
        if hit.any():
            yield query[hit], node[hit]
        edges = d[:, None] + steps
        nxt = np.where((edges > 0) & (edges <= 64), child[node[:, None], np.clip(edges, 0, 64)], -1)
        # children come after their parent, so a later node leads to no earlier one
        which, where = np.nonzero((nxt >= 0) & (nxt < before[query][:, None]))
        if len(which):
            stack.append((query[which], nxt[which, where].astype(np.int64)))


def merged_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the components of each pair; the least member is the label."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def probed(fp: np.ndarray, label: np.ndarray, radius: int) -> np.ndarray:
    """Join neighbours of a crowded shard by looking up each fingerprint with one bit, then two, turned; and return which members
    still have to search: all outside the largest component. A dense cluster is joined this way without comparing its pairs."""
    order = np.argsort(fp)
    known = fp[order]

    def join(turned: np.uint64) -> None:
        other = fp ^ turned
        place = np.minimum(np.searchsorted(known, other), len(known) - 1)
        found = np.flatnonzero(known[place] == other)
        merged_labels(label, found, order[place[found]])

    bits = [np.uint64(1) << np.uint64(b) for b in range(64)]
    for size in range(1, min(radius, 2) + 1):
        for turned in combinations(bits, size):
            join(np.bitwise_or.reduce(np.array(turned, np.uint64)))
            if size == 2 and (label == label[0]).all():
                break
    names, counts = np.unique(label, return_counts=True)
    return label != names[np.argmax(counts)]


def block_masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of each choice of blocks that two fingerprints within the radius may agree in."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(block, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def blocks_for(n: int, radius: int) -> int:
    """Enough blocks that a shard key has about as many bits as there are distinct fingerprints, so trees stay small."""
    blocks = radius + 1
    while 64 * (blocks - radius) // blocks < np.log2(max(n, 2)) - 6:
        blocks += 1
    return blocks


def _stars(radius: int):
    """Search the trees of complete shards; only a star per component of a shard goes on, never all its pairs."""

    def links(fp: np.ndarray, mask: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        shard = np.cumsum(np.concatenate(([True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]))))
        several = np.bincount(shard)[shard] > 1
        fp, shard = fp[several], shard[several]
        label, before, words = np.arange(len(fp)), np.arange(len(fp)), fp.view(np.uint64)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(fp)])) if len(fp) else np.array([0])
        for a, b in zip(edges, edges[1:]):
            if b - a > CROWD:
                own = np.arange(b - a)
                search = probed(words[a:b], own, radius)
                label[a:b] = own + a
                before[a:b] = np.where(search, b, 0)
        if (before > 0).any():
            root, child = bk_forest(words, shard)
            for a, b in close_pairs(words, root, child, radius, before):
                merged_labels(label, a, b)
        linked = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[label[linked]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns)]
            if len(held[0]) >= FOREST:
                fp, mask, key = held
                ends = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
                if len(ends):
                    cut = int(ends[-1])  # the last shard may go on in the next batch
                    yield links(fp[:cut], mask[:cut], key[:cut])
                    held = [h[cut:] for h in held]
        yield links(*held)

    return run


def near_links(distinct: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """(a, b) links that join all distinct fingerprints within ``radius`` bits of each other."""
    masks = block_masks(blocks_for(distinct.count(), radius), radius)
    rows = distinct.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask", "bits"))
    rows = rows.select("fp", F.col("mask").cast("long").alias("mask"), F.col("fp").bitwiseAND(F.col("bits")).alias("key"))
    dealt = rows.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return map_arrow(dealt, _stars(radius), "a long, b long")


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp, root, component_id of every row.

    The component is the smallest key reachable over links of at most ``radius`` bits. Null and empty texts have
    fingerprint 0; rows with equal texts or repeated keys share a component; a null key never names one
    unless the component has no other. An empty table gives an empty result.
    """
    rows = checkpointed(with_fingerprints(df, key, text))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = component_roots(near_links(distinct.select("fp"), radius))
    linked = null_safe_join(distinct, roots.withColumnRenamed("node", "fp"), ["fp"]).withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = null_safe_join(linked.select("fp", "root"), least, ["root"])
    return null_safe_join(rows, of_fp, ["fp"])


def hex_fingerprint(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return near_groups(docs).select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


@own_columns
def drop_near(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, that with the smallest key (null last), with its own columns, whatever they are called. Of
    repeated rows one stays; an empty table stays empty."""
    groups = near_groups(docs).groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("ties"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "ties")).alias("first")
    stay = groups.groupBy("root").agg(first)
    stay = stay.select(F.col("first.doc_id").alias("__id"), F.col("first.text_hash").alias("__hash"), F.col("first.ties").alias("__ties"))
    marked = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__hash": text_hash("text")})
    rows = null_safe_join(marked, stay, ["__id", "__hash"], "inner")
    # rows that repeat both key and text, usually none
    out = rows.where("__ties = 1").unionByName(rows.where("__ties > 1").dropDuplicates(["__id", "__hash"]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
