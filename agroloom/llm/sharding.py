"""Sharding by bytes: the smallest feasible capacity of a contiguous partition of atomic groups.

Equal texts form a group; groups lie in the order of a 60-bit hash of their text. The driver sees this order through
atoms: key ranges with their bytes, refined only where a cut may fall, so its view stays within a few tens
of thousands of rows at any size. Everything else is DataFrame work.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroloom.operators.scale import null_safe_join
from agroloom.session import checkpointed

KEY_BITS = 60
FIRST_BITS = 14  # key bits of the first atoms
MORE_BITS = 8  # further key bits at each refinement
CELL_BITS = 8  # key bits and salts of a cell in which slots are numbered
SALTS = 256


@dataclass
class Atoms:
    """Key ranges in order: first key, key bits that are fixed, bytes, largest group, number of groups."""

    start: np.ndarray
    bits: np.ndarray
    size: np.ndarray
    groups: np.ndarray

    @property
    def before(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.size)))

    @property
    def single(self) -> np.ndarray:
        return (self.groups == 1) | (self.bits >= KEY_BITS)


def _atoms(rows: list, bits: int) -> Atoms:
    rows = sorted((r["a"], r["size"], r["groups"]) for r in rows)
    a, size, groups = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    return Atoms(a << (KEY_BITS - bits), np.full(len(rows), bits, np.int64), size, groups)


def _summed(groups: DataFrame, bits: int) -> list:
    cut = F.shiftright("k", KEY_BITS - bits).alias("a")
    return groups.groupBy(cut).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups")).collect()


def refined(atoms: Atoms, which: np.ndarray, groups: DataFrame) -> Atoms:
    """Split the atoms at ``which``, all of the same bits, by their next key bits; the rest stays."""
    bits = int(atoms.bits[which[0]])
    finer = min(bits + MORE_BITS, KEY_BITS)
    wanted = [int(k) >> (KEY_BITS - bits) for k in atoms.start[which]]
    inside = groups.where(F.shiftright("k", KEY_BITS - bits).isin(wanted))
    new = _atoms(_summed(inside, finer), finer)
    names = ("start", "bits", "size", "groups")
    merged = [np.concatenate((np.delete(getattr(atoms, f), which), getattr(new, f))) for f in names]
    by = np.argsort(merged[0])
    return Atoms(*(x[by] for x in merged))


def whole_chain(before: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Greedy cuts (atom indices) with no shard above ``capacity``, atoms kept whole; None if impossible."""
    cuts, at, n = [0], 0, len(before) - 1
    for _ in range(shards):
        nxt = int(np.searchsorted(before, before[at] + capacity, "right")) - 1
        if nxt == at and at < n:
            return None
        at = nxt
        cuts.append(at)
    return cuts if at == n else None


def fluid_chain(before: np.ndarray, single: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """As :func:`whole_chain`, with cuts anywhere inside atoms of several groups: a bound from below."""
    x, n, touched = 0, len(single), []
    for _ in range(shards):
        t = x + capacity
        j = int(np.searchsorted(before, t, "right")) - 1
        if j >= n:
            return [*touched, n - 1]
        if single[j]:
            t = int(before[j])
            if t <= x:
                return None
        x = t
        touched.append(j)
    return None


def smallest(low: int, high: int, works) -> int:
    """The smallest number in low..high for which ``works`` holds; high is known to."""
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if works(mid) else (mid + 1, high)
    return low


def minimax_capacity(atoms: Atoms, groups: DataFrame, biggest: int, shards: int) -> tuple[int, Atoms]:
    """The smallest capacity with which greedy filling needs no more than ``shards`` shards."""
    total = int(atoms.size.sum())
    low = max(biggest, -(-total // shards))
    while True:
        before, single = atoms.before, atoms.single
        top = int(max(low, total))
        feasible = smallest(low, top, lambda c: whole_chain(before, c, shards) is not None)
        possible = smallest(low, feasible, lambda c: fluid_chain(before, single, c, shards) is not None)
        if feasible == possible:
            return feasible, atoms
        # zones in which a cut of any capacity between the two may fall
        first = [0]
        for _ in range(shards):
            first.append(max(int(np.searchsorted(before, before[first[-1]] + possible, "right")) - 1, first[-1]))
        zone = np.zeros(len(single), bool)
        for a, b in zip(first[1:], fluid_chain(before, single, feasible, shards)):
            zone[max(a - 1, 0) : b + 1] = True
        atoms = _refined_where(atoms, zone & ~single, groups)


def _refined_where(atoms: Atoms, mask: np.ndarray, groups: DataFrame) -> Atoms:
    """Refine the coarsest of the marked atoms, so that all of them have the same bits."""
    which = np.flatnonzero(mask)
    which = which[atoms.bits[which] == atoms.bits[which].min()]
    return refined(atoms, which, groups)


def balanced_cuts(atoms: Atoms, groups: DataFrame, capacity: int, shards: int) -> list[int]:
    """First keys of shards 1.. : each cut nearest to an even share of what is left, within the capacity."""
    while True:
        before, single = atoms.before, atoms.single
        n, total = len(single), int(before[-1])
        # the first atom from which the rest still fits into so many shards
        latest = [n]
        for _ in range(shards):
            latest.append(int(np.searchsorted(before, before[latest[-1]] - capacity, "left")))
        cuts, at = [], 0
        for left in range(shards, 1, -1):
            most = int(np.searchsorted(before, before[at] + capacity, "right")) - 1
            aim = before[at] + (total - before[at]) / left
            j = int(np.searchsorted(before, aim, "left"))
            if j > 0 and aim - before[j - 1] <= before[min(j, n)] - aim:
                j -= 1
            at = max(min(j, most), min(latest[left - 1], most), at)
            cuts.append(at)
        near = np.zeros(n, bool)
        for c in cuts:
            near[max(c - 1, 0) : c + 1] = True
        if not (near & ~single).any():
            return [int(atoms.start[c]) if c < n else 1 << KEY_BITS for c in cuts]
        atoms = _refined_where(atoms, near & ~single, groups)


def _cell_columns(shard: Column) -> list[Column]:
    return [
        shard.alias("shard"),
        F.shiftright("k", KEY_BITS - CELL_BITS).alias("bucket"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"),
    ]


def shard_by_bytes(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    Size is the text's UTF-8 bytes plus 1; null counts as empty, in size, CRC and group. Equal texts share a shard; no
    contiguous partition of the groups has a smaller largest shard. Slots number the rows of a shard from 0
    in the order of (text hash, key); repeated rows and null keys get slots of their own. With fewer groups than shards
    some shards stay empty; an empty table gives an empty result.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.conv(F.substring(F.sha2(content, 256), 1, KEY_BITS // 4), 16, 10).cast("long").alias("k"),
    )
    rows = checkpointed(rows)
    groups = checkpointed(rows.groupBy("k").agg(F.sum("size").alias("size")))
    biggest = groups.agg(F.max("size").alias("m")).first()["m"] or 0
    atoms = _atoms(_summed(groups, FIRST_BITS), FIRST_BITS)
    cuts: list[int] = []
    if biggest:
        capacity, atoms = minimax_capacity(atoms, groups, int(biggest), shards)
        cuts = balanced_cuts(atoms, groups, capacity, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("k") >= cut).cast("int")
    cells = ["shard", "bucket", "salt"]
    placed = rows.select("*", *_cell_columns(shard))
    counts = placed.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*cells, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy(*cells).orderBy("k", "doc_id", "size"))
    out = null_safe_join(placed.withColumn("inside", inside), offsets, cells)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("first") + F.col("inside") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
