"""Hard-negative mining by segment summaries.

Each vector is cut into segments of which the sum and the sum of squares are stored; from them come mean and deviation of a
segment and, by adding, of any longer segment. For two segments the means' product times the length, plus or minus the
product of the deviations, bounds the inner product (Cauchy-Schwarz on what is left beside the means). Pairs whose bounds can't
reach what is looked for are left out, first on the whole vector as one segment, then on ever shorter segments; what is left is
scored exactly. All vectors are whole numbers, so sums, squares and scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroloom.llm.text import map_arrow
from agroloom.session import checkpointed

SEGMENTS = 8  # shortest segments of a vector; the longer ones are made of two each
ANCHORS = 2048  # anchors of a block
ROWS = 4096  # rows of a block, and of a group on average; a group meets every block of anchors once
TILE = 1024  # rows bounded at once
SCALE = 256  # a component becomes the whole number below SCALE times it
POSITIVES = 5
NEGATIVES = 3
MOST_TASKS = 1 << 14
EXACT = 1 << 53  # whole numbers below are exact as doubles
LEAST, MOST = -(1 << 63) + 1, (1 << 63) - 1


class Vectors(NamedTuple):
    """Vectors of one length: ids, labels, components, and sum and sum of squares of each segment (all whole numbers)."""

    ids: np.ndarray
    labels: np.ndarray
    parts: np.ndarray
    sums: np.ndarray
    squares: np.ndarray

    def taken(self, which: np.ndarray) -> Vectors:
        return Vectors(*(x[which] for x in self))


def edges(length: int) -> np.ndarray:
    """Where the segments of a vector begin and end; short vectors have a segment for each component."""
    count = min(SEGMENTS, max(1, length))
    return np.arange(count + 1) * length // count


def summarised(ids: np.ndarray, labels: np.ndarray, parts: np.ndarray) -> Vectors:
    cut = edges(parts.shape[1])
    with np.errstate(over="ignore"):
        sums = np.stack([parts[:, a:b].sum(axis=1) for a, b in zip(cut, cut[1:])], axis=1)
        squares = np.stack([(parts[:, a:b] ** 2).sum(axis=1) for a, b in zip(cut, cut[1:])], axis=1)
    return Vectors(ids, labels, parts, sums, squares)


class Level(NamedTuple):
    """Means times the square root of the length, and deviations, of segments put together."""

    means: np.ndarray
    deviations: np.ndarray


def level(v: Vectors, segments: int) -> Level:
    """Summaries with ``segments`` segments, added up from the shortest ones."""
    cut = edges(v.parts.shape[1])
    starts = np.arange(segments) * (len(cut) - 1) // segments
    length = np.diff(cut[np.append(starts, len(cut) - 1)])
    sums, squares = np.add.reduceat(v.sums, starts, axis=1), np.add.reduceat(v.squares, starts, axis=1)
    with np.errstate(all="ignore"):
        means = sums / np.sqrt(length)
        return Level(means, np.sqrt(np.maximum(squares - means * means, 0.0)))


def levels(length: int) -> list[int]:
    """Segments at each level of the refinement."""
    out = [1]
    while out[-1] * 2 <= len(edges(length)) - 1:
        out.append(out[-1] * 2)
    return out


def bounds(a: Level, b: Level) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible score of all pairs, widened by more than the rounding of doubles and kept in the range of a
    long; without any limit where doubles overflow."""
    with np.errstate(all="ignore"):
        middle, spread = a.means @ b.means.T, a.deviations @ b.deviations.T
        size = [np.sqrt((x.means**2 + x.deviations**2).sum(axis=1)) for x in (a, b)]
        # deviations are off by up to 1e-8 of a vector's size, as they come from a difference of squares
        spread += 1e-7 * size[0][:, None] * size[1] + 1e-6
        low, high = middle - spread, middle + spread
    return np.where(np.isnan(low), -np.inf, np.minimum(low, MOST)), np.where(np.isnan(high), np.inf, np.maximum(high, LEAST))


def exact(a: Vectors, b: Vectors) -> np.ndarray:
    """Scores of all pairs. Doubles are exact while no sum can reach 2^53, else Python's whole numbers are used; a score
    beyond a long counts as its limit."""
    if a.parts.shape[1] == 0 or not len(a.ids) or not len(b.ids):
        return np.zeros((len(a.ids), len(b.ids)), np.int64)
    most = float(np.abs(a.parts).max()) * float(np.abs(b.parts).max()) * a.parts.shape[1]
    if most < EXACT:
        return (a.parts @ b.parts.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in v.parts.tolist()], object) for v in (a, b)]
    return np.clip(whole[0] @ whole[1].T, LEAST, MOST).astype(np.int64)


class Best:
    """The best few (score, id) of each query so far: higher scores first, ties by smaller id."""

    def __init__(self, queries: int, most: int):
        self.most = most
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(queries)]
        self.floor = np.full(queries, LEAST)  # scores below can't enter

    def add(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates as parallel arrays."""
        for q, s, i in zip(query.tolist(), scores.tolist(), ids.tolist()):
            self.found[q].append((-s, i))
        for q in np.unique(query).tolist():
            mine = self.found[q] = sorted(self.found[q])[: self.most]
            if len(mine) == self.most:
                self.floor[q] = -mine[-1][0]


def leading(scores: np.ndarray, wanted: np.ndarray, most: int) -> np.ndarray:
    """Of the ``wanted`` pairs the first ``most`` of each row by score; ties go to the column further left.

    Ties stay all in where scores are too large to carry the column.
    """
    n = scores.shape[1]
    if n <= most:
        return wanted
    if np.abs(scores).max() < EXACT // n:
        scores = scores * n + np.arange(n - 1, -1, -1)
    low = np.where(wanted, scores, LEAST)
    return wanted & (scores >= np.partition(low, n - most, axis=1)[:, n - most, None])


def mined(anchors: Vectors, rows: Vectors, low: np.ndarray, high: np.ndarray, best: Best, same_label: bool) -> tuple[int, int]:
    """Enter the best rows of each anchor into ``best``, of the same label or of others, with a score in [low, high].

    ``low`` and ``high`` have a column for each search of an anchor; search ``k`` of anchor ``i`` is query ``i * columns + k``. A row with the
    anchor's own id is none of its rows. Returns how many pairs there were and how many were scored exactly.
    """
    searches = low.shape[1]
    steps = levels(anchors.parts.shape[1])
    summaries = [level(anchors, s) for s in steps]
    pairs = scored = 0
    # ties go to the smaller id, so those rows come first
    rows = rows.taken(np.argsort(rows.ids, kind="stable"))
    for at in range(0, len(rows.ids), TILE):
        tile = rows.taken(np.arange(at, min(at + TILE, len(rows.ids))))
        open_ = (anchors.labels[:, None] == tile.labels) == same_label
        open_ &= anchors.ids[:, None] != tile.ids
        pairs += int(open_.sum())
        mine, theirs = np.arange(len(anchors.ids)), np.arange(len(tile.ids))
        least = np.maximum(low, best.floor.reshape(-1, searches))
        for s, summary in zip(steps, summaries):
            down, up = bounds(Level(*(x[mine] for x in summary)), level(tile.taken(theirs), s))
            near = np.zeros_like(open_)
            for j in range(searches):
                near |= (up >= least[mine, j, None]) & (down <= high[mine, j, None])
            open_ &= near
            if same_label and len(theirs) > best.most:  # so many rows are sure to reach their lowest possible score
                sure = np.partition(np.where(open_, down, -np.inf), len(theirs) - best.most, axis=1)
                open_ &= up >= sure[:, len(theirs) - best.most, None]
            # anchors and rows without an open pair leave before the next, finer level
            some, other = open_.any(axis=1), open_.any(axis=0)
            mine, theirs, open_ = mine[some], theirs[other], open_[np.ix_(some, other)]
            if not len(mine):
                break
        if not len(mine):
            continue
        scored += int(open_.sum())
        chosen = tile.taken(theirs)
        scores = exact(anchors.taken(mine), chosen)
        for j in range(searches):
            fits = open_ & (scores >= least[mine, j, None]) & (scores <= high[mine, j, None])
            a, b = np.nonzero(leading(scores, fits, best.most))
            best.add(mine[a] * searches + j, scores[a, b], chosen.ids[b])
    return pairs, scored


def _small(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as hold them, with the kind in front."""
    most = float(np.abs(x).max()) if x.size else 0.0
    kind = "i2" if most < 1 << 15 else "i4" if most < 1 << 31 else "f8"
    return kind.encode() + np.ascontiguousarray(x.astype(kind)).tobytes()


def _large(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, data[:2].decode(), offset=2).astype(np.float64).reshape(rows, -1 if len(data) > 2 else 0)


_PACKED = "place long, length int, rows int, ids binary, tags binary, labels binary, parts binary, sums binary, squares binary, low binary, high binary"
_HITS = "anchor_id long, tag long, search int, score long, vec_id long"


def _record(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _packing(most: int, groups: int | None):
    """Rows as blocks of at most ``most`` with their summaries, a block for each place and vector length.

    With ``groups`` the rows of a task are packed as they come and a block goes to the group its first id gives.
    """

    def block(place: int, length: int, rows: list) -> tuple:
        ids, tags, labels = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        with np.errstate(over="ignore"):
            parts = np.floor(np.array([r[3] for r in rows], np.float64).reshape(len(rows), length) * SCALE)
        v = summarised(ids, labels, np.nan_to_num(parts))
        ranges = [None if rows[0][k] is None else np.array([r[k] for r in rows], np.int64).tobytes() for k in (4, 5)]
        place = int(ids[0]) % groups if groups else place
        return (place, length, len(rows), *(x.tobytes() for x in (ids, tags, labels)), *(_small(x) for x in v[2:]), *ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple, list] = {}
        for batch in batches:
            for place, *row in zip(*(c.to_pylist() for c in batch.columns)):
                key = (place, len(row[3]))
                if key not in waiting and len(waiting) >= 8:  # few lengths at once, whatever the table holds
                    old = next(iter(waiting))
                    yield _record([block(*old, waiting.pop(old))], _PACKED)
                rows = waiting.setdefault(key, [])
                rows.append(row)
                if len(rows) >= most:
                    yield _record([block(*key, waiting.pop(key))], _PACKED)
        for key, rows in waiting.items():
            yield _record([block(*key, rows)], _PACKED)

    return run


_FIELDS = ["vec_id", "tag", "label", "vec", "low", "high"]


def packed_rows(rows: DataFrame, groups: int) -> DataFrame:
    """All rows in blocks, packed where they are read."""
    none = F.lit(None).cast("array<long>")
    plain = rows.withColumns({"place": F.lit(0).cast("long"), "low": none, "high": none}).select("place", *_FIELDS)
    return map_arrow(plain, _packing(ROWS, groups), _PACKED)


def packed_anchors(anchors: DataFrame, blocks: int) -> DataFrame:
    """Anchors in ``blocks`` places, by a hash of their id."""
    dealt = anchors.withColumn("place", F.pmod(F.xxhash64("vec_id", "tag"), F.lit(blocks)).cast("long")).repartition("place")
    return map_arrow(dealt.sortWithinPartitions("place").select("place", *_FIELDS), _packing(ANCHORS, None), _PACKED)


def _searching(most: int, same_label: bool):
    """Blocks of anchors met with blocks of rows; the best rows of every search in this task."""

    def opened(block: dict) -> Vectors:
        ids, labels = (np.frombuffer(block[c], np.int64) for c in ("ids", "labels"))
        return Vectors(ids, labels, *(_large(block[c], len(ids)) for c in ("parts", "sums", "squares")))

    def results(tags: np.ndarray, anchors: Vectors, best: Best) -> pa.RecordBatch:
        per = len(best.found) // len(tags)
        rows = [(int(anchors.ids[q // per]), int(tags[q // per]), q % per, -s, i) for q, found in enumerate(best.found) for s, i in found]
        return _record(rows, _HITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                key = (row["block"], row["ids"], row["tags"])
                if held is None or held[0] != key:
                    if held:
                        yield results(*held[1:4])
                    tags, anchors = np.frombuffer(row["tags"], np.int64), opened(row)
                    ranges = [
                        np.full((len(tags), 1), end) if row[c] is None else np.frombuffer(row[c], np.int64).reshape(len(tags), -1)
                        for c, end in (("low", LEAST), ("high", MOST))
                    ]
                    held = (key, tags, anchors, Best(ranges[0].size, most), *ranges)
                theirs = opened({c[2:]: row[c] for c in row if c.startswith("r_")})
                mined(held[2], theirs, held[4], held[5], held[3], same_label)
        if held:
            yield results(*held[1:4])

    return run


def searched(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, most: int, same_label: bool) -> DataFrame:
    """anchor_id, tag, search, score, vec_id and rank of the best ``most`` rows of every search of every anchor.

    Each block of anchors meets each group of rows once: anchors go out with every group, rows with every block, and both meet on
    (block, group). The bests of the tasks meet in a ranked window, which keeps no more than ``most`` of a search before the shuffle too.
    """
    names = ["ids", "labels", "parts", "sums", "squares"]

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    cells, on = min(2 * blocks * groups, MOST_TASKS), ["block", "group", "length"]
    mine = anchors.withColumnRenamed("place", "block").withColumn("group", every(groups))
    theirs = rows.withColumnRenamed("place", "group").withColumn("block", every(blocks))
    theirs = theirs.select(*on, *[F.col(c).alias(f"r_{c}") for c in names])
    # dealt out by number of cells and not by bytes: a cell is little data and much work
    met = mine.repartition(cells, *on).join(theirs.repartition(cells, *on), on)
    hits = map_arrow(met.select("block", *names, "tags", "low", "high", *[f"r_{c}" for c in names]), _searching(most, same_label), _HITS)
    best = Window.partitionBy("anchor_id", "tag", "search").orderBy(F.col("score").desc(), F.col("vec_id"))
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def usable(rows: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """vec_id, tag (a hash of label and vector), label and vec of the rows that take part."""
    vec = F.col(f"`{vector}`").cast("array<double>")
    plain = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), vec.alias("vec"))
    limit = F.lit(float("inf"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != limit))
    some = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
    return plain.where(some & sound).withColumn("tag", F.xxhash64("label", "vec"))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    share: tuple[int, int] = (50, 95),
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``is_anchor`` is a condition on ``key``. The score of two vectors is the inner product of their components, each made a whole number
    (floor of 256 times it); ties go to the smaller id. An anchor's positives are its best rows of the same label; for each of them the best rows of other
    labels are returned whose score lies in ``share`` (per cent) of the positive's score.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part; vectors of other lengths are not
    compared. Every row counts, also one that repeats an id, but never for an anchor with its own id; an anchor
    that is repeated with label and vector is searched once. Other columns are not read; an empty table gives no rows.
    """
    plain = usable(rows, key, vector, F.col("label") if label is None else label)
    chosen = is_anchor & F.col("vec_id").isNotNull()
    groups = max(1, -(-rows.count() // ROWS))
    blocks = max(1, -(-rows.select(F.col(f"`{key}`").cast("long").alias("vec_id")).where(chosen).count() // ANCHORS))
    anchors = plain.where(chosen).dropDuplicates(["vec_id", "label", "tag", "vec"])
    blocks_of_rows = packed_rows(plain, groups)
    none = F.lit(None).cast("array<long>")
    first = packed_anchors(anchors.withColumns({"low": none, "high": none}), blocks)
    hits = searched(first, blocks_of_rows, blocks, groups, positives, True)
    found = checkpointed(hits.select("anchor_id", "tag", (F.col("rank") - 1).alias("search"), "score", "vec_id"))
    # the wanted range of every positive, by its rank; ranges that hold no score fill the places of missing ones
    score = F.col("score").cast("decimal(20,0)")
    ranges = found.withColumns(
        {"low": F.ceil(score * share[0] / 100).cast("long"), "high": F.floor(score * share[1] / 100).cast("long")}
    )

    def by_rank(c: str, empty: int) -> Column:
        places = [F.coalesce(F.max(F.when(F.col("search") == k, F.col(c))), F.lit(empty).cast("long")) for k in range(positives)]
        return F.array(*places).alias(c)

    wanted = ranges.groupBy(F.col("anchor_id").alias("vec_id"), "tag").agg(by_rank("low", 1), by_rank("high", 0))
    second = packed_anchors(anchors.join(wanted, ["vec_id", "tag"]), blocks)
    hard = searched(second, blocks_of_rows, blocks, groups, negatives, False)
    mine = found.select("anchor_id", "tag", "search", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = hard.join(mine, ["anchor_id", "tag", "search"])
    return out.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def mined_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 50; where it is divisible by 7 the label is (label + 1) % 10."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(embeddings, F.col("vec_id") % 50 == 0, label=moved)
