"""Document fingerprints from prefix polynomial hashes.

Modular prefix arrays over the code points of many texts answer whether any two spans are equal and give longest common
extensions by binary search. A fingerprint is made of span hashes alone: the length, the hash of the whole text, a ladder of
prefix and of suffix hashes at growing lengths, and the smallest hashes of all spans of ``WINDOW`` code points.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroloom.llm.text import map_arrow, ship_package

PRIME = (1 << 31) - 1
BASES = (1_160_412_409, 805_731_173)
WINDOW = 12  # code points of a sampled span
SAMPLE = 64  # span hashes a fingerprint keeps
STEPS = 4  # ladder lengths per doubling
LADDER = np.array(sorted({int(2 ** (j / STEPS)) for j in range(3 * STEPS, 40 * STEPS)}), np.int64)
CHUNK = 1 << 18  # code points worked on at once
KEEP_WINDOWS = 1 << 22  # code points up to which the span hashes of a slice are kept
SLICE_CODES = 1 << 20  # code points of a slice, one text at least
MOST_BUCKETS = 1 << 14  # ranges of documents, each with its first row known to the driver
BUCKET_ROWS = 64  # documents of a range at least, on average

_P = np.uint64(PRIME)
_31 = np.uint64(31)


def folded(x: np.ndarray) -> np.ndarray:
    """Residues of numbers below 2^63."""
    x = (x & _P) + (x >> _31)
    x = (x & _P) + (x >> _31)
    x[x == _P] = 0
    return x


class Powers:
    """Powers of a number at any exponent, from two tables: exponents below ``CHUNK`` and multiples of it."""

    def __init__(self, base: int):
        low = np.ones(1, np.uint64)
        while len(low) < CHUNK:
            low = np.concatenate((low, folded(low * np.uint64(pow(base, len(low), PRIME)))))
        self.low, self.step, self.high = low, pow(base, CHUNK, PRIME), np.ones(1, np.uint64)

    def _reach(self, last: int) -> None:
        while len(self.high) * CHUNK <= last:
            more = np.uint64(pow(self.step, len(self.high), PRIME))
            self.high = np.concatenate((self.high, folded(self.high * more)))

    def run(self, start: int, count: int) -> np.ndarray:
        """Exponents ``start`` .. ``start + count``; ``start`` is a multiple of ``CHUNK`` and ``count`` at most that."""
        self._reach(start)
        return self.low[:count] if start == 0 else folded(self.low[:count] * self.high[start // CHUNK])

    def at(self, exponents: np.ndarray) -> np.ndarray:
        if len(exponents) == 0:
            return np.zeros(0, np.uint64)
        self._reach(int(exponents.max()))
        high = exponents // CHUNK
        return folded(self.low[exponents - high * CHUNK] * self.high[high])


_TABLES: list[tuple[Powers, Powers]] = []


def tables() -> list[tuple[Powers, Powers]]:
    """Powers of each base and of its inverse, made once per worker."""
    if not _TABLES:
        _TABLES.extend((Powers(b), Powers(pow(b, -1, PRIME))) for b in BASES)
    return _TABLES


class Views(NamedTuple):
    """Texts put together from two spans: ``a`` code points from ``i``, then ``b`` from ``j``."""

    i: np.ndarray
    a: np.ndarray
    j: np.ndarray
    b: np.ndarray


class Prefixes:
    """Prefix hashes of several texts laid one after the other."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.sums = [np.zeros(self.n + 1, np.uint32) for _ in BASES]
        for (power, _), out in zip(tables(), self.sums):
            carry = np.uint64(0)
            for at in range(0, self.n, CHUNK):
                part = codes[at : at + CHUNK].astype(np.uint64) + np.uint64(1)
                part *= power.run(at, len(part))
                part = (part & _P) + (part >> _31)
                total = np.cumsum(part)
                total += carry
                total = folded(total)
                out[at + 1 : at + 1 + len(part)] = total
                carry = total[-1]
        self._windows = self._spans(0, max(0, self.n - WINDOW + 1)) if self.n <= KEEP_WINDOWS else None

    def span(self, which: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hash of each span under one base, whatever its place."""
        sums = self.sums[which]
        raw = sums[start + length].astype(np.uint64) + _P - sums[start]
        return folded(folded(raw) * tables()[which][1].at(start))

    def joined(self, which: int, v: Views) -> np.ndarray:
        """Hash of texts put together from two spans: the second is shifted by the length of the first."""
        return folded(self.span(which, v.i, v.a) + folded(self.span(which, v.j, v.b) * tables()[which][0].at(v.a)))

    def joined_pair(self, v: Views) -> np.ndarray:
        return (self.joined(0, v) << _31) | self.joined(1, v)

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the spans of this length at ``i`` and ``j`` are equal."""
        same = np.ones(len(i), bool)
        for which in range(len(BASES)):
            same &= self.span(which, i, length) == self.span(which, j, length)
        return same

    def common_head(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest common extension to the right of ``i`` and ``j``, up to ``most``: binary search on the length."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_] + 1) // 2
            same = self.equal(i[open_], j[open_], mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1
        return low

    def common_tail(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest common extension to the left of the ends ``i`` and ``j``, up to ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_] + 1) // 2
            same = self.equal(i[open_] - mid, j[open_] - mid, mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1
        return low

    def _spans(self, start: int, stop: int) -> np.ndarray:
        """Mixed hashes of the spans of ``WINDOW`` code points that begin in a range."""
        out = np.empty(max(0, stop - start), np.uint64)
        at = start
        while at < stop:
            origin = at // CHUNK * CHUNK
            end = min(stop, origin + CHUNK)
            pair = np.uint64(0)
            for (_, inverse), sums in zip(tables(), self.sums):
                raw = sums[at + WINDOW : end + WINDOW].astype(np.uint64) + _P - sums[at:end]
                pair = (pair << _31) | folded(folded(raw) * inverse.run(origin, end - origin)[at - origin :])
            out[at - start : end - start] = mixed(pair)
            at = end
        return out

    def windows(self, start: int, stop: int) -> np.ndarray:
        return self._windows[start:stop] if self._windows is not None else self._spans(start, stop)

    def smallest(self, start: int, length: int, found: np.ndarray | None = None) -> np.ndarray:
        """The ``SAMPLE`` smallest distinct span hashes of a stretch of one text, with those ``found`` elsewhere."""
        best = np.zeros(0, np.uint64) if found is None else lowest(found)
        for at in range(start, start + length - WINDOW + 1, CHUNK):
            part = self.windows(at, min(at + CHUNK, start + length - WINDOW + 1))
            best = lowest(np.concatenate((best, lowest(part))))
        return best


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads hashes over 40 bits, so that the smallest ones are a random choice of spans."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(24)


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def lowest(values: np.ndarray) -> np.ndarray:
    """The ``SAMPLE`` smallest distinct values in order."""
    most = 4 * SAMPLE
    if len(values) > most:
        few = distinct(np.partition(values, most)[:most])
        if len(few) >= SAMPLE:
            return few[:SAMPLE]
    return distinct(values)[:SAMPLE]


class Print(NamedTuple):
    """A fingerprint: length, hash of the whole text, ladders of prefix and suffix hashes, smallest span hashes."""

    size: int
    whole: int
    front: bytes
    back: bytes
    sample: np.ndarray

    def __str__(self) -> str:
        spans = self.sample.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()
        return f"{self.size:x}.{self.whole:016x}.{self.front.hex()}.{self.back.hex()}.{spans}"


def parsed(text: str) -> Print:
    size, whole, front, back, spans = text.split(".")
    raw = np.frombuffer(bytes.fromhex(spans), np.uint8).reshape(-1, 5)
    sample = np.concatenate((np.zeros((len(raw), 3), np.uint8), raw), axis=1).reshape(-1).view(">u8").astype(np.uint64)
    return Print(int(size, 16), int(whole, 16), bytes.fromhex(front), bytes.fromhex(back), sample)


def _rung(a: bytes, b: bytes) -> int:
    """Length of the last ladder hash that two texts share: equal ones come first, so it is found by halving."""
    steps = min(len(a), len(b)) // 3
    at = bisect_left(range(steps), True, key=lambda k: a[3 * k : 3 * k + 3] != b[3 * k : 3 * k + 3])
    return int(LADDER[at - 1]) if at else 0


def likeness(x: Print | str, y: Print | str) -> float:
    """Estimated share of two texts that is the same, 0 to 1, from their fingerprints alone; 1 for equal texts.

    The larger of two estimates: the Dice coefficient of the sets of spans, and the common prefix and suffix over the longer text.
    """
    x, y = (parsed(p) if isinstance(p, str) else p for p in (x, y))
    if x[:2] == y[:2]:
        return 1.0
    least, most = sorted((x.size, y.size))
    if least == 0:
        return 0.0
    ends = min(_rung(x.front, y.front) + _rung(x.back, y.back), least) / most
    every = np.sort(np.concatenate((x.sample, y.sample)))
    twice = every[1:] == every[:-1]
    both, union = every[1:][twice], every[np.concatenate(([True], ~twice))] if len(every) else every
    if max(len(x.sample), len(y.sample)) >= SAMPLE:  # else both hold all their spans
        union = union[:SAMPLE]
    shared = int(np.searchsorted(both, union[-1], side="right")) / len(union) if len(union) else 0.0
    return float(max(min(2 * shared / (1 + shared), 2 * least / (least + most)), ends))


def prints(prefixes: Prefixes, v: Views) -> list[Print]:
    """Fingerprints of texts put together from two spans."""
    size = v.a + v.b
    whole = prefixes.joined_pair(v)
    steps = np.searchsorted(LADDER, size, side="right")
    row = np.repeat(np.arange(len(size)), steps)
    rung = LADDER[np.arange(len(row)) - np.repeat(np.cumsum(steps) - steps, steps)]
    a, b = np.minimum(rung, v.a[row]), np.minimum(rung, v.b[row])
    ladders = []
    for part in (
        Views(v.i[row], a, v.j[row], rung - a),  # prefixes
        Views(v.i[row] + v.a[row] - (rung - b), rung - b, v.j[row] + v.b[row] - b, b),  # suffixes
    ):
        rungs = mixed(prefixes.joined(0, part)) >> np.uint64(16)
        ladders.append(rungs.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes())
    # spans that begin in the first part and end in the second; a text below WINDOW is one span
    first = np.maximum(0, v.a - WINDOW + 1)
    across = np.maximum(0, np.minimum(v.a - 1, size - WINDOW) - first + 1)
    short = size < WINDOW
    first, across = np.where(short, 0, first), np.where(short, size > 0, across).astype(np.int64)
    row = np.repeat(np.arange(len(size)), across)
    begin = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(across) - across, across)
    length = np.minimum(size[row], WINDOW)
    inside = np.minimum(v.a[row] - begin, length)
    mid = mixed(prefixes.joined_pair(Views(v.i[row] + begin, inside, v.j[row], length - inside)))
    out, done, ends = [], 0, np.cumsum(across)
    at = np.concatenate(([0], np.cumsum(steps))) * 3
    for k in range(len(size)):
        spans = prefixes.smallest(int(v.i[k]), int(v.a[k]), mid[done : ends[k]])
        if v.b[k] >= WINDOW:
            spans = prefixes.smallest(int(v.j[k]), int(v.b[k]), spans)
        done = ends[k]
        out.append(Print(int(size[k]), int(whole[k]), ladders[0][at[k] : at[k + 1]], ladders[1][at[k] : at[k + 1]], spans))
    return out


def laid_out(texts: list[str]) -> tuple[Prefixes, np.ndarray, np.ndarray]:
    """Prefix hashes of the texts, where each begins, and their lengths."""
    size = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return Prefixes(codes), np.cumsum(size) - size, size


def plain(start: np.ndarray, size: np.ndarray) -> Views:
    zero = np.zeros_like(size)
    return Views(start, size, start, zero)


_PRINTED = "key long, n_chars long, fingerprint string"


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begin = room = 0
        for k, t in enumerate([*texts, None]):
            if t is None or room + len(t) > SLICE_CODES:
                if begin < k:
                    found = prints((p := laid_out(texts[begin:k]))[0], plain(*p[1:]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[begin:k], pa.int64()), pa.array([x.size for x in found], pa.int64()), pa.array([str(x) for x in found], pa.string())],
                        ["key", "n_chars", "fingerprint"],
                    )
                begin, room = k, 0
            room += len(t or "")


def text_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_chars and fingerprint of every row, in one scan. A null text counts as empty; repeated rows stay; other
    columns are not kept; an empty table gives no rows."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return map_arrow(rows, _printed, _PRINTED).withColumnRenamed("key", key)


def order_key(key: Column, text: Column) -> Column:
    """Text that sorts like: largest key first, null keys last, then by the hash of the text."""
    low = F.lit(-(1 << 63))

    def digits(c: Column) -> Column:
        return F.lpad(F.hex(c.bitwiseXOR(low)), 16, "0")

    value = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    return F.concat(F.when(key.isNull(), "1").otherwise("0"), digits(F.bitwise_not(value)), digits(F.xxhash64(text)))


def range_starts(rows: DataFrame, most: int = MOST_BUCKETS, least: int = BUCKET_ROWS) -> list[str]:
    """First keys of the ranges, in order: the first of all, and a random share of the keys (at most about ``most``).

    A range begins at a row of the table, so it is known without looking at any neighbour.
    """
    share = max(least, rows.count() // most)
    chosen = rows.where(F.pmod(F.xxhash64("key"), F.lit(share)) == 0).select("key").distinct()
    first = rows.agg(F.min("key").alias("key"))
    return sorted({r.key for r in chosen.union(first).collect() if r.key is not None})


_PAIRED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, edited_head long, edited_tail long, next_head long"
)


def _pairs(ids: list, texts: list[str], own: list[bool]) -> pa.RecordBatch:
    """Results of all texts but the last; the next text of each is the one behind it. Only rows marked ``own`` count."""
    prefixes, start, size = laid_out(texts)
    i, n, j, after = start[:-1], size[:-1], start[1:], size[1:]
    out = n // 3
    new, stay = np.minimum(out, after), n - out
    edits = Views(i, stay, j, new)
    whole, edited = prints(prefixes, plain(start, size)), prints(prefixes, edits)
    # where the edit leaves equal text at its place, the common prefix goes on beyond it
    head = stay + prefixes.common_head(i + stay, j, np.minimum(out, new))
    tail = prefixes.common_tail(i + n, j + new, np.minimum(n, new))
    through = tail == new  # all of the new text: goes on in what stayed before it
    rest = prefixes.common_tail(i + n - new, i + stay, np.where(through, np.minimum(n - new, stay), 0))
    tail = np.where(through, tail + rest, tail)
    ahead = prefixes.common_head(i, j, np.minimum(n, after))
    rows = []
    for k, mine in enumerate(own[:-1]):
        if mine:
            text = texts[k][: stay[k]] + texts[k + 1][: new[k]]
            rows.append(
                (
                    ids[k], int(n[k]), hashlib.sha256(text.encode()).hexdigest(), str(whole[k]), str(edited[k]),
                    likeness(whole[k], edited[k]), likeness(whole[k], whole[k + 1]), int(head[k]), int(tail[k]), int(ahead[k]),
                )
            )
    fields = [f.split() for f in _PAIRED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [f for f, _ in fields])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range, each range followed by the first row of the next one (not its own)."""
    ids, texts, own, room = [], [], [], 0
    for batch in batches:
        for key, text, extra in zip(*(batch.column(k).to_pylist() for k in range(3))):
            ids.append(key)
            texts.append(text)
            own.append(not extra)
            room += len(text)
            if room > SLICE_CODES and len(ids) > 1:
                yield _pairs(ids, texts, own)
                ids, texts, own, room = ids[-1:], texts[-1:], own[-1:], len(text)
    if len(ids) > 1:
        yield _pairs(ids, texts, own)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with what they have in common.

    The edited text has its last third (floor of code points / 3) replaced by as many first code points of the next
    document, or all it has. The next document has the next smaller doc_id; the last one is followed by the first.
    Null ids come last, rows with the same id are ordered by a hash of their texts, repeated rows follow one another. A null
    text counts as empty; a document alone is its own next; an empty table gives no rows; other columns are not read.

    ``near_edited`` and ``near_next`` are :func:`likeness` of the fingerprints. ``edited_head`` and ``edited_tail``, the lengths of the
    longest common prefix and suffix of text and edited text, and ``next_head``, that of text and next text, are exact up to a
    collision of two 31-bit hashes.

    The documents are cut into ranges that begin at rows chosen by a hash, each range's first row also goes to the
    range before, so the texts are shuffled once and no task needs another one's rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), order_key(F.col("doc_id"), text).alias("key"))
    starts = range_starts(rows.select("key"))
    ship_package(spark)
    shared = spark.sparkContext.broadcast(starts)

    @F.pandas_udf("array<int>")
    def ranges(key):
        known = np.array(shared.value, "S")
        mine = key.to_numpy().astype("S")
        at = np.searchsorted(known, mine, side="right") - 1
        first = known[at] == mine
        # the range and, for its first row, the range before as an odd number
        return pd.Series([[2 * a, 2 * ((a - 1) % len(known)) + 1] if f else [2 * a] for a, f in zip(at.tolist(), first.tolist())])

    dealt = rows.withColumn("place", F.explode(ranges("key"))).withColumns(
        {"part": F.expr("place div 2").cast("int"), "extra": F.col("place") % 2 == 1}
    )
    ordered = dealt.repartition("part").sortWithinPartitions("part", "extra", "key")
    return map_arrow(ordered.select("doc_id", "text", "extra"), _neighbours, _PAIRED)
