"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by naive Bayes log-count ratios.

Features are n-grams of one to three words and of one to three word shapes (letter case, digits, symbols, last character,
equality with the word before), told apart by 63 bits of hash and kept in two spaces. The model knows those that two rows of a bounded
sample of labelled rows share, and is fitted on them on the driver; others are ignored. Every document is scored where it lies. A text's words and shapes
are scaled to unit length apart, so the many words of a long text do not drown its shapes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroloom.llm.text import map_arrow, slices, texts_of, words_of

WORD_SPACE = np.uint64(1 << 63)  # set in the codes of words, not in those of shapes
SAMPLE_ROWS = 8_000  # labelled rows that the model is fitted on, at most
ROW_FEATURES = 12_000  # features of a row that it is fitted on, at most: those with the smallest hash, from the whole text
PROBE_BITS = 27  # a table of so many bits tells most unknown features from known ones
THRESHOLD = 0.7
COST = 0.1
EPOCHS = 20
SMOOTHING = 1.0
HELD_OUT = 2  # remainder of the key's CRC by 4 that is never learnt from
_KINDS = [(re.compile(p), c) for p, c in ((r"^[^\W\d_]*[a-zà-ÿ][^\W\d_]*$", "w"), (r"^[^\W\d_]+$", "W"), (r"^\d+$", "9"))]


def shape(word: str) -> str:
    """Case and kind of a word, and its last character if that is no letter."""
    core = word.strip("#*$%&|<>!?.,;:()[]{}\"'-_=+/\\~^@")
    tail = word[-1] if not word[-1].isalnum() else ""
    kind = "-" if not core else next((c for p, c in _KINDS if p.match(core)), "x")
    return kind + ("'" if core[:1].isupper() else "") + tail + ("+" if len(word) > 24 else "")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Probe:
    """A bit for every value of the last bits of a code: set if a known code has it."""

    def __init__(self, codes: np.ndarray):
        self.table = np.zeros(1 << (PROBE_BITS - 3), np.uint8)
        place = codes & np.uint64((1 << PROBE_BITS) - 1)
        np.bitwise_or.at(self.table, place >> np.uint64(3), np.left_shift(1, (place & np.uint64(7)).astype(np.uint8), dtype=np.uint8))

    def may_hold(self, codes: np.ndarray) -> np.ndarray:
        place = codes & np.uint64((1 << PROBE_BITS) - 1)
        return (self.table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def indicators(texts: pa.Array, probe: Probe | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The codes of the distinct features of each text one after the other, shapes before words, and how many each has; a text
    without words has one. With a ``probe`` only those that it may hold, so that the others are never sorted."""
    flat, counts = words_of(texts)
    coded = flat.dictionary_encode()
    words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    digest = xxhash.xxh64_intdigest
    word = np.fromiter((digest(w) for w in words), np.uint64, len(words))[at]
    kinds = [shape(w) for w in words]
    known = {k: digest(k, 1) for k in set(kinds)}
    form = np.fromiter((known[k] for k in kinds), np.uint64, len(words))[at]
    row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    inside = row[1:] == row[:-1]
    form = form.copy()
    form[1:][inside & (at[1:] == at[:-1])] ^= np.uint64(0x5555555555555555)  # the same word again
    rows, codes = [], []

    def take(where: np.ndarray, found: np.ndarray) -> None:
        if probe is not None:
            held = probe.may_hold(found)
            where, found = where[held], found[held]
        rows.append(where)
        codes.append(found)

    take(row, _mixed(word) | WORD_SPACE)
    take(row, _mixed(form) & ~WORD_SPACE)
    pair = _mixed(form[:-1] * np.uint64(3) + form[1:])
    words_2 = _mixed(word[:-1] * np.uint64(3) + word[1:])
    take(row[1:][inside], pair[inside] & ~WORD_SPACE)
    take(row[1:][inside], words_2[inside] | WORD_SPACE)
    if len(form) > 2:
        three = inside[1:] & inside[:-1]
        take(row[2:][three], _mixed(pair[:-1] * np.uint64(5) + form[2:])[three] & ~WORD_SPACE)
        take(row[2:][three], _mixed(words_2[:-1] * np.uint64(5) + word[2:])[three] | WORD_SPACE)
    bare = np.flatnonzero(counts == 0).astype(np.int32)
    take(bare, np.zeros(len(bare), np.uint64))
    row, code = np.concatenate(rows), np.concatenate(codes)
    by = np.lexsort((code, row))
    row, code = row[by], code[by]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    return code[new], np.bincount(row[new], minlength=len(counts))


def known_features(codes: np.ndarray, counts: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted vocabulary of the codes that it holds, and how many each text has."""
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(vocabulary):
        return np.empty(0, np.int64), np.zeros(len(counts), np.int64)
    at = np.searchsorted(vocabulary, codes)
    at[at == len(vocabulary)] = 0
    held = vocabulary[at] == codes
    return at[held], np.bincount(row[held], minlength=len(counts))


def scaled_values(features: np.ndarray, counts: np.ndarray, ratio: np.ndarray, shapes: int) -> np.ndarray:
    """Ratio of each feature, scaled so that a text's shapes (the features below ``shapes``) and its words have unit length apart."""
    value = ratio[features]
    group = 2 * np.repeat(np.arange(len(counts)), counts) + (features >= shapes)
    length = np.sqrt(np.bincount(group, value * value, minlength=2 * len(counts)))
    return value / np.maximum(length, 1e-9)[group]


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, size: int) -> np.ndarray:
    """Zero for features that none of the rows has."""
    counts = [np.full(size, SMOOTHING) for _ in range(2)]
    for x, g in zip(rows, good):
        counts[int(g)][x] += 1
    none = counts[0] + counts[1] <= 2 * SMOOTHING
    for c in counts:  # in place: the vocabulary is long
        c /= c.sum()
    bad, ratio = counts
    ratio /= bad
    np.log(ratio, out=ratio)
    ratio[none] = 0.0
    return ratio


def dual_descent(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray, shapes: int) -> tuple[np.ndarray, float]:
    """Hinge-loss support vectors by dual coordinate descent; a row's two parts have unit length, the classes equal cost."""
    y = np.where(good, 1.0, -1.0)
    share = np.array([max((~good).sum(), 1), max(good.sum(), 1)]) / len(rows)
    most = COST / (2 * share[good.astype(int)])
    value = [scaled_values(x, np.array([len(x)]), ratio, shapes) for x in rows]
    square = np.array([v @ v for v in value]) + 1  # and 1 for the bias
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            x, v = rows[i], value[i]
            slope = y[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), most[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[x] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def _sigmoid_fit(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score by Newton steps on smoothed targets."""
    up, down = good.sum(), (~good).sum()
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (p - target) + 1e-6 * theta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-6)), float(theta[1])


def _margin(w: np.ndarray, bias: float, ratio: np.ndarray, rows: list[np.ndarray], shapes: int) -> np.ndarray:
    return np.array([w[x] @ scaled_values(x, np.array([len(x)]), ratio, shapes) + bias for x in rows])


def _packed(a: np.ndarray) -> tuple[bytes, int, str]:
    """An array's bytes compressed without loss, the first bytes of all elements before the second ones."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True), a.nbytes, a.dtype.str


def _unpacked(data: bytes, size: int, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


@dataclass
class NbSvm:
    """Sorted codes of the known features, the first ``shapes`` of them shapes; weights of the ratio-scaled indicators, bias, and
    the sigmoid that turns a margin into a score."""

    vocabulary: np.ndarray
    shapes: int
    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    ratio: np.ndarray

    def __getstate__(self) -> dict:
        """Spark keeps a copy of the pickled model on the disk of each executor, so it travels compressed."""
        gaps = np.diff(self.vocabulary, prepend=np.uint64(0))
        rest = {k: v for k, v in self.__dict__.items() if k != "probe"}
        return rest | {"vocabulary": _packed(gaps), "weights": _packed(self.weights), "ratio": _packed(self.ratio)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.vocabulary, self.weights, self.ratio = np.cumsum(_unpacked(*state["vocabulary"]), dtype=np.uint64), _unpacked(*state["weights"]), _unpacked(*state["ratio"])

    @cached_property
    def probe(self) -> Probe:
        return Probe(self.vocabulary)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        features, counts = known_features(*indicators(texts, self.probe), self.vocabulary)
        value = scaled_values(features, counts, self.ratio, self.shapes)
        row = np.repeat(np.arange(len(counts)), counts)
        margin = np.bincount(row, self.weights[features] * value, minlength=len(counts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def shared_codes(codes: list[np.ndarray]) -> np.ndarray:
    """Sorted codes that at least two rows have (a row has a code once); sorted in place, as a copy would double them."""
    flat = np.concatenate(codes)
    flat.sort()
    again = np.zeros(len(flat), bool)
    np.equal(flat[1:], flat[:-1], out=again[1:])
    again[1:] &= ~again[:-1]  # the second of equal ones
    return flat[again]


def fitted(codes: list[np.ndarray], good: np.ndarray) -> NbSvm:
    """Ratios, support vectors, and the sigmoid from margins of three folds that the fold's own model has not seen."""
    if good.all() or not good.any():  # one class or none: a constant score
        p = (good.sum() + 1) / (len(good) + 2)
        return NbSvm(np.empty(0, np.uint64), 0, np.zeros(0), 0.0, 1.0, float(np.log(p / (1 - p))), np.zeros(0))
    vocabulary = shared_codes(codes)
    shapes, size = int(np.searchsorted(vocabulary, WORD_SPACE)), len(vocabulary)
    rows = [known_features(x, np.array([len(x)]), vocabulary)[0].astype(np.int32) for x in codes]
    codes.clear()  # the caller's list too: the codes are the largest thing on the driver
    fold = np.arange(len(rows)) % 3
    margin = np.zeros(len(rows))
    for k in range(3):
        seen = [x for x, f in zip(rows, fold) if f != k]
        if good[fold != k].all() or not good[fold != k].any():
            continue
        ratio = log_count_ratios(seen, good[fold != k], size)
        w, bias = dual_descent(seen, good[fold != k], ratio, shapes)
        margin[fold == k] = _margin(w, bias, ratio, [x for x, f in zip(rows, fold) if f == k], shapes)
    slope, offset = _sigmoid_fit(margin, good)
    ratio = log_count_ratios(rows, good, size)
    w, bias = dual_descent(rows, good, ratio, shapes)
    return NbSvm(vocabulary, shapes, w.astype(np.float32), bias, slope, offset, ratio.astype(np.float32))


def remainder(key: str = "doc_id"):
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4))


def sampled_labels(labels: DataFrame, key: str = "doc_id", label: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Up to ``rows`` labelled keys outside the held-out fold, chosen by a hash of the key."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (remainder(key) != HELD_OUT))
    usable = usable.groupBy(F.col(key).cast("long").alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    return usable.orderBy(F.xxhash64("__id"), "__id").limit(rows)


def fit_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS, features: int = ROW_FEATURES
) -> NbSvm:
    """The model of a bounded sample: ``rows`` labelled keys at most, one row of each (that with the smallest hash of its text), and
    ``features`` features of a row at most. These, not the texts, come to the driver: ``8 * rows * features`` bytes at most."""
    sample = F.broadcast(sampled_labels(labels, key, label, rows))  # at most ``rows`` pairs of numbers
    content = F.coalesce(F.col(text), F.lit(""))
    chosen = docs.select(F.col(key).cast("long").alias("__id"), content.alias("text")).join(sample, "__id")
    chosen = chosen.groupBy("__id").agg(F.max("__label").alias("__label"), F.min_by("text", F.xxhash64("text")).alias("text"))

    def smallest(codes: np.ndarray) -> np.ndarray:
        return codes if len(codes) <= features else np.sort(codes[np.argpartition(_mixed(codes), features)[:features]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, counts = indicators(texts_of(part, "text"))
                cut = np.split(found, np.cumsum(counts)[:-1])
                packed = pa.array([smallest(x).tobytes() for x in cut], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("__id"), part.column("__label"), packed], ["id", "label", "features"])

    # as one Arrow table, whose buffers the rows' codes share: objects for each row would be held several times over
    got = map_arrow(chosen.select("__id", "__label", "text"), run, "id long, label int, features binary").toArrow()
    ids, good = got["id"].to_pylist(), [x == 1 for x in got["label"].to_pylist()]
    codes = [np.frombuffer(x.as_buffer(), np.uint64) for x in got["features"]]
    order = sorted(range(len(ids)), key=lambda i: (xxhash.xxh64_intdigest(str(ids[i])), xxhash.xxh64_intdigest(codes[i])))
    codes, good = [codes[i] for i in order], np.array([good[i] for i in order], bool)
    del got
    return fitted(codes, good)


def scored(df: DataFrame, model: NbSvm, text: str = "text", name: str = "score") -> DataFrame:
    """Append the score of each whole text, 0 to 1; null counts as empty. Other columns stay; one called like ``name`` is an error."""
    if name in df.columns:
        raise ValueError(f"column {name} exists already")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                column = pa.array(shared.value.scores(texts_of(part, text)), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, name])

    ddl = df.select("*", F.lit(0.0).alias(name)).schema
    return map_arrow(df, run, ddl)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. Without labels every score is one half; null keys are not held out.

    Repeated rows are scored each; of those with a labelled key one is learnt from. Columns beside doc_id and text are not
    read, whatever they are called.
    """
    model = fit_quality(docs, labels)
    out = scored(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id",
        F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
