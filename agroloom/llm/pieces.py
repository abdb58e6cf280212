"""SentencePiece encoding and decoding with vectorised merge rounds.

Encoding keeps the symbols of many words in flat numpy arrays. A round finds the best pair rank of
every word (a segmented minimum), merges all its leftmost occurrences at once, drops the
swallowed symbols, and takes words without a pair out; it ends when none is left. Merging all
occurrences together equals the library's one-by-one order as long as a merged piece can't
form a pair of the same or a better rank; for the few pieces that can, only the leftmost occurrence is
merged in that round.

Spark deals the documents; a worker keeps the ids of words it has met in a store of bounded size.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.llm.text import listed, map_arrow, ragged, slices, texts_of

SPACE = "▁"
STORE_WORDS = 400_000  # words a worker remembers before it starts over
STORE_IDS = 4_000_000
SLICE = 2 << 20  # text bytes encoded together
NEVER = np.int32(2**31 - 1)
LONG_WORD = 256  # symbols from which tied merges go through a heap


class PieceModel:
    """Pair ranks and piece texts of a BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        texts = [sp.id_to_piece(i) for i in range(n)]
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
        byte = np.array([sp.is_byte(i) for i in range(n)])
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        normal = {texts[i]: i for i in range(n) if not special[i] and not byte[i]}
        self.unknown_id = sp.unk_id()
        self.byte_ids = {int(texts[i][3:5], 16): i for i in range(n) if byte[i]}
        self._symbols(normal, n)
        self._pairs(normal, np.array([sp.get_score(i) for i in range(n)]))
        self._words(normal)
        self._decoder(texts, byte, special)

    def _symbols(self, normal: dict[str, int], n: int) -> None:
        """A symbol for each character of a piece: its own piece, or a number beyond the ids."""
        self.of_char = np.full(0x110000, -1, np.int32)
        extra = n
        for c in sorted({c for text in normal for c in text}):
            if c in normal:
                self.of_char[ord(c)] = normal[c]
            else:
                self.of_char[ord(c)], extra = extra, extra + 1
        self.base, self.char_of_extra = n, {}
        for c in np.flatnonzero(self.of_char >= n):
            self.char_of_extra[int(self.of_char[c])] = int(c)
        self.width = extra

    def _pairs(self, normal: dict[str, int], scores: np.ndarray) -> None:
        """Keys ``left * width + right`` in order, with rank and result of each pair."""
        symbol = dict(normal) | {chr(c): s for s, c in self.char_of_extra.items()}
        order = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        keys, made = [], []
        for text, i in normal.items():
            for cut in range(1, len(text)):
                a, b = symbol.get(text[:cut]), symbol.get(text[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    made.append(i)
        keys, made = np.array(keys, np.int64), np.array(made, np.int32)
        by = np.argsort(keys)
        keys, made = keys[by], made[by]
        ranks = order[made]
        # a piece that can go on to a pair of its own or a better rank
        early = np.zeros(int(order.max()) + 1, bool)
        for part in (keys // self.width, keys % self.width):
            inside = part < self.base
            own = order[part[inside]]
            early[own[ranks[inside] <= own]] = True
        self.early = early
        bits = int(np.ceil(np.log2(max(4 * len(keys), 16))))
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.slot_key = np.full(size, -1, np.int64)
        self.slot_rank = np.full(size, NEVER, np.int32)
        self.slot_made = np.full(size, -1, np.int32)
        left = np.arange(len(keys))
        place = self._home(keys)
        while len(left):  # open addressing, all keys of a round at once
            free = self.slot_key[place] < 0
            taken, first = np.unique(place[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.slot_key[taken] = keys[left[put]]
            self.slot_rank[taken] = ranks[left[put]]
            self.slot_made[taken] = made[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, place = left[rest], (place[rest] + 1) % size

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; ``NEVER`` where it makes no piece."""
        keys = left.astype(np.int64) * self.width + right
        keys[(left < 0) | (right < 0)] = -2
        place = self._home(keys)
        found = self.slot_key[place]
        rank, made = self.slot_rank[place], self.slot_made[place]
        wrong = np.flatnonzero((found != keys) & (found >= 0))
        rank[found < 0] = NEVER
        while len(wrong):
            place[wrong] = (place[wrong] + 1) % len(self.slot_key)
            at = place[wrong]
            found = self.slot_key[at]
            rank[wrong] = np.where(found < 0, NEVER, self.slot_rank[at])
            made[wrong] = self.slot_made[at]
            wrong = wrong[(found != keys[wrong]) & (found >= 0)]
        return rank, made

    def _words(self, normal: dict[str, int]) -> None:
        """Where a normalised text can be cut: no piece has a space mark behind another character."""
        if any(SPACE in text.lstrip(SPACE) for text in normal):
            self.unit = re.compile("(?s).+")
        elif any("\n" in text for text in normal):
            self.unit = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            self.unit = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def _decoder(self, texts: list[str], byte: np.ndarray, special: np.ndarray) -> None:
        raw = [bytes([int(t[3:5], 16)]) if byte[i] else t.replace(SPACE, " ").encode() for i, t in enumerate(texts)]
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_lengths = np.array([len(x) for x in raw], np.int64)
        self.piece_starts = np.cumsum(self.piece_lengths) - self.piece_lengths
        self.special = special
        self.opens_with_space = np.array([not byte[i] and t.startswith(SPACE) for i, t in enumerate(texts)])
        # the library takes off one space in front if it puts one there
        probe = self.processor.encode("a")
        self.strips = bool(len(probe)) and self.processor.id_to_piece(probe[0]).startswith(SPACE)

    def units(self, text: str) -> list[str]:
        return self.unit.findall(self.processor.normalize(text)) if text else []

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each word has."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_char[codes]
        symbols[symbols < 0] = -1 - codes[symbols < 0].astype(np.int32)  # unknown characters
        done_symbols, done_word = [], []
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        rank = np.full(len(symbols), NEVER, np.int32)
        made = np.full(len(symbols), -1, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], made[inner] = self.look_up(symbols[inner], symbols[inner + 1])
        while len(symbols):
            first = np.concatenate(([True], word[1:] != word[:-1]))
            starts = np.flatnonzero(first)
            best = np.minimum.reduceat(rank, starts)
            segment = np.cumsum(first) - 1
            best_here = best[segment]
            finished = best == NEVER
            early = self.early[np.where(finished, 0, best)] & ~finished
            if early.any():
                lengths = np.diff(np.append(starts, len(symbols)))
                for s in np.flatnonzero(early & (lengths > LONG_WORD)):
                    a = starts[s]
                    out = self.merge_in_order(symbols[a : a + lengths[s]].tolist())
                    done_symbols.append(np.array(out, np.int32))
                    done_word.append(np.full(len(out), word[a], np.int32))
                    symbols[a : a + lengths[s]] = np.iinfo(np.int32).min  # dropped below
                    finished[s] = True
            if finished.any():
                over = finished[segment]
                real = over & (symbols != np.iinfo(np.int32).min)
                done_symbols.append(symbols[real])
                done_word.append(word[real])
                symbols, word, rank, made = (x[~over] for x in (symbols, word, rank, made))
                if not len(symbols):
                    break
                best_here, segment = best_here[~over], segment[~over]
            chosen = rank == best_here
            again = chosen[1:] & chosen[:-1] & (word[1:] == word[:-1])
            if again.any():  # in a run of neighbours every second one, from its left end
                at = np.arange(len(chosen))
                head = chosen & ~np.concatenate(([False], again))
                chosen &= (at - np.maximum.accumulate(np.where(head, at, 0))) % 2 == 0
            places = np.flatnonzero(chosen)
            if early.any():
                mine = segment[places]
                lead = np.concatenate(([True], mine[1:] != mine[:-1]))
                places = places[lead | ~early[mine]]
            symbols[places] = made[places]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            moved = np.cumsum(keep) - 1
            places = moved[places]
            symbols, word, rank, made = symbols[keep], word[keep], rank[keep], made[keep]
            touched = np.zeros(len(symbols), bool)
            touched[places] = True
            touched[places[places > 0] - 1] = True
            changed = np.flatnonzero(touched)
            rank[changed] = NEVER
            changed = changed[changed < len(symbols) - 1]
            changed = changed[word[changed + 1] == word[changed]]
            rank[changed], made[changed] = self.look_up(symbols[changed], symbols[changed + 1])
        if not done_symbols:
            return np.empty(0, np.int32), np.zeros(len(words), np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_word)
        by = np.argsort(word, kind="stable")
        symbols, word = symbols[by], word[by]
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.base))
        if len(odd):
            symbols, word = self._fall_back(symbols, word, odd)
        return symbols, np.bincount(word, minlength=len(words)).astype(np.int64)

    def _fall_back(self, symbols, word, odd):
        """Characters without a piece become their bytes' pieces, or the unknown piece."""
        out, owner, last = [], [], 0
        for i in odd.tolist():
            s = int(symbols[i])
            char = chr(-1 - s if s < 0 else self.char_of_extra[s])
            ids = [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown_id]
            out += [symbols[last:i], np.array(ids, np.int32)]
            owner += [word[last:i], np.full(len(ids), word[i], np.int32)]
            last = i + 1
        return np.concatenate([*out, symbols[last:]]), np.concatenate([*owner, word[last:]])

    def merge_in_order(self, symbols: list[int]) -> list[int]:
        """One merge at a time by (rank, place): for long words in which equal ranks follow each other."""
        n = len(symbols)
        nxt, prev, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(a: int) -> None:
            if a >= 0 and nxt[a] < n:
                rank, made = self.look_up(np.array([symbols[a]]), np.array([symbols[nxt[a]]]))
                if rank[0] != NEVER:
                    heapq.heappush(heap, (int(rank[0]), a, symbols[a], symbols[nxt[a]], int(made[0])))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while heap:
            _, a, left, right, made = heapq.heappop(heap)
            b = nxt[a]
            if gone[a] or b >= n or symbols[a] != left or symbols[b] != right:
                continue
            symbols[a], gone[b], nxt[a] = made, True, nxt[b]
            if nxt[a] < n:
                prev[nxt[a]] = a
            offer(prev[a])
            offer(a)
        return [s for s, x in zip(symbols, gone) if not x]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids."""
        lengths = self.piece_lengths[ids]
        raw = self.piece_bytes[ragged(self.piece_starts[ids], lengths)].tobytes()
        sizes = sums_of(lengths, counts)
        ends, last = np.cumsum(sizes), np.cumsum(counts)
        odd = sums_of(self.special[ids].astype(np.int64), counts)
        out = []
        for i in range(len(counts)):
            n = int(counts[i])
            if n == 0:
                out.append("")
                continue
            at, first = int(last[i]) - n, int(ends[i] - sizes[i])
            try:
                if odd[i]:
                    raise ValueError
                skip = self.strips and bool(self.opens_with_space[ids[at]])
                out.append(raw[first + skip : int(ends[i])].decode())
            except ValueError:  # control or unknown pieces, or bytes that are no text
                out.append(self.processor.decode(ids[at : at + n].tolist()))
        return out


def sums_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    last = np.cumsum(counts)
    return total[last] - total[last - counts]


@lru_cache(maxsize=2)
def model_at(path: str) -> PieceModel:
    return PieceModel(path)


class WordStore:
    """Ids of the words met so far in one flat array; starts over when it is full."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.used = 0
        self.starts = np.empty(1 << 14, np.int64)
        self.lengths = np.empty(1 << 14, np.int64)

    def add(self, words: list[str]) -> None:
        ids, lengths = self.model.merge(words)
        n, m = len(self.place), len(self.place) + len(words)
        while m > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[n:m] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n:m] = lengths
        self.used += len(ids)
        self.place.update(zip(words, range(n, m)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        if len(self.place) > STORE_WORDS or self.used > STORE_IDS:
            self.clear()
        units, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self.model.units(text)
            counts[i] = len(found)
            units += found
        if not units:
            return np.empty(0, np.int32), counts
        coded = pa.array(units, pa.string()).dictionary_encode()
        words = listed(coded.dictionary)
        new = [w for w in words if w not in self.place]
        if new:
            self.add(new)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        lengths = self.lengths[at]
        return self.ids[ragged(self.starts[at], lengths)], sums_of(lengths, counts)


def _extended(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    if name in df.columns:
        raise ValueError(f"column {name} exists already")
    return T.StructType([*df.schema.fields, T.StructField(name, kind, False)])


def encode_pieces(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the ids of each whole text as the library gives them (no begin or end ids).

    Null counts as empty; an empty text has an empty list. A column named like ``ids`` is an error,
    every other column is kept as it is. Rows stay independent: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = WordStore(model_at(model_path))
        for batch in batches:
            for part in slices(batch, text, SLICE):
                flat, counts = store.encode(texts_of(part, text).to_pylist())
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                column = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, ids])

    return map_arrow(df, run, _extended(df, ids, T.ArrayType(T.IntegerType(), False)))


def decode_pieces(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Append the text of each list of ids as the library's ``decode`` gives it; null and empty lists give ""."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                lists = part.column(ids)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                column = pa.array(model.decode(flat, counts), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, text])

    return map_arrow(df, run, _extended(df, text, T.StringType()))


def round_trip(df: DataFrame, model_path: str, keep: list[str], text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The columns ``keep``, the ids of each whole text and the text that they decode to, in one pass through a worker.

    Cases as in :func:`encode_pieces` and :func:`decode_pieces`.
    """
    fields = [df.schema[c] for c in keep]
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False), T.StructField(decoded, T.StringType(), False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        store = WordStore(model)
        for batch in batches:
            for part in slices(batch, text, SLICE):
                flat, counts = store.encode(texts_of(part, text).to_pylist())
                back = pa.array(model.decode(flat.astype(np.int64), counts), pa.string())
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                column = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), column, back], [*keep, ids, decoded])

    return map_arrow(df, run, T.StructType([*fields, *added]))


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return round_trip(docs.select("doc_id", "text"), model_path, ["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
