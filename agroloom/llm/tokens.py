"""Exact token counts through two tiers of known lengths, without a shuffle of pre-tokens.

For a tokenizer that drops white space, the pieces of a text between ASCII white space (its pre-tokens here)
are encoded independently, so a text's count is the sum of theirs. First tier: a broadcast table
of frequent pre-tokens and their lengths. Second tier: a cache in each worker, filled by the
library itself. Both only save work; every count is the library's.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroloom.llm.text import map_arrow, slices, sums_by_row, texts_of, words_of

TABLE_SIZE = 32_768  # pre-tokens in the broadcast table
TASK_TABLE = 8_192  # frequent pre-tokens that a task reports
CACHE_SIZE = 400_000  # pre-tokens a worker remembers before it starts over
TOKEN_LIMIT = 2048
LONGEST = 64  # bytes of a pre-token that may enter the tables


def _drops_white_space(settings: dict) -> bool:
    """The pre-tokenizer removes all that its pattern does not match, and the pattern matches no white space."""
    steps = settings.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    return any(
        s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert") and "\\s" in s["pattern"].get("Regex", "")
        or s.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")
        for s in steps
    )


@lru_cache(maxsize=2)
def tokenizer_at(path: str):
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        if not _drops_white_space(json.load(f)):
            raise ValueError("the tokenizer keeps white space, so words are not independent")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def lengths_of(path: str, units: list[str]) -> list[int]:
    return [len(e) for e in tokenizer_at(path).encode_batch_fast(units, add_special_tokens=False)]


def _top(tables: list[pa.Table], n: int) -> pa.Table:
    """The n most frequent units of some tables of (unit, n) together."""
    summed = pa.concat_tables(tables).group_by("unit").aggregate([("n", "sum")]).rename_columns(["unit", "n"])
    if summed.num_rows > n:
        summed = summed.take(pc.select_k_unstable(summed, n, [("n", "descending"), ("unit", "ascending")]))
    return summed


def frequent_units(df: DataFrame, text: str = "text") -> list[str]:
    """The pre-tokens that most tasks meet most often, ``TABLE_SIZE`` at most.

    Each task sums what it reads in a table of bounded size and reports its most frequent ones; only these
    few rows are added up. The choice affects speed alone.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = pa.table({"unit": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        seen, waiting = [empty], 0
        for batch in batches:
            for part in slices(batch, text):
                flat, _ = words_of(texts_of(part, text))
                found = pc.value_counts(flat.filter(pc.less_equal(pc.binary_length(flat), LONGEST)))
                seen.append(pa.Table.from_arrays(found.flatten(), ["unit", "n"]))
                waiting += len(found)
                if waiting > 32 * TASK_TABLE:
                    seen, waiting = [_top(seen, 8 * TASK_TABLE)], 0
        top = _top(seen, TASK_TABLE)
        yield from top.filter(pc.greater(top.column("n"), 1)).select(["unit", "n"]).combine_chunks().to_batches()

    sums = map_arrow(df.select(text), count, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    return [r["unit"] for r in sums.orderBy(F.desc("n"), "unit").limit(TABLE_SIZE).collect()]


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """Append the number of tokens of each whole text.

    Null counts as empty (0). Special strings inside texts count as the tokenizer's default does. Other columns stay;
    one called like ``name`` is an error. An empty table gives an empty result.
    """
    if name in df.columns:
        raise ValueError(f"column {name} exists already")
    spark = df.sparkSession
    units = frequent_units(df, text)
    table = spark.sparkContext.broadcast((units, lengths_of(tokenizer_path, units)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(table.value[0], pa.string())
        known_lengths = np.array(table.value[1], np.int64)
        cache: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, text):
                flat, counts = words_of(texts_of(part, text))
                place = pc.index_in(flat, value_set=known)
                lengths = np.zeros(len(flat), np.int64)
                missing = place.is_null().to_numpy(zero_copy_only=False)
                lengths[~missing] = known_lengths[place.drop_null().to_numpy()]
                if missing.any():
                    coded = flat.filter(pa.array(missing)).dictionary_encode()
                    words = coded.dictionary.to_pylist()
                    new = [w for w in words if w not in cache]
                    fresh = dict(zip(new, lengths_of(tokenizer_path, new)))
                    own = np.fromiter((fresh[w] if w in fresh else cache[w] for w in words), np.int64, len(words))
                    lengths[missing] = own[coded.indices.to_numpy()]
                    if len(cache) > CACHE_SIZE:
                        cache.clear()
                    cache.update((w, n) for w, n in fresh.items() if len(w) <= LONGEST)
                column = pa.array(sums_by_row(lengths, counts), pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, name])

    return map_arrow(df, run, T.StructType([*df.schema.fields, T.StructField(name, T.LongType(), False)]))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    counted = count_tokens(docs.select("doc_id", "text"), tokenizer_path)
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
