"""SentencePiece, token counts, substring dedup, exact dedup and rules against plain versions."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from brute import counted, covered, frame, odd_documents, rules, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agroloom.llm import exact, pieces, substrings, tokens
from agroloom.llm import rules as line_rules
from agroloom.llm.text import words_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd():
    return odd_documents()


def test_merges_equal_the_library():
    model = pieces.model_at(MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(5)
    chars = "aaaabcdeeinost   \n\t▁.,!é漢字🙂\x00́<s></s>ABC0123456789==--   "
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "a" * 900, " " * 700 + "x", "ab" * 900, "=" * 700, "▁", "x▁y", "<s>"]
    ids, counts = pieces.WordStore(model).encode(texts)
    ends = np.cumsum(counts)
    decoded = model.decode(ids.astype(np.int64), counts)
    for text, end, n, back in zip(texts, ends, counts, decoded):
        want = library.encode(text)
        assert ids[end - n : end].tolist() == want
        assert back == library.decode(want)


def test_decoding_any_ids_equals_the_library():
    model = pieces.model_at(MODEL)
    library = model.processor
    rnd = random.Random(6)
    lists = [[rnd.choice([0, 1, 2, 3, 200, 250, 259, 260, 29871, rnd.randrange(32000)]) for _ in range(rnd.randrange(8))] for _ in range(2000)]
    flat = np.array([i for x in lists for i in x], np.int64)
    assert model.decode(flat, np.array([len(x) for x in lists])) == [library.decode(x) for x in lists]


def test_pieces_of_odd_documents(spark, odd):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = Counter()
    for r in odd:
        ids = library.encode(r[1] or "")
        want[(r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))] += 1
    assert counted(pieces.piece_digests(frame(spark, odd), MODEL)) == want
    assert pieces.piece_digests(frame(spark, []), MODEL).count() == 0
    both = pieces.decode_pieces(pieces.encode_pieces(frame(spark, odd), MODEL), MODEL)
    assert both.where("decoded <> replace(coalesce(text, ''), '▁', ' ')").count() == 0
    with pytest.raises(ValueError):
        pieces.encode_pieces(frame(spark, odd), MODEL, ids="kept")


def test_token_counts(spark, odd):
    library = Tokenizer.from_file(WORDS)
    rnd = random.Random(2)
    parts = ["a", "S", "İ", "Σ", "'s", "1", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "́", "漢", "🙂", "<|endoftext|>", "!", "가", "ᄀ", "ﬁ"]
    rows = odd + [(900 + i, "".join(rnd.choice(parts) for _ in range(40)), None, None, None, None, None, None, None) for i in range(300)]
    want = Counter()
    for r in rows:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        want[(r[0], len((r[1] or "").encode()), n, n > 2048)] += 1
    assert counted(tokens.token_counts(frame(spark, rows), WORDS)) == want
    assert tokens.token_counts(frame(spark, []), WORDS).count() == 0
    with pytest.raises(ValueError):
        tokens.tokenizer_at(public_tokenizers.path("byte_bpe_50k.json"))


def test_words_split_like_bytes():
    texts = ["", " a  b ", "\x0b\x0c\r\n", "a\x1fb\xa0c d", "x"]
    flat, counts = words_of(pa.array(texts))
    assert flat.to_pylist() == [w.decode() for t in texts for w in t.encode().split()]
    assert counts.tolist() == [len(t.encode().split()) for t in texts]


def stripped(rows):
    """(doc_id, n_words, n_removed, hash) with every window held against all others."""
    places = defaultdict(set)
    key = {i: (r[0] is None, r[0] or 0, text_order(r[1])) for i, r in enumerate(rows)}
    for i, r in enumerate(rows):
        w = words(r[1])
        for j in range(len(w) - 19):
            places[tuple(w[j : j + 20])].add((key[i], j))
    first = {k: min(v) for k, v in places.items()}
    out = Counter()
    for i, r in enumerate(rows):
        w = words(r[1])
        gone = covered([j for j in range(len(w) - 19) if first[tuple(w[j : j + 20])] != (key[i], j)], 20)
        out[(r[0], len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))] += 1
    return out


ORDER = {}


def text_order(text):
    return ORDER[text]


def test_substrings(spark, odd):
    df = frame(spark, odd)
    ORDER.update({r[0]: r[1] for r in df.select("text", F.coalesce(F.xxhash64("text"), F.lit(0))).collect()})
    want = stripped(odd)
    digest = ["doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)]
    assert counted(substrings.substring_digests(df)) == want
    # few large buckets, and every bucket too large for a task
    assert counted(substrings.without_repeats(df, buckets=3).select(*digest)) == want
    assert counted(substrings.without_repeats(df, buckets=7, most=1).select(*digest)) == want
    assert substrings.substring_digests(frame(spark, [])).count() == 0


def test_equal_hashes_do_not_confuse_windows():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2, 400)
    starts = np.arange(381)
    first = substrings.first_windows(ids, starts)
    seen = set()
    for s in starts:
        w = tuple(ids[s : s + 20])
        assert first[s] == (w not in seen)
        seen.add(w)


def test_exact_groups(spark, odd):
    groups = defaultdict(list)
    for r in odd:
        groups[r[1] or ""].append(r[0])
    got = exact.exact_groups(frame(spark, odd)).collect()
    assert len(got) == len(odd)
    of = {sha(t): ids for t, ids in groups.items()}
    kept = Counter()
    for r in got:
        ids = of[r["text_sha256"]]
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        assert r["group_size"] == len(ids)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}
    stay = exact.drop_repeats(frame(spark, odd))
    assert stay.columns == frame(spark, odd).columns and stay.count() == len(groups)
    small = exact.mark_repeats(frame(spark, odd), largest=False).where("kept").select("doc_id", F.coalesce("text", F.lit("")))
    assert counted(small) == Counter({(min((i for i in ids if i is not None), default=None), t): 1 for t, ids in groups.items()})
    assert exact.exact_groups(frame(spark, [])).count() == 0


def test_radix_trie():
    rnd = random.Random(8)
    trie, plain = exact.RadixTrie(), defaultdict(list)
    for i in range(3000):
        key = "".join(rnd.choice("ab") for _ in range(rnd.randrange(9))).encode()
        best = rnd.choice([None, rnd.randrange(50)])
        trie.insert(key, best, 1, 1)
        plain[key].append(best)
    for key, node in trie.items():
        ids = plain.pop(key)
        top = max((i for i in ids if i is not None), default=None)
        assert (node.best, node.ties, node.count) == (top, ids.count(top), len(ids))
    assert not plain


def test_owner_lets_finished_subtrees_go(monkeypatch):
    monkeypatch.setattr(exact, "SPILL_BYTES", 10)
    rows = sorted((len(t), hash(t) % 5, t.encode(), i, 1, 1) for i, t in enumerate(["aa", "bb", "aa", "cc", "dd", "bb", "aa", "eeee", "eeee"]))
    out = [r for b in exact._owners(True)(iter([exact._table(rows, exact._LOCAL)])) for r in b.to_pylist()]
    assert {r["text_sha256"]: (r["keep_id"], r["group_size"]) for r in out} == {sha("aa"): (6, 3), sha("bb"): (5, 2), sha("eeee"): (8, 2)}


def test_rules(spark, odd):
    assert counted(line_rules.rule_verdicts(frame(spark, odd))) == Counter(rules([(r[0], r[3], r[1]) for r in odd]))
    assert line_rules.rule_verdicts(frame(spark, [])).count() == 0
    good = line_rules.keep_good(frame(spark, odd))
    assert good.columns == frame(spark, odd).columns
    assert good.count() == sum(x[-1] for x in rules([(r[0], r[3], r[1]) for r in odd]))


def test_line_rule_rejects_depleted_documents(spark):
    own = [(i, " ".join(f"w{i}x{j}" for j in range(30)), None, "h", 0, None, None, None, None) for i in range(60)]
    shared = "\n".join(" ".join(f"shared{a}{j}" for j in range(8)) for a in range(6))
    copied = [(100 + i, f"{shared}\nown{i}", None, "h", 0, None, None, None, None) for i in range(30)]
    got = {r["doc_id"]: r for r in line_rules.rule_verdicts(frame(spark, own + copied)).collect()}
    assert all(got[r[0]]["kept"] and got[r[0]]["n_common_words"] == 0 for r in own)
    assert not any(got[r[0]]["kept"] or got[r[0]]["base_failed"] for r in copied)


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_common_lines_leave_the_texts(spark, monkeypatch, most):
    monkeypatch.setattr(line_rules, "COMMON_LINES", most)
    own = [f"w{i}x{j} " * 12 for i in range(30) for j in range(2)]
    rows = [(i, f"{own[2 * i]}\n\n  Shared\tBOILER plate\n{own[2 * i + 1]}\nshared boiler plate", None, "h" if i % 3 else None, 0, None, None, None, None) for i in range(30)]
    rows += [(50, None, None, "h", 0, None, None, None, None), (51, "other shared boiler plate", None, "i", 0, None, None, None, None)]
    got = {r["doc_id"]: r for r in line_rules.clean_texts(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i in range(30):  # 20 documents of h, 10 without a host
        want = (f"{own[2 * i]}\n\n{own[2 * i + 1]}", 2) if i % 3 else (rows[i][1], 0)
        assert (got[i]["text"], got[i]["n_removed_lines"]) == want
    assert got[50]["text"] == "" and got[51]["text"] == rows[-1][1] and not got[50]["kept"]
    assert line_rules.clean_texts(frame(spark, [])).count() == 0


def test_common_lines_of_a_large_host(spark):
    """A line in 2 % of a large host's documents is common, also in one with a line in less than a hundredth; a rare one is not."""
    rows = [(i, f"own words of number {i} and more\nseen in two of a hundred" if i % 50 == 0 else f"own words of number {i}", None, "hot") for i in range(6000)]
    rows += [(6000 + i, f"another text {i}\n" + "seen in a few", None, "hot") for i in range(40)]
    rows += [(7000 + i, f"of the huge host {i}" + "\nseen in less" * (i < 110), None, "huge") for i in range(12000)]
    docs = spark.createDataFrame([(r[0], r[1], r[3]) for r in rows], "doc_id long, text string, source string").repartition(4)
    removed = {r["doc_id"] for r in line_rules.clean_texts(docs).where("n_removed_lines = 1").collect()}
    assert removed == set(range(0, 6000, 50)) | set(range(7000, 7110))


def test_clean_documents_stay(spark, sf):
    docs = spark.read.parquet(os.path.join(sf, "documents.parquet"))
    labels = spark.read.parquet(os.path.join(sf, "labels.parquet"))
    clean = line_rules.rule_verdicts(docs).join(labels.where("quality = 1"), "doc_id").where("n_words >= 10")
    assert clean.where("not kept").count() <= 0.01 * clean.count()
