"""Fingerprints, hard negatives and the Merkle manifest against plain versions."""

import hashlib
import math
import os
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from brute import counted, frame, odd_documents

from agroloom.llm import manifest, negatives, prefixes


@pytest.fixture(scope="module")
def odd():
    return odd_documents(7)


def spans(text, size=prefixes.WINDOW):
    return {text[i : i + size] for i in range(max(1, len(text) - size + 1))} if text else set()


def dice(a, b):
    x, y = spans(a), spans(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def one_print(text):
    laid, start, size = prefixes.laid_out([text])
    return prefixes.prints(laid, prefixes.plain(start, size))[0]


def some_texts(n=60, seed=1):
    rnd = random.Random(seed)
    texts = ["", "a", "ab" * 3, "hello world, this", "x" * 100, "\0" * 40, "\0" * 41]
    return texts + ["".join(rnd.choice("abcdé🙂 ") for _ in range(rnd.randrange(0, 400))) for _ in range(n)]


def test_spans_are_equal_when_their_texts_are():
    text = "abcab" * 30 + "\0\0\0🙂🙂"
    laid = prefixes.laid_out([text])[0]
    rnd = random.Random(2)
    at = [(i, j, rnd.randrange(min(len(text) - i, len(text) - j) + 1)) for i, j in ((rnd.randrange(len(text)), rnd.randrange(len(text))) for _ in range(900))]
    i, j, n = (np.array(x) for x in zip(*at))
    assert laid.equal(i, j, n).tolist() == [text[a : a + k] == text[b : b + k] for a, b, k in at]


def test_common_extensions_and_edits():
    texts = [t + s for t, s in zip(some_texts(), ["", "tail", "", "abc"] * 30)]
    texts += ["abc" * 9, "abc" * 9, "cba" * 5 + "abc" * 3, "abc"]
    for text, row in zip(texts, prefixes._pairs(list(range(len(texts))), texts, [True] * len(texts)).to_pylist()):
        following = texts[row["doc_id"] + 1]
        out = len(text) // 3
        edited = text[: len(text) - out] + following[:out]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["edited_head"] == len(os.path.commonprefix([text, edited]))
        assert row["edited_tail"] == len(os.path.commonprefix([text[::-1], edited[::-1]]))
        assert row["next_head"] == len(os.path.commonprefix([text, following]))
        # put together from spans, the edited text has the fingerprint it has as a text of its own
        assert row["fingerprint"] == str(one_print(text)) and row["edited_fingerprint"] == str(one_print(edited))
        assert row["near_edited"] == prefixes.likeness(row["fingerprint"], row["edited_fingerprint"])
        assert row["near_next"] == prefixes.likeness(row["fingerprint"], str(one_print(following)))


def test_likeness_of_short_texts_is_exact():
    """Below SAMPLE spans both sets are whole: the larger of the Dice coefficient and the common ends."""
    rnd = random.Random(4)
    for _ in range(200):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 60)))
        b = a[: rnd.randrange(len(a) + 1)] + "".join(rnd.choice("ab") for _ in range(rnd.randrange(12)))
        if a == b or not b:
            continue
        head = len(os.path.commonprefix([a, b]))
        tail = len(os.path.commonprefix([a[::-1], b[::-1]]))
        near = prefixes.likeness(one_print(a), one_print(b))
        sets = min(dice(a, b), 2 * min(len(a), len(b)) / (len(a) + len(b)))
        assert sets - 1e-12 <= near <= max(sets, min(head + tail, len(a), len(b)) / max(len(a), len(b))) + 1e-12
        assert near == prefixes.likeness(one_print(b), one_print(a))


def test_likeness_of_longer_texts_is_near():
    rnd = random.Random(5)
    word = ["".join(rnd.choice("abcdefghijk") for _ in range(rnd.randrange(2, 9))) for _ in range(3000)]
    off = []
    for _ in range(60):
        a = [rnd.choice(word) for _ in range(rnd.randrange(200, 900))]
        b = [rnd.choice(word) if rnd.random() < 0.01 else w for w in a]
        c = [rnd.choice(word) for _ in a]
        off.append(prefixes.likeness(one_print(" ".join(a)), one_print(" ".join(b))) - dice(" ".join(a), " ".join(b)))
        assert prefixes.likeness(one_print(" ".join(a)), one_print(" ".join(c))) < 0.1
    assert abs(sum(off) / len(off)) < 0.05 and max(map(abs, off)) < 0.3


def test_text_of_many_chunks(monkeypatch):
    """Spans, powers and sums across the pieces a long text is worked on in."""
    text = "".join(random.Random(6).choices("abcdef ", k=700_000))
    whole = one_print(text)
    monkeypatch.setattr(prefixes, "KEEP_WINDOWS", 1000)
    assert str(one_print(text)) == str(whole)
    laid, start, size = prefixes.laid_out([text, text[:350_000]])
    assert laid.common_head(start[:1], start[1:], size[1:]).tolist() == [350_000]


def neighbours(rows):
    """doc_id -> text of the next document, for every row, in the operator's order."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64_intdigest(r[1] or "", seed=42))))
    return [(r[0], r[1] or "", order[(k + 1) % len(order)][1] or "") for k, r in enumerate(order)]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bucket", [1, 64])
def test_edited_fingerprints(spark, odd, monkeypatch, bucket):
    monkeypatch.setattr(prefixes, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(prefixes.range_starts, "__defaults__", (prefixes.MOST_BUCKETS, bucket))
    got = counted(prefixes.edited_fingerprints(frame(spark, odd)).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited"))
    want = Counter()
    for key, text, following in neighbours(odd):
        out = len(text) // 3
        edited = text[: len(text) - out] + following[:out]
        a, b = one_print(text), one_print(edited)
        want[key, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(a), prefixes.likeness(a, b)] += 1
    assert got == want


def test_few_documents(spark, odd):
    assert prefixes.edited_fingerprints(frame(spark, [])).count() == 0
    row = (5, "abcdef", *odd[0][2:])
    one = prefixes.edited_fingerprints(frame(spark, [row])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0
    plain = {(r["doc_id"], r["n_chars"], r["fingerprint"]) for r in prefixes.text_fingerprints(frame(spark, odd)).collect()}
    assert plain == {(r[0], len(r[1] or ""), str(one_print(r[1] or ""))) for r in odd}


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def odd_vectors(seed=3, n=500):
    """Rows with nulls, copies, ties, other lengths, scores beyond a long, repeated ids."""
    rnd = random.Random(seed)
    rows = [(None if i == 31 else i, [single(rnd.gauss(0.3, 0.5)) for _ in range(13)], rnd.randrange(10) if i % 40 else 3) for i in range(n)]
    copy = rows[100][1]
    rows += [(1000 + i, copy, i % 2) for i in range(200)]
    rows += [(50, None, 1), (100, [None] * 13, 1), (150, [math.nan] * 13, 1), (200, rows[4][1], None), (None, copy, 1), (3, copy, 2)]
    rows += [(250, copy, 2), (250, copy, 2), (250, copy, 5), (300, [math.inf] * 13, 1)]
    rows += [(2000, [1.0, 2.0], 1), (2050, [1.0, 2.5], 1), (2051, [single(0.9), 2.0], 3), (2100, [], 1), (2101, [], 1), (2102, [], 2), (2150, [], 1)]
    return rows + [(2200 + i, [single(3e30) * (-1) ** i, 1e10 * i], 1 + i % 2) for i in range(60)]


def hard(rows):
    """Plain version of the query's contract; scores beyond a long count as its limit."""
    usable = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for i, label, v in dict.fromkeys(r for r in usable if r[0] % 50 == 0):
        scored = []
        for j, other, w in usable:
            if j != i and len(w) == len(v):
                s = sum(x * y for x, y in zip(v, w))
                scored.append((-max(negatives.LEAST, min(negatives.MOST, s)), j, other))
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fit = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(i, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(fit[:3])]
    return Counter(out)


def test_hard_negatives(spark, monkeypatch):
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, vec string").repartition(3)
    monkeypatch.setattr(negatives, "ROWS", 150)  # several groups and blocks
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    want = hard(rows)
    assert counted(negatives.mined_negatives(df)) == want and len(want) > 200
    assert negatives.mined_negatives(df.limit(0)).count() == 0


def test_bounds_hold_and_leave_pairs_out():
    rng = np.random.default_rng(1)
    # topics: a component that a whole segment shares, which the means see
    topic = np.repeat(rng.normal(0, 100, (40, 8)), 8, axis=1)
    parts = np.floor(topic[rng.integers(0, 40, 3000)] + rng.normal(0, 10, (3000, 64)))
    v = negatives.summarised(np.arange(3000), rng.integers(0, 5, 3000), parts)
    scores = parts @ parts.T
    wide = None
    for s in negatives.levels(64):
        low, high = negatives.bounds(negatives.level(v, s), negatives.level(v, s))
        assert (low <= scores).all() and (scores <= high).all()
        assert wide is None or (high - low).mean() <= wide
        wide = (high - low).mean()
    few = v.taken(np.arange(0, 3000, 50))
    best = negatives.Best(len(few.ids), 5)
    limits = [np.full((len(few.ids), 1), x) for x in (negatives.LEAST, negatives.MOST)]
    pairs, scored = negatives.mined(few, v, *limits, best, True)
    assert scored < pairs / 4
    for i, found in zip(few.ids.tolist(), best.found):
        same = [(-int(scores[i, j]), j) for j in np.flatnonzero(v.labels == v.labels[i]).tolist() if j != i]
        assert found == sorted(same)[:5]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def sides(levels, i):
    out = []
    for level in levels[:-1]:
        run, at = level[i // 16 * 16 : i // 16 * 16 + 16], i % 16
        out.append(("".join(run[:at]), "".join(run[at + 1 :])))
        i //= 16
    return out


def proofs(rows):
    """(id, leaf, subroot, root, proof, folded root, verified) of (tree, id, digest, altered)."""
    by = defaultdict(list)
    for s, key, leaf, altered in rows:
        by[s].append((key is not None, key or 0, leaf, altered or leaf, key))
    trees = {s: tree([x[2] for x in sorted(v)]) for s, v in by.items()}
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in names])
    out = Counter()
    for k, s in enumerate(names):
        for i, x in enumerate(sorted(by[s])):
            path = sides(trees[s], i) + sides(top, k)
            root = x[3]
            for a, b in path:
                root = H(a + root + b)
            out[x[4], x[2], trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in path)), root, root == top[-1][0]] += 1
    return out


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def test_manifest(spark, odd):
    def lower(t):
        return t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)

    for rows in (odd, odd[:1], []):
        want = []
        for key, text, lang, source, n, *_ in rows:
            head = field(key) + field(source) + field(lang) + field(n)
            touched = key is not None and zlib.crc32(str(key).encode()) % 5 == 0
            want.append((source, key, H(head + field(text)), H(head + field(lower(text))) if touched else None))
        got = counted(manifest.document_proofs(frame(spark, rows)))
        assert got == proofs(want)
        assert not rows[1:] or {k[-1] for k in got} == {True, False}


@pytest.mark.parametrize("height", [2, 3])
def test_layers_of_blocks(spark, height):
    """Trees of several layers, many trees, and trees of one leaf."""
    rows = [("big", i, H(f"b{i}"), H("x") if i % 7 == 0 else None) for i in range(300)]
    rows += [(f"s{i}", i, H(f"s{i}"), None) for i in range(40)] + [(None, None, H("n"), None), ("", 4, H("e"), None)] * 2
    df = spark.createDataFrame(rows, "s string, k long, d string, a string").repartition(3)
    got = manifest.manifest_proofs(df, "s", "k", "d", "a", height)
    assert counted(got.select("id", "digest", "subroot", "root", "proof_sha256", "folded_root", "verified")) == proofs(rows)


@pytest.mark.parametrize("height", [1, 2, 3, 4])
def test_layout(height):
    """Every node has one place; subtrees of half the levels lie in one piece."""
    places = manifest.addresses(height)
    assert sorted(np.concatenate(places).tolist()) == list(range(manifest.nodes_in(height)))
    upper = height // 2
    if upper:
        for root in range(16**upper):
            below = [places[d][root * 16 ** (d - upper) : (root + 1) * 16 ** (d - upper)] for d in range(upper, height)]
            piece = np.concatenate(below)
            assert piece.max() - piece.min() + 1 == len(piece) == manifest.nodes_in(height - upper)


def test_block_proves_its_leaves():
    leaves = [manifest.sha(b"%d" % i) for i in range(333)]
    block = manifest.built(leaves, 4)
    assert all(manifest.folded(leaf, block.siblings(i)) == block.root for i, leaf in enumerate(leaves))
    assert all(manifest.unpacked(manifest.packed(block.siblings(i))) == block.siblings(i) for i in range(0, 333, 20))
    assert manifest.folded(manifest.sha(b"other"), block.siblings(7)) != block.root
