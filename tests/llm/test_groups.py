"""Components, SimHash, mixing, sharding, quality, pages and the pipeline against plain versions."""

import os
import pickle
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from brute import components, counted, frame, near_groups, odd_documents, rules, simhash, words
from pyspark.sql import functions as F

import corpus_pipeline
from agroloom.llm import components as stars
from agroloom.llm import exact, mixing, pages, quality, sharding
from agroloom.llm import rules as rules_of
from agroloom.llm import simhash as near


@pytest.fixture(scope="module")
def odd():
    return odd_documents(4)


def test_components(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(120)]
    pairs += [(2000, 2000 + i) for i in range(1, 60)] + [(-5, 7), (-5, -900)]
    nodes = sorted({x for p in pairs for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    root = components(len(nodes), [(at[a], at[b]) for a, b in pairs])
    least = defaultdict(lambda: 10**9)
    for x, r in zip(nodes, root):
        least[r] = min(least[r], x)
    want = {x: least[r] for x, r in zip(nodes, root)}
    got = dict(map(tuple, stars.component_roots(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert all(got.get(x, x) == w for x, w in want.items())
    assert stars.component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints():
    rows = odd_documents(9, 60)
    got = near.fingerprints(pa.array([r[1] or "" for r in rows]))
    assert got.tolist() == [simhash(r[1]) for r in rows]


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_forest_finds_all_close_pairs(blocks):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    flips = rng.integers(0, 64, (60, 20, 3), dtype=np.uint64)
    near_base = base[:, None] ^ np.bitwise_xor.reduce(np.uint64(1) << flips, axis=2)
    fp = np.unique(np.concatenate((base, near_base.ravel(), rng.integers(0, 2**63, 500, dtype=np.uint64))))
    rng.shuffle(fp)
    found = set()
    for mask in near.block_masks(blocks, 4):
        key = fp & np.uint64(mask & (2**64 - 1))
        by = np.argsort(key, kind="stable")
        own, shard = fp[by], np.unique(key[by], return_inverse=True)[1]
        root, child = near.bk_forest(own, shard)
        for a, b in near.close_pairs(own, root, child, 4):
            found |= {(min(int(own[x]), int(own[y])), max(int(own[x]), int(own[y]))) for x, y in zip(a, b)}
    want = {(min(int(a), int(b)), max(int(a), int(b))) for i, a in enumerate(fp) for b in fp[:i] if int(a ^ b).bit_count() <= 4}
    assert found == want


@pytest.mark.parametrize("crowd", [1, 50, 10**6])
def test_crowded_shards(monkeypatch, crowd):
    """Clusters of near fingerprints, chains and strays in one shard give the components of all pairs."""
    monkeypatch.setattr(near, "CROWD", crowd)
    rng = np.random.default_rng(crowd)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    rows = [int(base[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (300, 2))]
    rows += [int(base[1]) ^ sum(1 << int(x) for x in rng.choice(64, 4, replace=False)) for _ in range(40)]
    rows += [int(base[2]) ^ ((1 << 3 * k) - 1) for k in range(20)] + [int(x) for x in base]
    fp = np.array(sorted(set(rows)), np.uint64)
    order = rng.permutation(len(fp))
    fp = fp[order]
    batch = pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(np.zeros(len(fp), np.int64)), pa.array(np.zeros(len(fp), np.int64))], ["fp", "mask", "key"])
    links = [(r["a"], r["b"]) for b in near._stars(4)(iter([batch])) for r in b.to_pylist()]
    at = {int(x): i for i, x in enumerate(fp.view(np.int64))}
    got = components(len(fp), [(at[a], at[b]) for a, b in links])
    want = components(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if int(fp[i] ^ fp[j]).bit_count() <= 4])
    assert len({(g, w) for g, w in zip(got, want)}) == len(set(got)) == len(set(want))


def test_near_groups(spark, odd):
    assert counted(near.near_duplicates(frame(spark, odd))) == Counter(near_groups([(r[0], r[1]) for r in odd]))
    assert near.near_duplicates(frame(spark, [])).count() == 0
    stay = near.drop_near(frame(spark, odd))
    rows = near_groups([(r[0], r[1]) for r in odd])
    assert stay.columns == frame(spark, odd).columns
    fps = sorted({int(f, 16) for _, f, _ in rows})
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert stay.count() == len(set(components(len(fps), pairs)))


def test_blocks_grow_with_the_fingerprints():
    assert near.blocks_for(1, 4) == near.blocks_for(100_000, 4) == 5
    assert 5 < near.blocks_for(10**9, 4) < near.blocks_for(10**13, 4)


def targets(sizes):
    """Targets of (source -> size), by raising a common level until every source is full or the words are dealt."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / max(sum(weight[s] for s in free), 1)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: min(level * weight[s], 3 * sizes[s]) if s not in full else 3.0 * sizes[s] for s in order}
        full |= over


@pytest.mark.parametrize("block", [8, 64, 1024])
def test_mixing(spark, odd, block):
    rows = odd + [(5000 + i, "tiny source", None, f"t{i}", None, None, None, None, None) for i in range(7)]
    first = mixing.mixed(frame(spark, rows), block=block, shard_blocks=16)
    columns = ["doc_id", "text_hash", "size", "source_size", "target", "taken"]
    got = first.select(*columns).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = targets(dict(sizes))
    assert {round(t, 6) for t in want.values() if t} == {round(r["target"], 6) for r in got if r["target"]}
    by = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[r["source_size"], r["target"]] += r["taken"]
    for (size, target), taken in by.items():
        twins = sum(1 for s in sizes if sizes[s] == size and abs(want[s] - target) < 1e-6)
        assert abs(taken - twins * target) <= twins
    again = mixing.mixed(frame(spark, rows[::-1], 7), block=block, shard_blocks=16)
    assert counted(again.select(*columns)) == Counter(tuple(r) for r in got)


def test_rows_keep_columns_with_any_name(spark):
    """Stages return the caller's own columns, also those called like their helpers and results."""
    names = ["kept", "group_size", "ties", "text_sha256", "keep_id", "__id", "__hash", "__n", "__plan", "__plans", "__host", "__ties", "host", "text_hash", "a.b", "taken", "root"]
    texts = ["one two three four five six seven eight nine ten eleven", "other words in a text that is long enough to stay here at all", None]
    rows = [(i, texts[i % 3], "en", "s", i, *[f"{n}{i}" for n in names]) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` string" for n in names))
    for stage in (exact.drop_repeats, near.drop_near, rules_of.keep_good, mixing.mixed_documents):
        got = stage(df)
        assert got.columns == df.columns
        found = got.collect()
        assert found
        for r in found:
            assert tuple(r)[4:] == rows[r["doc_id"]][4:], stage.__name__
        assert stage(df.limit(0)).count() == 0
    assert sorted(r["doc_id"] for r in exact.drop_repeats(df).collect()) == [6, 7, 8]


def test_mixed_documents(spark, odd):
    got = mixing.mixed_documents(frame(spark, odd))
    assert got.columns == frame(spark, odd).columns
    taken = {r["doc_id"]: r["n"] for r in mixing.mixed(frame(spark, odd)).groupBy("doc_id").agg(F.sum("taken").alias("n")).collect()}
    have, whole = Counter(), {r[1] for r in odd}
    for r in got.collect():
        have[r["doc_id"]] += len(words(r["text"]))
        parent = [x for x in odd if x[0] == r["doc_id"]]
        assert r["text"] in whole or any(set(words(r["text"])) <= set(words(p[1])) for p in parent)
    assert have == Counter({k: n for k, n in taken.items() if n})
    assert mixing.mix_sizes(frame(spark, [])).count() == 0
    assert mixing.mixed_documents(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_permutation(spark, n):
    x = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("y"))
    back = x.select("id", "y", mixing.permuted(F.col("y"), F.lit(n), F.lit(3), backwards=True).alias("z")).collect()
    assert sorted(r["y"] for r in back) == list(range(n))
    assert all(r["id"] == r["z"] for r in back)
    assert n < 100 or [r["y"] for r in back] != list(range(n))


def test_permutation_is_uniform(spark):
    n = 1 << 20
    x = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("y"))
    assert x.where("id = y").count() <= 6  # about one in a random permutation of any length
    cells = x.groupBy(F.floor(F.col("id") / (n // 16)), F.floor(F.col("y") / (n // 16))).count().collect()
    assert len(cells) == 256 and sum((r["count"] - n / 256) ** 2 / (n / 256) for r in cells) < 330


def smallest_capacity(sizes, shards):
    low, high = max([*sizes, -(-sum(sizes) // shards)]), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, 0
        room = mid
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("bits", [(14, 8), (1, 1), (3, 2)])
@pytest.mark.parametrize("shards", [1, 3, 16])
def test_capacity_and_cuts(monkeypatch, spark, bits, shards):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits[0])
    monkeypatch.setattr(sharding, "MORE_BITS", bits[1])
    rnd = random.Random(shards)
    keys = sorted({rnd.getrandbits(60) >> rnd.choice([0, 0, 30]) for _ in range(120)})
    sizes = [rnd.choice([1, 5, 40, 900]) for _ in keys]
    groups = spark.createDataFrame(list(zip(keys, sizes)), "k long, size long").cache()
    atoms = sharding._atoms(sharding._summed(groups, bits[0]), bits[0])
    capacity, atoms = sharding.minimax_capacity(atoms, groups, max(sizes), shards)
    assert capacity == smallest_capacity(sizes, shards)
    cuts = sharding.balanced_cuts(atoms, groups, capacity, shards)
    loads = Counter()
    for k, s in zip(keys, sizes):
        loads[sum(k >= c for c in cuts)] += s
    assert max(loads.values()) <= capacity and max(loads) < shards


def test_shards(spark, odd):
    got = sharding.shard_by_bytes(frame(spark, odd)).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    slots, homes = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        homes[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(16)) and all(len(h) == 1 for h in homes.values())
    assert sharding.shard_by_bytes(frame(spark, [])).count() == 0


def test_shards_are_near_equal(spark, sf):
    docs = spark.read.parquet(os.path.join(sf, "documents.parquet"))
    loads = [r["n"] for r in sharding.shard_by_bytes(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    biggest = docs.groupBy("text").agg(F.sum(F.octet_length("text") + 1).alias("n")).agg(F.max("n")).first()[0]
    assert len(loads) == 16 and max(loads) - min(loads) <= 2 * biggest


def test_quality(spark, sf):
    docs = spark.read.parquet(os.path.join(sf, "documents.parquet"))
    labels = spark.read.parquet(os.path.join(sf, "labels.parquet"))
    got = quality.quality_scores(docs, labels).cache()
    assert got.count() == docs.count() and got.where("score between 0 and 1").count() == docs.count()
    held = got.join(labels, "doc_id").where("held_out")
    assert held.where("predicted = quality").count() >= 0.95 * held.count()
    # held-out labels, and columns other than the text, change nothing
    turned = labels.withColumn("quality", F.when(quality.remainder() == quality.HELD_OUT, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")}).repartition(5)
    assert counted(quality.quality_scores(other, turned)) == counted(got)


def test_quality_of_odd_documents(spark, odd):
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(odd)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality.quality_scores(frame(spark, odd), labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in odd)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert quality.quality_scores(frame(spark, []), labels).count() == 0
    none = quality.quality_scores(frame(spark, odd), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}


def test_sample_is_bounded(spark, monkeypatch):
    """One row of a labelled key, however often it occurs, and a bounded number of features of it."""
    hot = next(k for k in range(7, 99) if zlib.crc32(str(k).encode()) % 4 != quality.HELD_OUT)
    rows = [(hot, f"text number {i} of a key that a third of all rows share") for i in range(600)] + [(hot, "the same")] * 300
    rows += [(100 + i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k in sorted({r[0] for r in rows})], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fitted", lambda codes, good: seen.append((list(codes), good)))
    quality.fit_quality(docs, labels, rows=50, features=20)
    codes, good = seen[0]
    assert 40 <= len(codes) <= 50 and len(good) == len(codes) and max(map(len, codes)) == 20
    quality.fit_quality(docs.where(F.col("doc_id") == hot), labels, features=10**6)
    text = min((r[1] for r in rows if r[0] == hot), key=lambda t: (lambda h: h - (1 << 64) if h >> 63 else h)(xxhash.xxh64_intdigest(t, seed=42)))
    assert [x.tolist() for x in seen[1][0]] == [quality.indicators(pa.array([text]))[0].tolist()]


def test_probe_changes_no_score():
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["good", "bad", "Word", "12", "x!", f"r{rnd.randrange(50)}"]) for _ in range(rnd.randrange(60))) for _ in range(200)]
    codes, counts = quality.indicators(pa.array(texts))
    model = quality.fitted(np.split(codes, np.cumsum(counts)[:-1]), np.array([t.count("good") > t.count("bad") for t in texts]))
    some = pa.array([*texts[:50], "", "unknown words only", "good bad"])
    plain = quality.known_features(*quality.indicators(some), model.vocabulary)
    probed = quality.known_features(*quality.indicators(some, model.probe), model.vocabulary)
    assert [x.tolist() for x in plain] == [x.tolist() for x in probed]
    again = pickle.loads(pickle.dumps(model))
    assert again.scores(some).tolist() == model.scores(some).tolist()
    flat = np.concatenate([c for c in np.split(codes, np.cumsum(counts)[:-1])])
    assert model.vocabulary.tolist() == sorted(c for c, n in Counter(flat.tolist()).items() if n > 1)


def test_word_pairs_and_triples_tell_texts_apart():
    """Good and bad texts have the same words in the same shapes; only which stand together differs."""
    rnd, texts, good = random.Random(9), [], []
    for i in range(200):
        couples = [["aa bb", "cc dd"], ["aa dd", "cc bb"]][i % 2]
        texts.append(" ".join(x for _ in range(6) for x in rnd.sample([*couples, "ee ff"], 3)))
        good.append(i % 2 == 0)
    codes, counts = quality.indicators(pa.array(texts))
    model = quality.fitted(np.split(codes, np.cumsum(counts)[:-1])[:120], np.array(good[:120]))
    assert ((model.scores(pa.array(texts[120:])) >= 0.7) == np.array(good[120:])).mean() > 0.95
    sent = pickle.loads(pickle.dumps(model))
    assert (sent.vocabulary == model.vocabulary).all() and (sent.scores(pa.array(texts)) == model.scores(pa.array(texts))).all()


def test_quality_of_long_documents(spark, sf):
    """The words of a long text, most of them in no labelled row, don't drown what tells good from bad."""
    docs = spark.read.parquet(os.path.join(sf, "documents.parquet")).select("doc_id", "text")
    labels = spark.read.parquet(os.path.join(sf, "labels.parquet"))
    held = docs.join(labels, "doc_id").where(quality.remainder() == quality.HELD_OUT).orderBy("doc_id").collect()
    rnd, long = random.Random(4), []
    for good in (1, 0):
        some = [w for r in held if r["quality"] == good for w in words(r["text"])]
        many = [some[i % len(some)] for i in range(400_000)]
        long.append((-1 - good, " ".join("".join(rnd.sample(w, len(w))) if w.isalpha() and w.islower() else w for w in many)))
    both = docs.unionByName(spark.createDataFrame(long, "doc_id long, text string"))
    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(both, labels).where("doc_id < 0").collect()}
    assert got[-2] > 0.9 and got[-1] < 0.1


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var t="</p><article>x</article>";</script></head>
<body class="page-{n} with-sidebar"><nav><ul><li><a href="/a">Menu {n}</a></li></ul></nav><!-- ad <p>no</p> -->
<div class="ad">Buy this now, a long advert text that goes on and on, longer than the article itself perhaps, and more of it.</div>
<{tag} class="body b{n}"><h1>Title {n} &amp; more</h1><p><b>First&nbsp;line<br>goes  on.<p>Second &lt;line&gt;
here.</p><div class="share">Share this</div><ul><li>one<li>two</ul></{tag}>
<div id="comments"><p>Reader says a lot of things here, more than the article has, on and on and on and on and on and on.</p></div>
<aside>Side</aside><form><p>Name</p><input value="x"></form><footer>&copy; all</footer></body>"""


def test_pages(spark):
    want = "Title {n} & more\n\nFirst line goes on.\n\nSecond <line> here.\n\none\n\ntwo"
    rows = [(i, f"http://h{i % 3}.example/{i}", PAGE.format(n=i, tag="article" if i % 3 else "div"), "x", 0) for i in range(30)]
    rows += [(90, "http://h1.example/z", None, None, None), (91, None, "", None, None), (92, "no url", "plain <b>text</b> &amp; more", "y", 1)]
    rows += [rows[0]] + [(None, None, "<p>unclosed \"quote <a href=\"x>y</p>", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(4)
    got = counted(pages.page_texts(df))
    texts = [(want.format(n=r[0]) if r[0] is not None and r[0] < 30 else {92: "plain text & more", None: 'unclosed "quote y'}.get(r[0], "")) for r in rows]
    assert got == Counter((r[0], r[1], t, len(t)) for r, t in zip(rows, texts))
    assert pages.page_texts(df.limit(0)).count() == 0


def test_host_decides_between_containers():
    page = "<body><div class='teaser'><p>{}</p></div><div class='story'><p>{}</p></div></body>"
    assert pages.main_text(page.format("a long teaser of this page", "short"), ">body>div.story") == "short"
    assert pages.main_text(page.format("a long teaser of this page", "short"), ">body>div.other") == "a long teaser of this page"


def test_whole_articles_are_extracted():
    long, short = "a long part of the text " * 5, "a short part"
    page = f"<body><div class='teaser'>other</div><article><h1>Title</h1><div class='body'><p>{long}</p></div><p>closing</p></article></body>"
    for path in (None, ">body>article>div.body", ">body>article"):
        assert pages.main_text(page, path) == f"Title\n\n{long.strip()}\n\nclosing"
    plain = f"<body><div class='teaser'>other</div><div class='post'><h1>Title</h1><div class='wrap'><div class='body'>{long}</div></div></div></body>"
    assert pages.main_text(plain, None) == f"Title\n\n{long.strip()}"
    parts = "<section{}><p>{}</p></section><section{}><p>{}</p></section>"
    for marks in (("", ""), (" class='a'", " class='b'")):
        two = parts.format(marks[0], long, marks[1], short)
        for around in ("<body>{}</body>", "<body><article>{}</article></body>", "<body><div class='x'>{}</div></body>"):
            for path in (None, ">body>section", ">body>article>section", ">body>div.x>section.b"):
                assert pages.main_text(around.format(two), path) == f"{long.strip()}\n\n{short}"
    # all containers on the winning path, also where the text lies deep, but none with links alone
    deep = f"<body><div class='s'>{long}</div><div class='t'>x</div><div class='s'>{'<div>' * 6}{short}{'</div>' * 6}</div><div class='s'><a>link</a></div></body>"
    assert pages.main_text(deep, ">body>div.s") == f"{long.strip()}\n\n{short}"


def test_many_hosts_are_joined_with_salt(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"h{i % 3}" if i % 4 else None) for i in range(40)], "page_id int, host string")
    winners = spark.createDataFrame([("h0", "a"), ("h1", "b"), (None, "c")], "host string, winning_path string")
    plain = counted(pages.with_winners(df, winners, "page_id"))
    monkeypatch.setattr(pages, "BROADCAST_BYTES", 0)
    path = {"h0": "a", "h1": "b", None: "c"}
    assert counted(pages.with_winners(df, winners, "page_id")) == plain == Counter((r["page_id"], r["host"], path.get(r["host"])) for r in df.collect())


def test_very_long_page():
    source = "<body><article>" + "<p>word &amp; word</p>" * 20000 + "</article>" + "<div>" * 3000
    assert pages.main_text(source, None) == "\n\n".join(["word & word"] * 20000)


def test_scripts_and_broken_markup():
    story = "<article><h1>Title</h1><p>Some text of the page.</p></article>"
    want = "Title\n\nSome text of the page."
    for raw in (
        "<script>for(var i=0;i<n;i++){f(i)}</script>", "<script>if (a<b && c) d('</p>')</script>", "<style>a<b{}</style>", "<script>x = '<!--'</script>",
        "<textarea><p>a</textarea>", "<SCRIPT>a<b</Script >", "<!-- <p> -- > -->", "<svg><text>a<b</text></svg>", "<p a='<b>'></p>", "<?php a<b ?>",
    ):
        assert pages.main_text(f"<body>{raw}{story}</body>", None) == want, raw
    # quoted values may hold a sign that ends a tag; an open quote ends with the tag
    assert pages.main_text(f"<body><div title='a > b' class=\"x\">{story}</div></body>", None) == want
    assert pages.main_text('<p class="a>one</p><p>two</p>', None) == "one\n\ntwo"
    assert pages.main_text("<p>1 < 2 and 3 <4 <</p>", None) == "1 < 2 and 3 <4 <"
    assert pages.main_text(f"<body>{story}<div", None) == f"{want}\n\n<div"  # never closed, so it is text


def test_own_headers_stay_and_side_matter_goes():
    long = "many words about cookies and consent that nobody reads " * 9
    page = f"<body><header><p>Site</p></header><article><header class='article-header'><h1>Title</h1></header><p>Body.</p><footer>foot</footer></article><div class='notice'>{long}</div></body>"
    assert pages.main_text(page, None) == "Title\n\nBody."
    for name in ("sidebar", "notice", "cookie-banner", "comments"):
        side = f"<body><div class='{name}'><p>{long}</p></div><div class='text'><p>Short text.</p></div></body>"
        assert pages.main_text(side, None) == "Short text.", name
        assert pages.main_text(f"<body><div class='{name}'><article>Inside.</article></div></body>", None) == "Inside."
    # a page that is nothing else keeps its text
    assert pages.main_text("<body><div class='social'>A post.</div></body>", None) == "A post."


@pytest.mark.parametrize(
    "source, n",
    [("<a ", 60_000), ("<a \"", 60_000), ("<a b=\"' c='>", 30_000), ("<p a=\"'>x", 30_000), ("<div>", 60_000), ("<div>x</section>", 30_000), ("<li>", 60_000), ("<!- ", 60_000), ("<script></scrip", 30_000)],
)
def test_broken_pages_take_linear_time(source, n):
    """Twenty times the page may take a hundred times as long, not four hundred."""
    pages.main_text(source * 100, None)
    start = time.process_time()
    pages.main_text(source * (n // 20), None)
    small = max(time.process_time() - start, 0.02)
    start = time.process_time()
    pages.main_text(source * n, ">div>div")
    assert time.process_time() - start < 100 * small


def plain_blocks(node, side, out):
    """Texts of a tree of (tag, class, children) in page order, those in named side matter left out."""
    tag, name, children = node
    side = side or name in ("menu", "notice", "sidebar") or tag in ("nav", "footer", "aside")
    for child in children:
        if isinstance(child, str):
            if not side:
                out.append(child)
        else:
            plain_blocks(child, side, out)
    return out


def test_trees_against_a_plain_extractor():
    """The whole text beside side matter, where one container holds it all."""
    rnd = random.Random(8)

    def tree(depth):
        tag = rnd.choice(["div", "div", "section", "ul", "nav", "footer", "aside", "blockquote"])
        name = rnd.choice(["", "", "a", "b1", "menu", "notice", "sidebar", "with-sidebar"])
        children = [tree(depth - 1) if depth and rnd.random() < 0.5 else ("p", "", [f"t{rnd.randrange(10**6)} & <x>"]) for _ in range(rnd.randrange(1, 5))]
        return tag, name, children

    def markup(node):
        if isinstance(node, str):
            return node.replace("&", "&amp;").replace("<", "&lt;")
        tag, name, children = node
        inner = "".join(markup(c) for c in children)
        return f"<{tag}" + (f" class='{name}'" if name else "") + f">\n{inner} </{tag}>"

    for _ in range(150):
        root = ("article", "", [("h1", "", ["Head"]), *(tree(3) for _ in range(rnd.randrange(1, 4)))])
        got = pages.main_text(f"<html><body><nav>x</nav>{markup(root)}<p class='notice'>n</p></body></html>", None)
        assert got.split("\n\n") == plain_blocks(root, False, [])


def test_consensus_mends_a_page(spark):
    """Four pages of a host agree on the story; the fifth, whose teaser is longer, is read by their path."""
    page = "<body><div class='teaser n{n}'><p>{teaser}</p></div><div class='story'><p>{story}</p></div></body>"
    rows = [(i, f"https://h.example/{i}", page.format(n=i, teaser="tease " * (40 if i == 4 else 2), story=f"story {i} " * 9)) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.page_texts(df).collect()}
    assert got == {i: (f"story {i} " * 9).strip() for i in range(5)}
    alone = pages.page_texts(df.where("page_id = 4")).first()["text"]
    assert alone == ("tease " * 40).strip()


def test_pipeline(spark, sf):
    """Every stage against its plain version, on what the stage before has kept."""
    docs = spark.read.parquet(os.path.join(os.path.dirname(sf), "sf0.001", "documents.parquet"))
    rows = docs.collect()
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality rules", "exact dedup", "near dedup", "mixing", "sentencepiece"]
    out = docs
    for name in list(stage)[:4]:
        out = stage[name](spark, out, sf).cache()
        assert out.columns == docs.columns
        got = Counter(r["doc_id"] for r in out.collect())
        if name == "quality rules":
            good = {x[0] for x in rules([(r["doc_id"], r["source"], r["text"]) for r in rows]) if x[-1]}
            rows = [r for r in rows if r["doc_id"] in good]
        elif name == "exact dedup":
            last = {}
            for r in rows:
                last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
            rows = [r for r in rows if last[r["text"]] == r["doc_id"]]
        elif name == "near dedup":
            names = {k for k, _, c in near_groups([(r["doc_id"], r["text"]) for r in rows]) if k == c}
            rows = [r for r in rows if r["doc_id"] in names]
        else:
            by, sizes = defaultdict(int), defaultdict(int)
            for r in rows:
                sizes[r["source"]] += len(words(r["text"]))
            for r in out.collect():
                by[r["source"]] += len(words(r["text"]))
            assert all(abs(by[s] - t) <= 1 for s, t in targets(dict(sizes)).items())
            continue
        assert got == Counter(r["doc_id"] for r in rows)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((r["doc_id"], len(library.encode(r["text"]))) for r in out.collect())
    folder = os.path.join(os.path.dirname(sf), "sf0.001")
    assert counted(corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens")) == want
