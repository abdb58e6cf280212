"""Plain versions of the corpus operators for small tables, and the tables to try them on."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words string, size double, `a.b` int"


def words(text):
    return WORD.findall(text or "")


def odd_documents(seed=3, n=160):
    """Rows with nulls in every column, empty and long texts, copies, repeated rows, shared passages, clashing columns."""
    rnd = random.Random(seed)
    bag = ["the", "of", "Zu", "çé", "x", "and", "漢字", "🙂a", "re.", "That", "b|c", "***", "it", "an"]
    passage = " ".join(rnd.choice(bag) + str(i % 7) for i in range(60))
    texts = [None, "", " ", "\n\n", "a", "a b c", "\t\x0b\x0c\r one \x1f two ", "x " * 3000, "To To To To To To To To To To To To", "y" * 20000]
    for i in range(n):
        body = " ".join(rnd.choice(bag) + rnd.choice(["", "", str(rnd.randrange(40))]) for _ in range(rnd.randrange(1, 90)))
        if i % 4 == 0:
            body = f"Common first line of all.\n{body}"
        if i % 5 == 0:
            at = rnd.randrange(len(passage) // 2)
            body += "\n" + passage[at:]
        if i % 6 == 0:
            body = body + "\n" + body.split("\n")[0] + "  \n" + body.lower()
        texts.append(body)
    long = texts[20]
    texts += [long] * 40  # one large group of copies
    texts += [long + " " + str(i) for i in range(10)]  # near copies
    rows = []
    for i, t in enumerate(texts):
        rows.append((i * 3 if i % 17 else None, t, None if i % 9 == 0 else "en", [None, "s1", "", "S2", "é"][i % 5] if i % 3 else "s1", i, None, "w", 0.5, i))
    rows += rows[5:9] + rows[30:33]  # repeated rows
    rows.append((3, "another text with a key that is there already and some more words to it", "en", "s1", 1, True, None, None, None))
    rnd.shuffle(rows)
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)


def counted(df):
    """The rows of a result with how often each occurs."""
    return Counter(tuple(r) for r in df.collect())


def components(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        up[find(a)] = find(b)
    return [find(x) for x in range(n)]


def simhash(text, shingle=4):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i : i + shingle]) for i in range(max(len(w) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows, bits=4):
    """(doc_id, fingerprint, component) of (doc_id, text) rows."""
    fps = [simhash(t) for _, t in rows]
    distinct = sorted(set(fps))
    pairs = [(i, j) for i in range(len(distinct)) for j in range(i) if bin(distinct[i] ^ distinct[j]).count("1") <= bits]
    of = dict(zip(distinct, components(len(distinct), pairs)))
    least = defaultdict(list)
    for (k, _), f in zip(rows, fps):
        if k is not None:
            least[of[f]].append(k)
    return [(k, f"{f:016x}", min(least[of[f]], default=None)) for (k, _), f in zip(rows, fps)]


def covered(starts, size):
    return {p for s in starts for p in range(s, s + size)}


def rules(rows):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_common_words, kept) of (doc_id, source, text)."""

    def lines(t):
        return [x for x in (t or "").split("\n") if words(x)]

    def norm(x):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(words(x)))

    having, hosts = defaultdict(set), defaultdict(set)
    for _, s, t in rows:
        hosts[s].add(t or "")
        for x in lines(t):
            having[s, norm(x)].add(t)
    out = []
    for k, s, t in rows:
        w, ls = words(t), lines(t)
        windows = defaultdict(list)
        for i in range(len(w) - 4):
            windows[tuple(w[i : i + 5])].append(i)
        rep = len(covered([i for x in windows.values() if len(x) > 1 for i in x], 5))
        common = sum(len(words(x)) for x in ls if len(having[s, norm(x)]) > 10 and len(having[s, norm(x)]) > 0.1 * len(hosts[s]))
        failed = len(w) < 10 or 100 * rep > 20 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        kept = not failed and len(w) - common >= 0.2 * len(w)
        out.append((k, len(w), sum(map(len, w)), symbols, len(ls) - len(set(ls)), rep, failed, common, kept))
    return out
