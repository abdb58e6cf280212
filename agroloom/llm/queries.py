"""Registered queries of the corpus operators, with SQL where it can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from agroloom.llm import exact, manifest, mixing, negatives, pages, pieces, prefixes, quality, rules, sharding, simhash, substrings, tokens

PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_digests(table(spark, folder, "documents"), public_tokenizers.path(PIECE_MODEL))


@query(
    """
    WITH d AS (SELECT doc_id, coalesce(list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> ''), []) AS w FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 18, 1))) AS u(i)),
    f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win),
    gone AS (SELECT DISTINCT doc_id, p FROM f, unnest(range(i, i + 20)) AS u(p) WHERE r > 1),
    g AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
           sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' '), '')) AS kept_sha256
    FROM d LEFT JOIN g USING (doc_id)
    """
)
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.substring_digests(table(spark, folder, "documents"))


@query()
def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, folder, "documents"))


@query(
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
    FROM d JOIN g USING (t)
    """
)
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents"))


@query()
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, folder, "documents"))


@query()
def op8_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_texts(table(spark, folder, "pages"))


@query(
    """
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                      coalesce(list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> ''), []) AS w FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 3, 1))) AS u(i)),
    rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win),
    cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM rep, unnest(range(i, i + 5)) AS u(p) WHERE c > 1 GROUP BY doc_id),
    line AS (SELECT doc_id, source, t, l FROM d, unnest(string_split(t, chr(10))) AS u(l) WHERE regexp_matches(l, '[^ \t\x0B\f\r]')),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM line GROUP BY doc_id),
    norm AS (SELECT doc_id, source, t, list_filter(string_split_regex(l, '[ \t\x0B\f\r]+'), lambda x: x <> '') AS ws FROM line),
    keyed AS (SELECT doc_id, source, t, len(ws) AS n,
                     translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM norm),
    freq AS (SELECT source, k, count(DISTINCT t) AS c FROM keyed GROUP BY source, k),
    host AS (SELECT source, count(DISTINCT t) AS c FROM d GROUP BY source),
    common AS (SELECT f.source, f.k FROM freq f JOIN host h ON f.source IS NOT DISTINCT FROM h.source WHERE f.c > 10 AND f.c > 0.1 * h.c),
    off AS (SELECT a.doc_id, sum(a.n) AS n FROM keyed a JOIN common c ON a.source IS NOT DISTINCT FROM c.source AND a.k = c.k GROUP BY a.doc_id),
    base AS (
      SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(off.n, 0) AS BIGINT) AS n_common_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN off USING (doc_id))
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_words - n_common_words < 0.2 * n_words) AS kept
    FROM base
    """
)
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_verdicts(table(spark, folder, "documents"))


@query(
    """
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                      coalesce(list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> ''), []) AS w FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 3, 1))) AS u(i)),
    rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win),
    cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM rep, unnest(range(i, i + 5)) AS u(p) WHERE c > 1 GROUP BY doc_id),
    line AS (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS i FROM d),
    norm AS (SELECT *, list_filter(string_split_regex(l, '[ \t\x0B\f\r]+'), lambda x: x <> '') AS ws FROM line),
    keyed AS (SELECT doc_id, source, t, l, i, len(ws) AS n,
                     translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM norm),
    freq AS (SELECT source, k, count(DISTINCT t) AS c FROM keyed WHERE n > 0 GROUP BY source, k),
    host AS (SELECT source, count(DISTINCT t) AS c FROM d GROUP BY source),
    common AS (SELECT f.source, f.k FROM freq f JOIN host h ON f.source IS NOT DISTINCT FROM h.source WHERE f.c > 10 AND (f.c > 0.01 * h.c OR f.c > 100)),
    marked AS (SELECT a.doc_id, a.l, a.i, a.n, c.k IS NOT NULL AS off
               FROM keyed a LEFT JOIN common c ON a.source IS NOT DISTINCT FROM c.source AND a.k = c.k AND a.n > 0),
    clean AS (SELECT doc_id, count(*) FILTER (WHERE off) AS lines, coalesce(sum(n) FILTER (WHERE off), 0) AS words,
                     coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT off), '') AS text FROM marked GROUP BY doc_id)
    SELECT d.doc_id, NOT (len(w) < 10 OR 100 * coalesce(cov.n, 0) > 20 * len(w) OR len(w) - words < 0.2 * len(w)) AS kept,
           CAST(lines AS BIGINT) AS n_removed_lines, clean.text
    FROM d JOIN clean USING (doc_id) LEFT JOIN cov USING (doc_id)
    """
)
def op9_quality_rules_text(spark: SparkSession, folder: str) -> DataFrame:
    return rules.clean_texts(table(spark, folder, "documents"))


@query()
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path(WORD_TOKENIZER))


@query()
def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.edited_fingerprints(table(spark, folder, "documents"))


@query(
    """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
    """
)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined_negatives(table(spark, folder, "embeddings"))


@query(
    """
    WITH RECURSIVE
    crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
                        ORDER BY i) AS t FROM range(256) u(i)),
    d AS (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                 || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
                 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                 xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                 lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % 5 = 0 AS touched
          FROM documents, crc),
    leaf AS (SELECT source, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
                    CASE WHEN touched THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS altered FROM d),
    node AS (SELECT 0 AS lvl, source, row_number() OVER w - 1 AS i, h, count(*) OVER (PARTITION BY source) AS n
             FROM leaf WINDOW w AS (PARTITION BY source ORDER BY doc_id, h)
             UNION ALL
             SELECT lvl + 1, source, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM node WHERE n > 1 GROUP BY lvl, source, i // 16, n),
    sub AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM node WHERE n = 1),
    top AS (SELECT 0 AS lvl, place AS i, subroot AS h, n FROM sub
            UNION ALL
            SELECT lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY lvl, i // 16, n),
    below AS (SELECT lvl, source, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                     coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
              FROM node WHERE n > 1 WINDOW w AS (PARTITION BY lvl, source, i // 16 ORDER BY i)),
    above AS (SELECT lvl, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                     coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
              FROM top WHERE n > 1 WINDOW w AS (PARTITION BY lvl, i // 16 ORDER BY i)),
    own AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, h) - 1 AS i FROM leaf),
    step AS (SELECT o.source, o.i, b.lvl, b.l, b.r FROM own o JOIN below b ON o.source IS NOT DISTINCT FROM b.source AND b.i = o.i // CAST(pow(16, b.lvl) AS BIGINT)
             UNION ALL
             SELECT o.source, o.i, 100 + a.lvl, a.l, a.r FROM own o JOIN sub s ON o.source IS NOT DISTINCT FROM s.source
             JOIN above a ON a.i = s.place // CAST(pow(16, a.lvl) AS BIGINT)),
    path AS (SELECT source, i, list({'l': l, 'r': r} ORDER BY lvl) AS p FROM step GROUP BY source, i),
    proof AS (SELECT o.doc_id, o.h AS leaf, s.subroot, (SELECT h FROM top WHERE n = 1) AS root,
                     sha256(coalesce(array_to_string(list_transform(p, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
                     list_reduce(list_prepend({'l': coalesce(altered, o.h), 'r': ''}, coalesce(p, [])), lambda c, x: {'l': sha256(x.l || c.l || x.r), 'r': ''}).l AS folded_root
              FROM own o JOIN sub s ON o.source IS NOT DISTINCT FROM s.source LEFT JOIN path q ON o.source IS NOT DISTINCT FROM q.source AND o.i = q.i)
    SELECT *, folded_root = root AS verified FROM proof
    """
)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.document_proofs(table(spark, folder, "documents"))
