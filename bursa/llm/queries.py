"""The operators' queries, each over its whole table, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bursa.llm import (bpe_codec, decontaminate, divergence, lang_hd, lm_score, merkle, page_text, para_dedup, pii,
                       quality_knn, quality_rules, simhash, token_store)
from bursa.llm.common import scratch, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_store.write(table(spark, sf_dir, "documents"), path)
    return token_store.digests(token_store.read(spark, path))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return para_dedup.repeated_anywhere(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_hd.identify(table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered_hash())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_decontamination, op2_lm_scoring, op3_token_files, op4_pii, op5_substring_dedup, op6_byte_bpe,
    op7_quality_classifier, op8_quality_rules, op9_simhash, op10_language_id, op11_html_extraction,
    op12_source_divergence, op13_merkle_manifest)}

# Words of both tables with their places; a benchmark item's windows; places where one begins.
OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

# Terms of each lang kept, each group's scaled shares of them, then both parts with their ranks.
OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, term, count(*) AS c, count(DISTINCT r) AS docs
      FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(c) AS c FROM t GROUP BY ALL HAVING sum(docs) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
n AS (SELECT t.lang, t.source, sum(t.c) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(t.c, 0) AS c,
             1 + (1000000000::HUGEINT * (coalesce(t.c, 0) + 1)::HUGEINT) // (coalesce(n.n, 0) + v.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.c + 1)::HUGEINT) // (v.n + v.v)::HUGEINT AS q
      FROM g JOIN v ON g.lang = v.lang JOIN kept k ON k.lang = g.lang
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
      LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= 200"""

# Trees level by level, then each leaf's steps to the root; crc32 of the id by its table of 256 values.
OP13_SQL = r"""
WITH RECURSIVE
crc_bit AS (SELECT i, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
            UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
            FROM crc_bit WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_bit WHERE k = 8),
fields AS (
  SELECT row_number() OVER () AS r, doc_id, n_chars, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
             lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS hit
  FROM documents, crc_table),
hashed AS (
  SELECT r, doc_id, tree, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END
                                 || tail) AS leaf,
         sha256(head || CASE WHEN n_chars IS NULL THEN '-'
                             ELSE strlen((n_chars + hit::INT)::VARCHAR) || ':' || (n_chars + hit::INT) END || tail) AS shown
  FROM fields),
leaves AS (SELECT r, doc_id, tree, leaf, coalesce(shown, leaf) AS shown,
                  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY tree) AS n FROM hashed),
nodes AS (SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM leaves
          UNION ALL SELECT tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
          FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2, n),
subroots AS (SELECT tree, lvl AS height, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
             FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS lvl, pos, n, h FROM subroots
         UNION ALL SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
         FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
root AS (SELECT lvl AS height, h FROM tops WHERE n = 1),
steps AS (
  SELECT l.r, s.lvl AS step, (l.pos >> s.lvl) & 1 = 1 AS is_right, o.h AS sibling
  FROM leaves l JOIN subroots t USING (tree) JOIN range(64) s(lvl) ON s.lvl < t.height
  LEFT JOIN nodes o ON o.tree = l.tree AND o.lvl = s.lvl AND o.pos = xor(l.pos >> s.lvl, 1)
  UNION ALL
  SELECT l.r, t.height + s.lvl, (t.pos >> s.lvl) & 1 = 1, o.h
  FROM leaves l JOIN subroots t USING (tree) JOIN root ON true JOIN range(64) s(lvl) ON s.lvl < root.height
  LEFT JOIN tops o ON o.lvl = s.lvl AND o.pos = xor(t.pos >> s.lvl, 1)),
fold AS (SELECT r, 0 AS step, shown AS h FROM leaves
         UNION ALL SELECT f.r, f.step + 1, sha256(CASE WHEN s.is_right THEN coalesce(s.sibling, '') || f.h
                                                       ELSE f.h || coalesce(s.sibling, '') END)
         FROM fold f JOIN steps s ON s.r = f.r AND s.step = f.step),
ends AS (SELECT r, arg_max(h, step) AS h FROM fold GROUP BY r),
proofs AS (SELECT r, string_agg(coalesce(sibling, ''), '' ORDER BY step) AS p FROM steps GROUP BY r)
SELECT l.doc_id, l.leaf, t.h AS subroot, root.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, e.h AS folded_root,
       e.h = root.h AS verified, l.pos AS "position"
FROM leaves l JOIN subroots t USING (tree) JOIN root ON true JOIN ends e USING (r) LEFT JOIN proofs p USING (r)"""

ORACLES = {"op1_decontamination": OP1_SQL, "op12_source_divergence": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
