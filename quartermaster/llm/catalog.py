"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import (conversation_repair, decontaminate, folds_sql, lang_id, license_scan, line_dedup, mixing,
               quality_rules, secret_scan, setsketch, simhash, spelling, suffix_dedup, warc_fixity)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.line_dedup(docs).select("row.doc_id", F.col("kept_text").alias("text"),
                                              "n_lines", "n_dropped")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "source", mixing.word_count("text").alias("words"))
    return mixing.mix(docs, size="words").select(
        "row.doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that differ between the archives of all pages and an aged
    replica of them."""
    records = warc_fixity.archive_records(table(spark, sf_dir, "pages"))
    return warc_fixity.audit(records, warc_fixity.aged_replica(records))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    return simhash.components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages found in each document."""
    return decontaminate.report(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                table(spark, sf_dir, "benchmark"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without its repeated 200-byte strings."""
    return suffix_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of each document."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_words")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License places, labels and score of each document."""
    return license_scan.license_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of the documents with the forest's score."""
    return secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model_from = docs
    return lang_id.identify(docs.select("doc_id", "text"), learn_from=model_from).select(
        "row.doc_id", lang_id.held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of each document, by word shingles."""
    return setsketch.near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of each damaged conversation."""
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.report(damaged, gone=F.col("gone"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of each word of the documents, some of which lost a letter."""
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"), noise=97)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_source_mix, op3_warc_fixity, op4_simhash_near_dedup, op5_benchmark_decontamination,
    op6_suffix_array_dedup, op7_quality_rules, op8_license_scan, op9_secret_scan, op10_language_id,
    op11_minhash_near_dedup, op12_conversation_repair, op13_spelling_variants)}

ORACLES = {
    "op1_line_dedup": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS MATERIALIZED (
  SELECT rid, source, line, pos, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line_key
  FROM (SELECT rid, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d)),
c AS (SELECT source, line_key, count(DISTINCT rid) AS n FROM l WHERE line_key <> '' GROUP BY source, line_key),
t AS (SELECT source, count(*) AS total FROM d GROUP BY source),
b AS (SELECT c.source, c.line_key FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
      WHERE n >= 5 AND n::DOUBLE > 0.1::DOUBLE * total),
k AS (SELECT l.rid, count(*) AS n_lines, count(b.line_key) AS n_dropped,
             string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE b.line_key IS NULL) AS kept
      FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line_key = b.line_key GROUP BY l.rid)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM d LEFT JOIN k ON d.rid = k.rid
""",
    "op5_benchmark_decontamination": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS MATERIALIZED (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
place AS MATERIALIZED (
  SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS phrase
  FROM (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
m AS MATERIALIZED (
  SELECT place.rid, place.p, place.n, win.item FROM place JOIN win ON place.n = win.n AND place.phrase = win.phrase),
h AS (SELECT rid, count(DISTINCT pos) AS n_hit
      FROM (SELECT rid, unnest(range(p, p + n)) AS pos FROM m) GROUP BY rid),
post AS MATERIALIZED (
  SELECT rid, term, pos FROM (SELECT rid, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM d)
  WHERE term IN (SELECT unnest(w) FROM i)),
cf AS (SELECT term, count(*) AS f FROM post GROUP BY term),
wt AS MATERIALIZED (
  SELECT wid, item, n, j, w[p + j] AS term
  FROM (SELECT *, row_number() OVER () AS wid
        FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p
              FROM i WHERE len(w) > 0)) AS q, unnest(range(0, n)) AS u(j)),
rare AS MATERIALIZED (
  SELECT wid, n, j, term FROM (
    SELECT wt.*, row_number() OVER (PARTITION BY wid ORDER BY coalesce(f, 0), j) AS rank
    FROM wt LEFT JOIN cf ON wt.term = cf.term) WHERE rank <= n - ceil(0.8::DOUBLE * n) + 1),
cand AS MATERIALIZED (
  SELECT DISTINCT rid, wid, pos - j + shift AS start
  FROM rare JOIN post ON rare.term = post.term, (SELECT unnest(range(-2, 3)) AS shift)),
near AS (
  SELECT cand.rid, wt.item, wt.n, count(DISTINCT wt.j) AS hits,
         count(*) FILTER (WHERE post.pos = cand.start + wt.j) AS same
  FROM cand JOIN wt ON cand.wid = wt.wid
       JOIN post ON post.rid = cand.rid AND post.term = wt.term
                AND post.pos BETWEEN cand.start + wt.j - 2 AND cand.start + wt.j + 2
  GROUP BY cand.rid, cand.wid, wt.item, wt.n, cand.start),
y AS (SELECT rid, count(DISTINCT item) AS n_near_items FROM near
      WHERE hits >= ceil(0.8::DOUBLE * n) AND same BETWEEN 1 AND n - 1 GROUP BY rid),
x AS (SELECT rid, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items_sha256
      FROM m GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(x.n_items, 0) AS n_items,
       coalesce(x.items_sha256, sha256('')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated,
       coalesce(y.n_near_items, 0) AS n_near_items
FROM d LEFT JOIN h ON d.rid = h.rid LEFT JOIN x ON d.rid = x.rid LEFT JOIN y ON d.rid = y.rid
""",
    "op3_warc_fixity": r"""
WITH r AS MATERIALIZED (
  SELECT page_id, CASE WHEN page_id < 0 THEN -(-page_id // 1000) ELSE page_id // 1000 END AS archive,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13)
         || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record,
         ('0x' || substr(md5(concat_ws('|', 'aged', page_id::VARCHAR)), 1, 8))::BIGINT AS draw
  FROM pages),
a AS MATERIALIZED (
  SELECT *, sha256(record) AS sha, coalesce(sum(strlen(record)) OVER (
           PARTITION BY archive ORDER BY page_id, sha256(record)
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM r)
SELECT archive, "offset" // 65536 AS leaf, "offset", page_id AS record_id, 'missing' AS status, sha AS sha_a, NULL AS sha_b
FROM a WHERE draw % 89 = 0
UNION ALL
SELECT archive, "offset" // 65536, "offset", page_id, 'changed', sha, sha256(record[1:4] || '#' || record[6:])
FROM a WHERE draw % 89 <> 0 AND draw % 97 = 0
UNION ALL
SELECT archive, ("offset" + 1099511627776) // 65536, "offset" + 1099511627776, page_id, 'extra', NULL, sha
FROM a WHERE draw % 89 <> 0 AND draw % 83 = 0
""",
    "op7_quality_rules": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS MATERIALIZED (
  SELECT rid, source, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT rid, source, unnest(string_split(t, chr(10))) AS line FROM d)),
k AS MATERIALIZED (
  SELECT rid, source, line, array_to_string(lw, ' ') AS line_key, len(lw) AS n FROM l WHERE len(lw) > 0),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM k GROUP BY rid),
c AS (SELECT source, line_key, count(DISTINCT rid) AS n FROM k GROUP BY source, line_key),
h AS (SELECT source, count(*) AS n FROM d GROUP BY source),
above AS MATERIALIZED (
  SELECT c.source, c.line_key FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source
  WHERE c.n > 5 OR (c.n >= 3 AND c.n::DOUBLE > 0.1::DOUBLE * h.n)),
gone AS (SELECT k.rid, sum(k.n)::BIGINT AS n_removed
         FROM k JOIN above ON k.source IS NOT DISTINCT FROM above.source AND k.line_key = above.line_key GROUP BY k.rid),
tri AS MATERIALIZED (
  SELECT rid, p, array_to_string(w[p:p + 2], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM d)),
rep AS (SELECT rid, count(DISTINCT pos) AS n_repeat FROM (
          SELECT rid, unnest([p, p + 1, p + 2]) AS pos FROM (
            SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM tri) WHERE n > 1) GROUP BY rid),
x AS (
  SELECT d.rid, d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
         coalesce(n_removed, 0) AS n_removed_words
  FROM d LEFT JOIN dup ON d.rid = dup.rid LEFT JOIN rep ON d.rid = rep.rid LEFT JOIN gone ON d.rid = gone.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_removed_words > 0.5 * n_words) AS kept
FROM x
""",
    "op8_license_scan": r"""
WITH tpl(template, label, is_phrase, words) AS (VALUES TEMPLATES),
tg AS MATERIALIZED (
  SELECT template, label, is_phrase, len(w) - 2 AS n_grams, t_pos, array_to_string(w[t_pos + 1:t_pos + 3], ' ') AS g
  FROM (SELECT *, string_split(words, ' ') AS w, unnest(range(0, len(string_split(words, ' ')) - 2)) AS t_pos FROM tpl)),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
hit AS MATERIALIZED (
  SELECT rid, template, label, is_phrase, n_grams, t_pos, pos, pos - t_pos AS diagonal
  FROM (SELECT rid, pos, array_to_string(w[pos + 1:pos + 3], ' ') AS g
        FROM (SELECT rid, w, unnest(range(0, len(w) - 2)) AS pos FROM d)) JOIN tg USING (g)),
diag AS MATERIALIZED (
  SELECT rid, template, label, is_phrase, n_grams, diagonal, count(*) AS votes
  FROM hit GROUP BY ALL),
island AS (
  SELECT rid, template, diagonal, sum(cut) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) <= 4
                       THEN 0 ELSE 1 END AS cut FROM diag WHERE NOT is_phrase)),
whole AS (
  SELECT rid, label, count(DISTINCT t_pos) / any_value(n_grams) AS cover, any_value(n_grams) AS n_grams,
         max(pos) + 2 - min(pos) + 1 AS width
  FROM hit JOIN island USING (rid, template, diagonal) GROUP BY rid, template, label, span),
found AS (
  SELECT rid, label, true AS base, diagonal AS first, 1.0::DOUBLE AS cover FROM diag WHERE is_phrase AND votes = n_grams
  UNION ALL
  SELECT rid, label, false, NULL, cover FROM whole WHERE cover >= CASE WHEN n_grams < 12 THEN 1.0 ELSE 0.6 END::DOUBLE AND width <= 2 * (n_grams + 2)),
agg AS (
  SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(first) AS first_word, max(first) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
  FROM found GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN agg USING (rid)
""",
}
ORACLES["op8_license_scan"] = ORACLES["op8_license_scan"].replace("TEMPLATES", ", ".join(
    f"({k}, '{label}', {str(k < len(license_scan.PHRASES)).lower()}, '{words}')"
    for k, (label, words) in enumerate(license_scan.PHRASES + license_scan.TEMPLATES)))
ORACLES |= {"op11_minhash_near_dedup": folds_sql.OP11, "op12_conversation_repair": folds_sql.OP12,
            "op13_spelling_variants": folds_sql.OP13}
