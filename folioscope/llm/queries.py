"""The registered queries of this subpackage and their SQL, one ``opN_<name>`` each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import centroids, cross_tokens, decontaminate, gam, html_extract, langid, lm_score, ngram_join, packing, quality, token_output, unigram, warc

WORD_BPE, PIECES, BYTE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model", "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"), PIECES)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).drop("clean_text")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), WORD_BPE)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).drop("url")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.training_order(table(spark, sf_dir, "documents"), WORD_BPE)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.lloyd(table(spark, sf_dir, "embeddings"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens.cross_alignment(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_rules": op4_quality_rules,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_warc": op6_warc,
    "op7_decontamination": op7_decontamination,
    "op8_language_id": op8_language_id,
    "op9_token_output": op9_token_output,
    "op10_html_extraction": op10_html_extraction,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_quality_classifier": op13_quality_classifier,
}

ORACLES: dict[str, str] = {
    "op11_centroid_clustering": centroids.oracle(),
    "op2_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS t
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, CASE WHEN len(ws) > 0 THEN 1 ELSE 0 END))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * common >= 75 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least(m.m, w.doc_id), w.doc_id)::BIGINT AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(seen) AS m FROM r GROUP BY node) m USING (doc_id)""",
    "op4_quality_rules": r"""
WITH l AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
c AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth, count(*) OVER (PARTITION BY doc_id, line) AS times FROM l),
f AS (SELECT *, n > 0 AND (
    (len(regexp_extract_all(line, '[|»•›>]')) >= 1 AND len(regexp_extract_all(line, '[|»•›>]')) * 6 >= n) OR (times >= 3 AND n <= 8) OR len(regexp_extract_all(line, '!!|[#*$%&]{2,}')) * 2 > n
    OR (n <= 25 AND regexp_matches(lower(line), 'all rights reserved|licensed under|released under the|terms of use|terms of service|privacy policy|cookie policy|use cookies|enable javascript|subscribe to our|sign up for|click here|copyright \(c\)|©|tous droits réservés|conditions d''utilisation|politique de confidentialité|utilisons des cookies|cliquez ici|alle rechte vorbehalten|nutzungsbedingungen|datenschutzerklärung|verwenden cookies|klicken sie hier|todos los derechos reservados|términos de uso|política de privacidad|usamos cookies|haga clic aquí'))
    OR ((n < 4 OR (n > 25 AND n > 25 * len(regexp_extract_all(line, '[.!?…,;:]')))) AND NOT regexp_matches(line, '[.!?…"''”’»):;][ \t\n\r\x0b\x0c]*$'))
    OR (n >= 16 AND 2 * len(regexp_extract_all(line || ' ', '[.!?…]["''”’»)]*[ \t\n\r\x0b\x0c]')) > n)) AS fails FROM c),
g AS (SELECT doc_id, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (fails) AS n_lines_removed, coalesce(sum(n) FILTER (fails), 0) AS words_removed, count(*) FILTER (n > 0 AND nth > 1) AS n_dup_lines FROM f GROUP BY 1),
w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
v AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS win FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w)),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS k FROM v) WHERE k > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM t) GROUP BY 1),
b AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * words_removed <= 40 * n_words AS kept,
  n_lines::BIGINT AS n_lines, n_lines_removed::BIGINT AS n_lines_removed, words_removed::BIGINT AS words_removed FROM b JOIN g USING (doc_id)""",
    "op6_warc": r"""
WITH h AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT hex, array_to_string(list_transform(string_split(hex, ''), lambda x: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', x)]), '') AS bits FROM (SELECT DISTINCT hex FROM h)),
e AS (SELECT hex, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  (16 * substr(bits, 5 * k + 1, 1)::BIGINT + 8 * substr(bits, 5 * k + 2, 1)::BIGINT + 4 * substr(bits, 5 * k + 3, 1)::BIGINT + 2 * substr(bits, 5 * k + 4, 1)::BIGINT + substr(bits, 5 * k + 5, 1)::BIGINT + 1)::BIGINT, 1)), '') AS digest FROM d),
m AS (SELECT hex, max(page_id) AS top FROM h GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM h JOIN e USING (hex) JOIN m USING (hex)""",
    "op7_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS m FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
p AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i+m-1], ' ') AS win FROM (SELECT *, unnest(generate_series(1, len(ws) - m + 1)) AS i FROM b)),
w AS (SELECT doc_id, m, i, array_to_string(ws[i:i+m-1], ' ') AS win FROM (SELECT doc_id, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS i FROM d, (SELECT DISTINCT m FROM b))),
h AS (SELECT doc_id, w.m, i, item_id FROM w JOIN p ON p.m = w.m AND p.win = w.win),
n AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS x FROM h) GROUP BY 1),
s AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)""",
}
