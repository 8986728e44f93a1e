"""Registered queries of this subpackage and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    collocations,
    decontaminate,
    html,
    mixing,
    near,
    neighbours,
    notices,
    quality,
    ranking,
    repeats,
    secrets,
    tokens,
    toxicity,
)

#: The vocabulary of the token counts; a name in the installed folder of public tokenizers.
TOKENIZER = "byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def _contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def _main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(_read(spark, sf_dir, "pages"))


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(_read(spark, sf_dir, "documents"))


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_read(spark, sf_dir, "documents"))


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_read(spark, sf_dir, "documents"), size=3, part=85, whole=100)


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def _mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_read(spark, sf_dir, "documents"))


def _licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.report(_read(spark, sf_dir, "documents"))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def _collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_quality_classifier": _quality,
    "op2_decontamination": _contamination,
    "op3_toxicity": _toxicity,
    "op4_html_extraction": _main_texts,
    "op5_suffix_dedup": _repeats,
    "op6_token_counts": _token_counts,
    "op7_secret_scan": _secrets,
    "op8_minhash_near_dedup": _near_duplicates,
    "op9_nearest_neighbours": _nearest,
    "op10_source_mixing": _mix,
    "op11_license_scan": _licenses,
    "op12_lexical_search": _ranked,
    "op13_collocations": _collocations,
}

DECONTAMINATION_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS window_text
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS window_text
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
    SELECT doc_id, p.n, i, item_id FROM places p JOIN windows v ON p.window_text = v.window_text AND p.n = v.n
), hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
), held AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""

# Bytes as hex digits; texts in pieces, so that cutting windows stays linear in their length.
REPEAT_SQL = """
WITH texts AS (
    SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), pieces AS (
    SELECT r, base, substring(h, 2 * base + 1, 1822) AS piece
    FROM (SELECT r, h, unnest(range(0, greatest(strlen(h) // 2 - 399, 0), 512)) AS base FROM texts)
), windows AS (
    SELECT r, base + i AS i, md5(substring(piece, 2 * i + 1, 800)) AS m
    FROM (SELECT r, base, piece, unnest(range(0, strlen(piece) // 2 - 399)) AS i FROM pieces)
), repeated AS (
    SELECT r, i FROM windows WHERE m IN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1)
), marked AS (
    SELECT r, i, sum(CASE WHEN i - before <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS island
    FROM (SELECT r, i, lag(i, 1, -1000) OVER (PARTITION BY r ORDER BY i) AS before FROM repeated)
), spans AS (
    SELECT r, min(i) AS low, max(i) + 400 AS high FROM marked GROUP BY r, island
), gaps AS (
    SELECT r, coalesce(lag(high) OVER (PARTITION BY r ORDER BY low), 0) AS low, low AS high FROM spans
    UNION ALL SELECT r, max(high), NULL FROM spans GROUP BY r
), kept AS (
    SELECT g.r, string_agg(substring(h, 2 * g.low + 1, coalesce(2 * (g.high - g.low), strlen(h))), '' ORDER BY g.low) AS h
    FROM gaps g JOIN texts USING (r) GROUP BY g.r
), sums AS (
    SELECT r, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, (strlen(t.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN sums USING (r) LEFT JOIN kept k USING (r)
"""

NEAR_DUPLICATE_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_n
    FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
    WHERE 100 * both_n >= 85 * (p.n + q.n - both_n)
), either AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, y FROM reached r JOIN either ON r.other = x
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id, d.doc_id = least_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS least_id FROM reached GROUP BY doc_id) r ON d.doc_id = r.doc_id
"""

LLM_ORACLES = {
    "op2_decontamination": DECONTAMINATION_SQL,
    "op5_suffix_dedup": REPEAT_SQL,
    "op8_minhash_near_dedup": NEAR_DUPLICATE_SQL,
    "op10_source_mixing": mixing.MIX_SQL,
    "op11_license_scan": notices.LICENSE_SQL,
    "op12_lexical_search": ranking.RANKED_SQL,
    "op13_collocations": collocations.COLLOCATION_SQL,
}
