"""One query per operator over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripstats.llm import (
    collocations,
    conversations,
    credentials,
    decontamination,
    html_text,
    language,
    lines,
    near_copies,
    ngram_join,
    oracles,
    packing,
    quality,
    rules,
    substrings,
)
from tripstats.llm.shared import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(read(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(read(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(read(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(read(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(read(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.report(read(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(read(spark, sf_dir, "conversations"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(read(spark, sf_dir, "documents"))


def registered() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


_SUBSTRINGS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM p WHERE i + 12 <= len(w)),
firsts AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM win JOIN firsts USING (s) WHERE f < doc_id),
kept AS (
  SELECT p.doc_id, count(hit.i) AS n, string_agg(p.w[p.i], ' ' ORDER BY p.i) FILTER (hit.i IS NULL) AS t
  FROM p LEFT JOIN hit ON p.doc_id = hit.doc_id AND p.i = hit.i GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (SELECT item, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM bw),
sizes AS (SELECT DISTINCT k FROM windows),
dw AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
found AS (
  SELECT doc_id, i, dw.k, item FROM dw JOIN windows ON windows.k = dw.k AND windows.s = array_to_string(w[i:i + dw.k - 1], ' ')
), hits AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the exact operators. The others fit models, tokenize, or add links by method."""
    return {
        "op3_substring_dedup": _SUBSTRINGS,
        "op6_decontamination": _DECONTAMINATION,
        "op9_minhash_near_dedup": oracles.similar_documents(5, 75, kept=True),
        "op11_phrase_collocations": oracles.COLLOCATIONS,
        "op12_conversation_repair": oracles.CONVERSATIONS,
        "op13_ngram_jaccard_join": oracles.similar_documents(4, 85, kept=False),
    }
