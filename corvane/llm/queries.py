"""The queries that apply each operator to its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import (
    decontaminate,
    html_extract,
    langid,
    line_dedup,
    packing,
    quality,
    secrets,
    simhash,
    token_count,
    toxicity,
)
from corvane.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.report(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_line_dedup,
        op3_quality_rules,
        op4_best_fit_packing,
        op5_language_id,
        op6_simhash_near_dedup,
        op7_secret_scan,
        op8_html_extraction,
        op9_toxicity,
        op10_token_counts,
    )
}

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op1_decontaminate": rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
piece AS (
  SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[s:s + n - 1], ' ') AS key FROM piece),
spot AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, spot.n, item FROM spot JOIN win USING (n, key)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
who AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN who USING (doc_id)""",
    "op2_line_dedup": rf"""
WITH line AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS p
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, {_FOLD.format("regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')")} AS key FROM line),
many AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(many.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE many.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN many USING (key) GROUP BY doc_id""".replace("\\\\x", "\\x"),
}
