"""One query for each operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationday.llm import (
    ann,
    clustering,
    decontamination,
    licenses,
    neardup,
    packing,
    pages,
    quality,
    recompression,
    resampling,
    secrets,
    sharding,
    toxicity,
)
from stationday.llm.common import table


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents"), width=4)


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(docs, secrets.train(docs))


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, sf_dir, "documents"))


def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": license_scan,
    "op2_vector_shards": shards,
    "op3_toxicity": toxic,
    "op4_near_duplicates": near_duplicates,
    "op5_main_text": main_text,
    "op6_decontamination": leaks,
    "op7_packing": packed,
    "op8_nearest": nearest,
    "op9_secrets": secret_spans,
    "op10_quality": good,
    "op11_repeats": repeats,
    "op12_resampling": resampled,
    "op13_clusters": clusters,
}

_NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END)) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached(id, root) AS (
  SELECT doc_id, doc_id FROM words UNION SELECT links.b, root FROM reached JOIN links ON links.a = id)
SELECT id AS doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(root) AS component_id, id = min(root) AS kept
FROM reached LEFT JOIN sizes ON sizes.doc_id = id GROUP BY id"""

ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.oracle(),
    "op4_near_duplicates": _NEAR_DUPLICATES,
    "op11_repeats": recompression.oracle(),
    "op12_resampling": resampling.oracle(),
    "op13_clusters": clustering.oracle(),
}
