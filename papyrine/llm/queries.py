"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from papyrine.llm import ann, decontaminate, html_wrappers, licenses, near_dedup, packing, quality, sharding, substring_dedup, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_sharding": op4_sharding,
    "op6_quality": op6_quality,
    "op5_decontaminate": op5_decontaminate,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_near_dedup": op8_near_dedup,
    "op9_ann": op9_ann,
    "op10_packing": op10_packing,
}

WORDS_SQL = "regexp_extract_all(lower({0}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

OP5_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL.format("text")} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {WORDS_SQL.format("text")} AS w FROM benchmark),
dg AS (SELECT doc_id, p, array_to_string(w[p : p + 12], ' ') AS g FROM d, unnest(range(1, len(w) - 11)) AS t(p)),
bg AS (SELECT item_id, p, array_to_string(w[p : p + 12], ' ') AS g FROM b, unnest(range(1, len(w) - 11)) AS t(p)),
m AS (SELECT DISTINCT doc_id, item_id, dg.p AS dp, bg.p AS bp FROM dg JOIN bg USING (g)),
s AS (SELECT *, dp - row_number() OVER (PARTITION BY doc_id, item_id, dp - bp ORDER BY dp) AS island FROM m)
SELECT doc_id, item_id, CAST(min(dp) - 1 AS INT) AS doc_start, CAST(min(bp) - 1 AS INT) AS item_start, CAST(count(*) + 12 AS INT) AS n_words
FROM s GROUP BY doc_id, item_id, dp - bp, island
"""

OP4_SQL = """
WITH r AS (SELECT doc_id, source, md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS frac FROM r),
p AS (SELECT *, row_number() OVER (ORDER BY frac, source IS NOT NULL, coalesce(source, ''), h, doc_id NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM k)
SELECT doc_id, source, CAST(place * 64 // n AS INT) AS shard, CAST(place - ceil((place * 64 // n) * n / 64) AS BIGINT) AS position FROM p
"""

ORACLE: dict[str, str] = {
    "op4_sharding": OP4_SQL,
    "op5_decontaminate": OP5_SQL,
}
