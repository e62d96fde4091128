"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlane.llm import (decontaminate, divergence, exact_dedup, language, licenses, mixing, pseudonyms, quality, reputation,
                           secrets, simhash, vector_codes, wrappers)
from churnlane.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Key of the registered pseudonym query; a deployment passes its own.
KEY = "demonstration key"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return register


@query("op1_mix_sources", mixing.oracle(mixing.PRODUCTION))
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "domain", "lang", "source", "tokens", "copies")


@query("op6_decontaminate", r"""
WITH norm_docs AS (SELECT row_number() OVER () AS rid, doc_id, trim(regexp_replace(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) AS t FROM documents),
docs AS (SELECT rid, doc_id, CASE WHEN t = '' THEN [] ELSE string_split(t, ' ') END AS w FROM norm_docs),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, string_split(t, ' ') AS w FROM (SELECT item_id, trim(regexp_replace(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) AS t
    FROM benchmark) WHERE t <> ''),
windows AS (SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS win, least(13, len(w)) AS n
    FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM items)),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
found AS (SELECT DISTINCT rid, i, spots.n, item FROM spots JOIN windows ON windows.n = spots.n
    AND array_to_string(w[i:i + spots.n - 1], ' ') = win),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid),
owned AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN owned USING (rid)""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op8_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) WINDOW g AS (PARTITION BY t)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
                        secrets.listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


@query("op4_pseudonyms")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(read(spark, sf_dir, "documents"), KEY).select(
        F.col("id").alias("doc_id"), "text", F.size(F.coalesce("findings", F.array())).cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("findings.kind")), ",").alias("kinds"))


@query("op5_url_reputation", reputation.oracle())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = reputation.judge_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


@query("op10_license_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("findings")


@query("op3_wrapper_extract")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op13_source_divergence", divergence.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read(spark, sf_dir, "documents"))


@query("op12_vector_codes", vector_codes.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(coded).select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                                                        F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"))


@query("op11_quality_ratio")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")
