"""The registered queries of this subpackage and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import decontam, lines, mixing, nearjoin, quality, sharding, substrings, topk, toxicity, urls
from vellum.llm.common import held_out, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"], with_text=False)
    return cut.drop("spans")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearjoin.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.plan_mix(table(spark, sf_dir, "documents"), F.array("source"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score_quality(docs, quality.fit(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", F.col("quality_score").alias("score"), F.col("quality_keep").alias("keep"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = lines.dedup_lines(table(spark, sf_dir, "documents"), keep=["doc_id"])
    kept = F.sha2(F.coalesce("deduped", F.lit("")), 256)
    return deduped.select("doc_id", "n_lines", "n_removed", "n_near", kept.alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_toxicity,
        op2_url_filter,
        op3_exact_top_k,
        op4_repeated_strings,
        op5_near_duplicates,
        op6_mixing,
        op7_decontamination,
        op8_quality,
        op9_line_dedup,
        op10_sharding,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": urls.oracle(), 
        "op3_exact_top_k": topk.ORACLE,
        "op4_repeated_strings": substrings.ORACLE,
        "op5_near_duplicates": nearjoin.ORACLE,
        "op7_decontamination": decontam.ORACLE,
        "op9_line_dedup": lines.ORACLE,
        "op10_sharding": sharding.ORACLE,
    }
