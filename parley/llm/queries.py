"""The registered queries: each operator over its whole table, cut to the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import (
    centroid_clustering,
    decontamination,
    fast_similarity,
    jaccard_join,
    license_scan,
    maxent_lm,
    packing,
    quality_classifier,
    quality_rules,
    source_divergence,
    substring_dedup,
    toxicity,
    url_filters,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_texts(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_file())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = jaccard_join.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = F.max(F.struct("n_matched", (-F.col("n_changed")).alias("unchanged"), "n_item", "n_slots")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_matched", "best.n_item", "best.n_slots", (-F.col("best.unchanged")).alias("n_changed"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules of the contract: (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, rule_verdict string")
    return url_filters.judged(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.with_inertia(*centroid_clustering.centroid_clustering(table(spark, sf_dir, "embeddings")))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(table(spark, sf_dir, "documents"))


def op13_fast_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fast_similarity.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_maxent_lm": op1_maxent_lm,
    "op2_license_scan": op2_license_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_decontamination": op8_decontamination,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_url_filters": op10_url_filters,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_source_divergence": op12_source_divergence,
    "op13_fast_similarity": op13_fast_similarity,
}

ORACLE: dict[str, str] = {
    "op2_license_scan": license_scan.oracle_sql(),
    "op6_substring_dedup": substring_dedup.oracle_sql(),
    "op7_jaccard_join": jaccard_join.oracle_sql(),
    "op8_decontamination": decontamination.oracle_sql(),
    "op10_url_filters": url_filters.oracle_sql(URL_RULES),
    "op11_centroid_clustering": centroid_clustering.oracle_sql(),
    "op12_source_divergence": source_divergence.oracle_sql(),
    "op13_fast_similarity": fast_similarity.oracle_sql(),
}
