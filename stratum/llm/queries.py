"""The registered ``opN_*`` queries: thin wrappers that derive the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (
    decontaminate,
    importance,
    jaccard_join,
    mixing,
    pu_quality,
    secrets,
    substring_dedup,
    suffix_dedup,
    topk,
    toxicity,
    urls,
    warc,
    whitening,
)
from stratum.llm.common import read_table, scratch_uri

URL_RULES = (urls.Rule("net/", "block"), urls.Rule("example.net/en/", "allow"),
             urls.Rule("example.com/de/", "block"), urls.Rule("org/fr/", "allow"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"), window=35)


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(read_table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id", F.col("_size").alias("size"), F.col("_ssize").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", "evidence_ids")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"), window=400)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.concat("_assign", "_access", "_hex")
    n = lambda c: F.size(c).cast("long")
    return found.select(
        "doc_id", n("_assign").alias("n_assign"), n("_access").alias("n_access"),
        n("_hex").alias("n_hex"), F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"),
        secrets.joined_spans(F.concat(base, F.col("_markov"))).alias("spans"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), k=10, every=100)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(read_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "word_start", "hamming", "similarity")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_uri(spark, "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages"), root)
    return warc.read_warc(spark, root).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_resample(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=32)
    return whitening.per_component(whitened)


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score_documents(read_table(spark, sf_dir, "documents"),
                                      read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mix": op2_mix,
    "op3_toxicity": op3_toxicity,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_secret_scan": op6_secret_scan,
    "op7_topk": op7_topk,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_importance_resample": op11_importance_resample,
    "op12_whitening": op12_whitening,
    "op13_quality": op13_quality,
}
