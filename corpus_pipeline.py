"""Corpus pipeline: toxicity, near-duplicates, benchmark leaks, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import decontaminate, jaccard_join, mixing, secrets, toxicity
from stratum.llm.common import read_table, settled

SECRET_MARK = "[SECRET]"


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return jaccard_join.keep_one_per_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a near copy of a benchmark item go."""
    return decontaminate.remove_leaking(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; all documents stay."""
    return secrets.redact_rows(docs, SECRET_MARK, size_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target asks for (column ``copy``)."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
]

# The stages' models and searches are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # A stage's own tables go once its result is written.
        docs = settled(spark, partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
