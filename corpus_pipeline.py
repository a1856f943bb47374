"""Corpus pipeline: quality rules, toxicity, near-duplicates, decontamination, encoding.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` applies them to ``documents``: every stage is written as
Parquet to the shared folder and reread as the next one's ``docs``. All stages
but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqwise.llm import bpe, decontam, quality, simhash, toxicity
from seqwise.llm.common import bounded_batches, staged
from seqwise.llm.queries import table, tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines leave the texts of the others."""
    bounded_batches(spark)
    out = quality.clean_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go. The chain is fitted on the labelled rows of ``docs``."""
    bounded_batches(spark)
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).filter("NOT is_toxic").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: the one with the smallest id."""
    bounded_batches(spark)
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    bounded_batches(spark)
    out = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), min_item=1)
    return out.filter("NOT contaminated").select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, each decoded again and checked."""
    bounded_batches(spark)
    out = bpe.encode(docs.select("doc_id", "text"), tokenizer("word_bpe_49k.json"), decoded=False, verify=True)
    return out.select("doc_id", "n_tokens", "token_ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe_encoding", encoding_stage),
]

#: Merge rules, trained models and component search are not SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
