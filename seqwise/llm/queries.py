"""Registered queries of the text operators: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqwise.llm import bpe, decontam, fim, fingerprints, fst, html, licenses, lm, quality, simhash, toxicity, trie, urls
from seqwise.llm.common import bounded_batches
from seqwise.llm.oracles import ORACLE

__all__ = ["ORACLE", "QUERIES"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("removed_lines")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, tokenizer("word_bpe_49k.json"), digest=True)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``matches`` as unit:license:millionths of the coefficient, joined by semicolons; so are ``licenses``."""
    out = licenses.scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    match = F.transform("matches", lambda m: F.concat_ws(":", m["unit"], m["license"],
                                                         F.round(m["dice"] * 1_000_000).cast("long")))
    return out.withColumns({"matches": F.array_join(match, ";"), "licenses": F.array_join("licenses", ";")})


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = lm.word_counts(docs)
    words, network = lm.train(docs, counts=counts)
    return lm.score(docs, words, network, keep=["doc_id"], counts=counts)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fst.count_tokens(docs, tokenizer("byte_bpe_50k.json")).withColumn("over_limit", F.col("n_tokens") > 1024)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), keep=["page_id"])


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"), keep=["page_id"]).withColumn("n_chars", F.length("text"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"],
                                  min_item=1)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, keep=["doc_id"]).select("doc_id", "fingerprint", "component_id")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_neighbours(table(spark, sf_dir, "documents"), keep=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_bpe": op2_bpe,
    "op3_licenses": op3_licenses,
    "op4_lm_scores": op4_lm_scores,
    "op5_token_counts": op5_token_counts,
    "op6_url_filter": op6_url_filter,
    "op7_html_text": op7_html_text,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_fingerprints": op13_fingerprints,
}
