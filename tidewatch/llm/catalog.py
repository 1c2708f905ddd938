"""The corpus operators as queries over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import (
    collocations, hmm, html_text, jaccard_join, line_crf, mixing, pu_toxicity, quality_rules, repair, segment_resampling,
    token_counts, topk, trie_bpe,
)
from tidewatch.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.limit_table(token_counts.length_histogram(docs))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op4_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return trie_bpe.encode_documents(docs).drop("text")


def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.write_and_read(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    found = (op1_html_extraction, op2_token_counts, op3_mixing, op4_trie_bpe, op5_hidden_markov, op6_quality_rules,
             op7_topk, op8_jaccard_join, op9_line_crf, op10_repair, op11_collocations,
             op12_resampling, op13_toxicity)
    return {f.__name__: f for f in found}


def sql() -> dict[str, str]:
    return {"op3_mixing": mixing.SQL, "op6_quality_rules": quality_rules.SQL, "op7_topk": topk.SQL,
            "op11_collocations": collocations.SQL, "op12_resampling": segment_resampling.SQL}
