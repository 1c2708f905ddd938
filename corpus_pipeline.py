"""From raw documents to encoded training text: judged, cleaned, deduplicated, mixed and encoded.

Every stage takes the rows its predecessor kept; the first four return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import jaccard_join, line_crf, mixing, quality_rules, trie_bpe
from tidewatch.llm.common import table
from tidewatch.runtime import materialize


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field accepts; it learns from the labelled ones among them."""
    return line_crf.keep_accepted(docs, table(spark, sf_dir, "labels"))


def pass_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fences of their language and source."""
    return quality_rules.keep_good(docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies."""
    return jaccard_join.keep_one(docs)


def take_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and digests of the ids and of the decoded text, in place of the text."""
    return trie_bpe.encode_documents(docs, ids=True, keep_words=False).drop("text")


STAGES = [
    ("quality classifier", accept_quality),
    ("quality rules", pass_rules),
    ("n-gram Jaccard join", keep_one_copy),
    ("mixing sources to target weights", take_mix),
    ("BPE encoding and decoding", encode),
]

#: The classifier and the encoding have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage keeps is written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
