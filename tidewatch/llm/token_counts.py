"""Token counts from an exact histogram of encoded lengths.

Documents are aggregated by encoded length, so what is kept is one row per distinct length. Sums over the
longer lengths (suffix sums) then answer, for every context limit, how many documents exceed it, the tokens that
remain when each document is cut to it, and which share of documents and tokens fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import encoding
from tidewatch.llm.common import chunks_of, running_sums
from tidewatch.runtime import materialize

#: Bytes of text encoded at a time in a Python worker.
CHUNK_BYTES = 4 << 20


def token_lengths(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(n_tokens): the encoded length of each row's text; null and empty texts have 0 tokens."""
    path = path or encoding.default_vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding.encoder(path)
        for part in chunks_of(batches, "text", CHUNK_BYTES):
            sizes = [len(ids) // 4 for ids in encoder.encode(part.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_tokens"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "n_tokens long")


def length_histogram(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(n_tokens, n_docs), exact. An empty table gives no rows; repeated rows count each."""
    return materialize(token_lengths(docs, text, path).groupBy("n_tokens").agg(
        F.count(F.lit(1)).alias("n_docs")), "length-histogram")


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, taken as context limit: (context_limit, n_docs, docs_longer, tokens_longer,
    truncated_tokens, total_docs, total_tokens, docs_within, tokens_within).

    `truncated_tokens` is the sum of min(length, limit). Between two rows it grows by `docs_longer` per
    token, so `at_limit` answers every limit from these rows. `docs_within` is the limit's quantile.
    """
    rows = histogram.withColumn("n_tokens_all", F.col("n_tokens") * F.col("n_docs"))
    # Longest first: what stands before a row is the suffix sum over the longer lengths.
    rows = running_sums(rows, [F.col("n_tokens").desc()], ["n_docs", "n_tokens_all"], "suffix-sums")
    totals = histogram.agg(F.sum("n_docs").alias("total_docs"),
                           F.sum(F.col("n_docs") * F.col("n_tokens")).alias("total_tokens"))
    rows = rows.join(F.broadcast(totals))  # one row
    longer, tokens = F.col("before_n_docs"), F.col("before_n_tokens_all")
    return rows.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", longer.alias("docs_longer"),
        tokens.alias("tokens_longer"),
        (F.col("total_tokens") - tokens + longer * F.col("n_tokens")).alias("truncated_tokens"),
        "total_docs", "total_tokens",
        ((F.col("total_docs") - longer) / F.col("total_docs")).alias("docs_within"),
        F.when(F.col("total_tokens") > 0, (F.col("total_tokens") - tokens) / F.col("total_tokens"))
        .otherwise(F.lit(1.0)).alias("tokens_within"))


def at_limit(limits: DataFrame, limit: int) -> DataFrame:
    """One row (context_limit, docs_longer, truncated_tokens, total_tokens) for any limit."""
    below = limits.where(F.col("context_limit") <= limit)
    known = below.agg(F.max_by(F.struct("context_limit", "docs_longer", "truncated_tokens"), "context_limit").alias("k"))
    totals = limits.agg(F.first("total_docs").alias("total_docs"), F.first("total_tokens").alias("total_tokens"))
    step = F.lit(limit) - F.coalesce(F.col("k.context_limit"), F.lit(0))
    longer = F.coalesce(F.col("k.docs_longer"), F.col("total_docs"), F.lit(0))
    return known.join(F.broadcast(totals)).select(  # one row each
        F.lit(limit).cast("long").alias("context_limit"), longer.alias("docs_longer"),
        (F.coalesce(F.col("k.truncated_tokens"), F.lit(0)) + longer * step).alias("truncated_tokens"),
        F.coalesce("total_tokens", F.lit(0)).alias("total_tokens"))


def length_quantile(limits: DataFrame, share: float) -> DataFrame:
    """One row (n_tokens): the smallest length that at least `share` of the documents do not exceed."""
    return limits.where(F.col("docs_within") >= share).agg(F.min("context_limit").alias("n_tokens"))
