"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of (term, weight); its terms are its dimensions, its weights whole numbers. The query
set is taken in blocks of bounded size. For a block, every task turns its share of all rows into postings by term, and
each query adds its weighted postings, one term after another, to a dense array of scores. From the array it
selects its best k; the selections of all tasks are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.runtime import materialize

#: Queries broadcast at a time: at most this many rows of whole numbers on average (blocks are dealt by hash).
QUERY_BLOCK = 4096

#: Rows whose scores a task holds at a time, for so many queries.
ROW_BLOCK = 2048
QUERY_ROWS = 256

SCALE = 256
EVERY = 50


def weights(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null where the vector or a component is null or not finite."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    good = embedding.isNotNull() & ~F.exists(embedding, bad)
    return F.when(good, F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row starts, values) of a column of lists."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return starts, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def postings(starts: np.ndarray, values: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """For each term the rows that have it, ascending, and their weights; a slice where all rows have it."""
    n = len(starts) - 1
    sizes = np.diff(starts)
    row = np.repeat(np.arange(n), sizes)
    term = np.arange(len(values)) - np.repeat(starts[:-1], sizes)
    there = values != 0
    row, term, values = row[there], term[there], values[there]
    order = np.argsort(term, kind="stable")
    row, term, values = row[order], term[order], values[order]
    ends = np.searchsorted(term, np.arange(int(sizes.max(initial=0)) + 1))
    return [(slice(0, n) if b - a == n else row[a:b], values[a:b]) for a, b in zip(ends, ends[1:])]


def accumulate(query: np.ndarray, lists: list, scores: np.ndarray) -> None:
    """Add the query's weighted postings to `scores`, a term at a time."""
    for term in np.flatnonzero(query[:len(lists)]):
        rows, held = lists[term]
        scores[rows] += query[term] * held


def select(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """(score, id) of the best k: highest score first, then smallest id."""
    others = ids != own
    if not others.all():
        scores, ids = scores[others], ids[others]
    if len(scores) > k:
        least = -np.partition(-scores, k - 1)[k - 1]
        near = np.flatnonzero(scores >= least)
        scores, ids = scores[near], ids[near]
    best = np.lexsort((ids, -scores))[:k]
    return list(zip(scores[best].tolist(), ids[best].tolist()))


def _search_block(rows: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """(query_id, query_no, score, vec_id): per task, the best k of its rows for each query of one block."""
    spark = rows.sparkSession
    found = block.collect()  # one block of bounded size
    queries = spark.sparkContext.broadcast([(r[0], r[1], np.array(r[2], dtype=np.int64)) for r in found])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = queries.value
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        for batch in batches:
            for first in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(first, ROW_BLOCK)
                ids = part.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
                lists = postings(*_flat(part.column("w")))
                for q, (query_id, _, query) in enumerate(asked):
                    scores = np.zeros(len(ids), dtype=np.int64)
                    accumulate(query, lists, scores)
                    best[q] = sorted(best[q] + select(scores, ids, query_id, k), key=lambda x: (-x[0], x[1]))[:k]
        flat = [(a[0], a[1], s, i) for a, b in zip(asked, best) for s, i in b]
        columns = list(zip(*flat)) if flat else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "query_no", "score", "vec_id"])

    return rows.mapInArrow(search, "query_id bigint, query_no bigint, score bigint, vec_id bigint")


def top_k(vectors: DataFrame, k: int = 5, every: int = EVERY, vec_id: str = "vec_id", embedding: str = "embedding",
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with all other rows.

    Queries are the rows whose id is divisible by `every`. Vectors that are null or hold a null or non-finite
    component, and rows without an id, take no part. An empty vector has score 0 with every row; vectors of unequal length meet
    in their shared dimensions. A row is its id: rows with the query's id are not its candidates. Repeated rows are
    candidates each, and one query. An empty table gives no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), weights(F.col(embedding)).alias("w"))
    rows = materialize(rows.where("vec_id is not null and w is not null"), "topk-rows")
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "w"])
    queries = materialize(queries.select("vec_id", F.xxhash64("vec_id", "w").alias("query_no"), "w"), "topk-queries")
    blocks = max(1, -(-queries.count() // query_block))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        part = _search_block(rows, dealt.where(F.col("block") == block).drop("block"), k)
        part = materialize(part, "topk-part") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query_id", "query_no").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


#: The same in SQL.
SQL = """
with rows as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
  select q.vec_id as query_id, r.vec_id, list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * r.w[i]))::bigint as score
  from rows q join rows r on q.vec_id % 50 = 0 and q.vec_id <> r.vec_id
), ranked as (
  select *, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""
