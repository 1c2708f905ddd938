"""What the corpus operators share: tables, words, free column names, running sums across tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.runtime import ROWS_PER_TASK, materialize

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8; `bytes.split` cuts at exactly the six characters of `WORD`."""
    return (text or "").encode("utf-8", "replace").split()


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and all other characters as they are."""
    return (text or "").encode("utf-8", "replace").lower()


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, lengthened until no column of `df` has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def training_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def chunks_of(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about `limit` bytes of text, at least one row each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = total = 0
        for row, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        yield batch.slice(start)


def running_sums(df: DataFrame, order: Sequence[Column], sums: Sequence[str], label: str, rows: int = 0) -> DataFrame:
    """Add `before_<c>` for each column c of `sums`: its sum over all rows earlier in `order`.

    Rows are range-partitioned and written with their task number; each task then needs only the totals of
    the tasks before it (one row a task), so no task ever holds more than its own range. Rows equal in
    `order` come in any order among themselves. `rows`, where the caller has counted them, raises the tasks to
    one for every `ROWS_PER_TASK` rows.
    """
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))
    laid = materialize(df.repartitionByRange(tasks, *order).withColumn("_task", F.spark_partition_id()), label)
    ahead = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy("_task").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums]).select(
        "_task", *[F.coalesce(F.sum(f"_t_{c}").over(ahead), F.lit(0)).alias(f"_a_{c}") for c in sums])
    inside = Window.partitionBy("_task").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # `totals` has at most one row a task, so its size is bounded by the number of tasks.
    out = laid.join(F.broadcast(totals), "_task").withColumns({
        f"before_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_a_{c}") for c in sums})
    return out.drop("_task", *[f"_a_{c}" for c in sums])
