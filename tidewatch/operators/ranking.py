"""Ordered operators of the delivery step: execution groups, best row per key, dense ranks, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import as_number, hash_fraction
from tidewatch.operators.quantiles import cut_arrays
from tidewatch.params import GROUP_CUTS_PER_MILLE
from tidewatch.runtime import broadcast_counted, materialize, tasks_for, written_columns


def execution_groups(df: DataFrame, score: str, out: str = "grupo_ejec", by: Sequence[str] = ("period",),
                     cuts: Sequence[int] = GROUP_CUTS_PER_MILLE, parts: int = 1000,
                     rows_per_task: int | None = None) -> DataFrame:
    """Uneven quantile groups of each period's own scores: the highest label holds the lowest scores.

    Groups are closed on the right; NULL scores get no group; equal cut values are an error, as they
    would leave a group empty.
    """
    edges = cut_arrays(df, [score], parts, cuts, by, rows_per_task)
    clash = F.raise_error(F.lit(f"quantile cuts of {score} are not unique"))
    checked = F.when(F.size(F.array_distinct("edges")) == len(cuts), F.col("edges")).otherwise(
        clash.cast("array<double>"))
    held = {c: f"_cut_{c}" for c in by}
    edges = broadcast_counted(edges, F.size("edges") + len(held)).select(
        *[F.col(c).alias(name) for c, name in held.items()], checked.alias("_cuts"))
    match = F.lit(True)
    for c, name in held.items():  # a NULL period is a period too
        match = match & F.col(c).eqNullSafe(F.col(name))
    label = F.lit(len(cuts) - 1)
    for i in range(1, len(cuts) - 1):
        label = label - (F.col(score) > F.get("_cuts", F.lit(i))).cast("int")
    joined = df.join(edges, match, "left")
    number = as_number(F.col(score))
    return joined.withColumn(out, F.when(number.isNotNull(), label)).drop("_cuts", *held.values())


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order; NULL keys form one key.

    Spark keeps one row per key on each task before the shuffle (window group limit), so a key that
    fills a third of the table is one row per task afterwards.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def rank_rows(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), out: str = "orden",
              rows_per_task: int | None = None) -> DataFrame:
    """Add the place 1..N of each row within `by`. `order` must end in a unique column.

    The rows are written once and counted, which gives the number of tasks. One range shuffle on (by, order) spreads a period, and equal scores, over all tasks.
    Each row's slot in its task is written down once; adding the number of rows in earlier tasks
    gives its place. No task ever holds a whole period.
    """
    written = written_columns(df, df.columns, "rank-input")
    tasks = tasks_for(written, rows_per_task)
    slots = materialize(
        written.repartitionByRange(tasks, *by, *order).sortWithinPartitions(*by, *order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_task", F.shiftrightunsigned("_slot", 33)),
        "ranked-slots")
    runs = slots.groupBy(*by, "_task").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(runs.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_task").alias("_run_task"), "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")), "ranked-runs")
    match = F.col("_task") == F.col("_run_task")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    place = (F.col("_before") + F.col("_slot") - F.col("_first") + 1).cast("int")
    return slots.join(broadcast_counted(runs), match).select(*df.columns, place.alias(out))


def hash_split(df: DataFrame, key: str, test_share: float = 0.33, seed: int = 123,
               out: str = "is_test") -> DataFrame:
    """Mark about `test_share` of the keys as test rows, the same ones in every run."""
    bucket = hash_fraction(F.col(key), seed) % 10000
    return df.withColumn(out, bucket < round(test_share * 10000))


#: Buckets of the key's hash in `exact_split`; only the one that holds the cut is put in order.
SPLIT_BUCKETS = 1 << 16


def exact_split(df: DataFrame, key: str, test_share: float = 0.33, seed: int = 123,
                out: str = "is_test", buckets: int = SPLIT_BUCKETS) -> DataFrame:
    """Mark exactly ceil(test_share · n) rows as test: the ones with the smallest key hashes, ties by key.

    Only the cut matters: rows are counted by bucket of their hash, the bucket in which the count is reached is
    counted by (hash, key), and all rows are compared with the cut found there. NULL keys come first.
    """
    digest = F.coalesce(hash_fraction(F.col(key), seed, digits=13), F.lit(-1))
    bucket = F.floor(digest / float(1 << 52) * buckets)
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("n").over(Window.partitionBy())
    # At most one row a bucket.
    counts = counts.select("bucket", "n", upto.alias("upto"), F.ceil(F.lit(test_share) * whole).alias("wanted"))
    held = counts.where("upto >= wanted").orderBy("bucket").first()
    if held is None or held["wanted"] == 0:
        return df.withColumn(out, F.lit(False))
    inside = df.where(bucket == held["bucket"]).groupBy(digest.alias("digest"), F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("digest", "key").rowsBetween(Window.unboundedPreceding, 0))
    need = held["wanted"] - (held["upto"] - held["n"])
    cut = inside.withColumn("upto", upto).where(F.col("upto") >= need).orderBy("digest", "key").first()
    same = F.col(key).eqNullSafe(F.lit(cut["key"]).cast(df.schema[key].dataType)) & (digest == cut["digest"])
    # NULL compares as unknown, and has the hash that is first.
    below = F.coalesce((digest < cut["digest"]) | ((digest == cut["digest"]) & (F.col(key) < F.lit(cut["key"]))), F.lit(False))
    spare = cut["upto"] - need
    if spare == 0:
        return df.withColumn(out, below | same)
    # Rows with one key several times, of which only some fit: any of them will do.
    some = df.where(same).withColumn(out, F.row_number().over(Window.orderBy(F.lit(0))) <= cut["n"] - spare)
    return df.where(~same).withColumn(out, below).unionByName(some)
