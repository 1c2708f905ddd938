"""Cutting a column into value ranges, so that ordered work runs on many tasks.

Rows are counted by key first, and each key gets ranges by its own rows. Range ends come from quantiles of a sample that is
stratified by key. They only decide which task sees a row: every row is counted, so results do not depend on the sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.runtime import ROWS_PER_TASK, broadcast_counted, materialize

# Sampled rows per range and key: enough that no range is many times the mean.
SAMPLE_PER_RANGE = 32
SAMPLE_SEED = 17


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                keep_null: bool = False) -> DataFrame:
    """(by..., feature, value): one row per row and column, values as double, NaN as NULL."""
    plain = [f"`{c}`" for c in by]
    numbers = [f"if(isnan(double(`{c}`)), null, double(`{c}`))" for c in columns]
    if len(columns) == 1:
        out = df.selectExpr(*plain, f"'{columns[0]}' as feature", f"{numbers[0]} as value")
    else:
        wide = df.selectExpr(*plain, *[f"{n} as `{c}`" for n, c in zip(numbers, columns)])
        out = wide.unpivot(list(by), list(columns), "feature", "value")
    return out if keep_null else out.where("value is not null")


def position_in(df: DataFrame, value: str, ends: str, size: int, out: str) -> DataFrame:
    """How many of the `size` sorted numbers in array column `ends` are ≤ `value`.

    A binary search written as a chain of projections: about log2(size) compiled comparisons per
    row, with no join on ranges.
    """
    df = df.withColumn(out, F.lit(0))
    step = 1 << (size.bit_length() - 1) if size else 0
    while step:
        df = df.withColumn(out, F.expr(
            f"{out} + if(get({ends}, {out} + {step - 1}) <= {value}, {step}, 0)"))
        step //= 2
    return df


def plan_ranges(written: DataFrame, by: Sequence[str], rows_per_task: int | None = None,
                least: int = 1) -> tuple[DataFrame, int]:
    """(by..., rows, ranges) of every key of a written table with more rows than one task takes, and the highest
    number of ranges: one for each task's worth of the key's own rows, `least` at the least. All other keys are
    one range each and need no cut."""
    one_task = rows_per_task or ROWS_PER_TASK
    sizes = written.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > one_task)
    sizes = materialize(sizes.withColumn("ranges", F.greatest(
        F.ceil(F.col("rows") / one_task), F.lit(least)).cast("int")), "range-plan")
    return sizes, sizes.agg(F.max("ranges")).first()[0] or 1


def sample_for_ranges(written: DataFrame, plan: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a written table for choosing range ends only, with the `ranges` of their key. Every key is drawn
    at its own rate, about `SAMPLE_PER_RANGE` rows for each of its ranges, however large it is next to others."""
    names = {c: f"_plan_{c}" for c in by}
    match = F.lit(True)
    for c, other in names.items():
        match = match & F.col(c).eqNullSafe(F.col(other))
    met = written.join(broadcast_counted(plan.withColumnsRenamed(names)), match) if by else written.crossJoin(F.broadcast(plan))
    drawn = F.rand(SAMPLE_SEED) * F.col("rows") < SAMPLE_PER_RANGE * F.col("ranges")
    return met.where(drawn).drop("rows", *names.values())


def range_ends(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., ends): ascending cut values per key, one fewer than its ranges at the most, from a long sample.

    A key's sample grows with its own number of ranges only, so ordering it is a small task.
    """
    ordered = Window.partitionBy(*keys).orderBy("value")
    step = F.ceil(F.count(F.lit(1)).over(Window.partitionBy(*keys)) / F.col("ranges"))
    picked = long.select(*keys, "value", F.row_number().over(ordered).alias("place"), step.alias("step"))
    ends = F.sort_array(F.collect_list("value")).alias("ends")
    return materialize(
        picked.where(F.col("place") % F.col("step") == 0).groupBy(*keys).agg(ends), "range-ends")


def _meet(df: DataFrame, ends: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add the ends of each row's key as column `name`; NULL is a key like any other."""
    names = {c: f"_{name}_{c}" for c in keys}
    match = F.lit(True)
    for c, other in names.items():
        match = match & F.col(c).eqNullSafe(F.col(other))
    ends = broadcast_counted(ends.withColumnsRenamed({**names, "ends": name}), F.size(name) + len(names))
    return df.join(ends, match, "left").drop(*names.values())


def add_range(long: DataFrame, sample: DataFrame, plan: DataFrame, by: Sequence[str], most: int) -> DataFrame:
    """Add `range_no` by ends from a long sample; rows of keys outside `plan` are range 0. A planned key whose
    sample holds no value of a column is cut by the ends of all keys of that column together."""
    own = _meet(long, range_ends(sample, [*by, "feature"]), [*by, "feature"], "_own")
    pooled = sample.withColumn("ranges", F.lit(most))
    joined = _meet(own, range_ends(pooled, ["feature"]), ["feature"], "_pooled")
    if by:
        joined = _meet(joined, plan.select(*by, F.array("ranges").alias("ends")), by, "_planned")
    else:
        joined = joined.withColumn("_planned", F.array(F.lit(most)))
    ends = F.when(F.col("_planned").isNotNull(), F.coalesce("_own", "_pooled"))
    joined = joined.withColumn("ends", ends).drop("_own", "_pooled", "_planned")
    return position_in(joined, "value", "ends", most, "range_no").drop("ends")
