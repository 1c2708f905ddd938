"""Exact, linearly interpolated quantiles of many columns and groups in one job.

Positions are whole-number arithmetic: for cut i of q on n values the quantile lies between the
sorted values k and k+1, with k = i·(n-1) div q and weight (i·(n-1) mod q) / q on the upper one.
No value can move across a cut through floating-point error in the position.

The wanted columns are written once, and their rows counted by key. Value ranges, as many as a key's rows ask for, are
counted first, and only ranges that hold a wanted position are pulled and ordered, each on its own task; a key with
rows for one task is one range. Equal values are merged before the shuffle, so a value that fills a third of the
table is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.ranges import add_range, long_values, plan_ranges, sample_for_ranges
from tidewatch.runtime import broadcast_counted, materialize, tasks_for, written_columns

# Ranges per cut, where there is more than one range: fewer rows lie in a range that must be pulled.
RANGES_PER_CUT = 16


def _is_run(cuts: Sequence[int]) -> bool:
    return cuts[-1] - cuts[0] + 1 == len(cuts)


def _covered_cuts(df: DataFrame, parts: int) -> DataFrame:
    """Add `cut_from`, `cut_to`: the cuts whose lower or upper neighbour lies at a position in
    [first, first + copies). Nothing is covered where cut_from > cut_to."""
    return df.withColumns({
        "cut_from": F.expr(f"""
            (greatest(first - 1, 0) * {parts} + greatest(n - 1, 1) - 1) div greatest(n - 1, 1)"""),
        "cut_to": F.expr(f"""
            if(n = 1, {parts}L, least({parts}L,
               ((first + copies) * {parts} + greatest(n - 1, 1) - 1) div greatest(n - 1, 1) - 1))"""),
    })


def _interpolate(counted: DataFrame, keys: Sequence[str], cuts: Sequence[int], parts: int) -> DataFrame:
    """From (keys..., value, first, copies, n) to (keys..., n, cut, edge)."""
    covered = _covered_cuts(counted, parts).where("cut_to >= cut_from")
    hits = covered.select(*keys, "n", "value", "first", "copies",
                          F.explode(F.sequence("cut_from", "cut_to")).alias("cut"))
    asked = F.col("cut").between(cuts[0], cuts[-1]) if _is_run(cuts) else F.col("cut").isin(list(cuts))
    hits = hits.where(asked)
    hits = hits.withColumn("k", F.expr(f"(cut * (n - 1)) div {parts}"))
    edges = hits.groupBy(*keys, "n", "cut").agg(
        F.expr("max(if(k between first and first + copies - 1, value, null)) as lo"),
        F.expr("max(if(k + 1 between first and first + copies - 1, value, null)) as hi"))
    edges = edges.withColumn("weight", F.expr(f"double((cut * (n - 1)) % {parts}) / {parts}D"))
    return edges.select(*keys, "n", "cut", F.expr(
        "if(weight = 0 or lo = hi, lo, lo + (hi - lo) * weight) as edge"))


def _count_values(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., value, copies, first): `first` is the position of the first copy within its keys."""
    before = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return (
        long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("first", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    )


def _wanted_ranges(placed: DataFrame, keys: Sequence[str], parts: int, cuts: Sequence[int]) -> DataFrame:
    """(keys..., range_no, offset, n): ranges that hold a wanted position, and the number of
    values before them."""
    counts = placed.groupBy(*keys, "range_no").agg(F.count(F.lit(1)).alias("copies"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({
        "first": F.coalesce(F.sum("copies").over(before), F.lit(0)),
        "n": F.sum("copies").over(whole),
    })
    covered = _covered_cuts(counts, parts).where("cut_to >= cut_from")
    if _is_run(cuts):
        held = (F.col("cut_to") >= cuts[0]) & (F.col("cut_from") <= cuts[-1])
    else:
        wanted = F.array(*[F.lit(int(c)).cast("bigint") for c in cuts])
        held = F.exists(wanted, lambda c: c.between(F.col("cut_from"), F.col("cut_to")))
    return covered.where(held).select(*keys, "range_no", F.col("first").alias("offset"), "n")


def _pull(placed: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the wanted ranges, with offset and n.

    Keys are compared null-safely: a plain equality would make the optimizer copy the whole search for
    the range number into a not-null filter.
    """
    names = {c: f"_wanted_{c}" for c in (*keys, "range_no")}
    match = F.lit(True)
    for c, wanted_c in names.items():
        match = match & F.col(c).eqNullSafe(F.col(wanted_c))
    return placed.join(broadcast_counted(wanted.withColumnsRenamed(names)), match).drop(*names.values())


def exact_cuts(df: DataFrame, columns: Sequence[str], parts: int, cuts: Sequence[int] | None = None,
               by: Sequence[str] = (), rows_per_task: int | None = None) -> DataFrame:
    """(by..., feature, n, cut, edge): for each cut i the i/parts quantile of each column.

    `cuts` defaults to the inner ones, 1 … parts-1.
    """
    cuts = sorted(set(cuts if cuts is not None else range(1, parts)))
    if not cuts or cuts[0] < 0 or cuts[-1] > parts:
        raise ValueError(f"cuts must lie within 0 and {parts}")
    keys = [*by, "feature"]
    written = written_columns(df, [*by, *[c for c in columns if c not in by]], "cut-input")
    long = long_values(written, columns, by)
    if tasks_for(written, rows_per_task) == 1:
        counted = _count_values(long, keys).withColumn("n", F.sum("copies").over(Window.partitionBy(*keys)))
        return _interpolate(counted, keys, cuts, parts)

    plan, most = plan_ranges(written, by, rows_per_task, RANGES_PER_CUT * len(cuts))
    placed = long.withColumn("range_no", F.lit(0))
    if most > 1:
        sample = long_values(sample_for_ranges(written, plan, by), columns, [*by, "ranges"])
        placed = add_range(long, sample, plan, by, most)
    wanted = materialize(_wanted_ranges(placed, keys, parts, cuts), "wanted-ranges")
    counted = _count_values(_pull(placed, wanted, keys), [*keys, "range_no", "offset", "n"])
    counted = counted.withColumn("first", F.col("first") + F.col("offset"))
    return _interpolate(counted, keys, cuts, parts)


def cut_arrays(df: DataFrame, columns: Sequence[str], parts: int, cuts: Sequence[int] | None = None,
               by: Sequence[str] = (), rows_per_task: int | None = None) -> DataFrame:
    """(by..., feature, n, edges): the cuts of each key as one ascending array, written down: it is used once per
    scan, and its size is then known to whoever wants to broadcast it."""
    rows = exact_cuts(df, columns, parts, cuts, by, rows_per_task)
    ordered = F.sort_array(F.collect_list(F.struct("cut", "edge")))
    arrays = rows.groupBy(*by, "feature", "n").agg(F.transform(ordered, lambda e: e["edge"]).alias("edges"))
    return materialize(arrays, "cut-arrays")
