"""Distribution drift of many columns, periods and groups against one fixed reference.

One job: reference and monitored rows are tagged, put in bins by the reference's quantile edges and
counted. Counting is partial on each task, so the shuffle carries at most
periods × groups × columns × bins rows per task, whatever the size of the data; what follows
works on counts only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import is_numeric, status_band, status_colour
from tidewatch.operators.quantiles import cut_arrays
from tidewatch.operators.ranges import long_values, position_in
from tidewatch.params import EMPTY_SHARE
from tidewatch.runtime import broadcast_counted, materialize

PERIOD = "period"


def comparable_columns(actual: DataFrame, reference: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of both tables that are numeric (or boolean) on both sides, in `actual`'s order."""
    numeric = {f.name for f in reference.schema if is_numeric(f.dataType)}
    return [f.name for f in actual.schema
            if is_numeric(f.dataType) and f.name in numeric and f.name not in exclude]


def reference_edges(reference: DataFrame, columns: Sequence[str], q: int, by: Sequence[str] = (),
                    rows_per_task: int | None = None) -> DataFrame:
    """(by..., feature, n, edges): inner bin edges of the reference. Outer edges are ±infinity."""
    if q < 1:
        raise ValueError("q must be at least 1")
    if q == 1:
        long = long_values(reference, columns, by)
        return materialize(long.groupBy(*by, "feature").agg(
            F.count("value").alias("n"), F.array().cast("array<double>").alias("edges")), "cut-arrays")
    return cut_arrays(reference, columns, q, by=by, rows_per_task=rows_per_task)


def bin_counts(df: DataFrame, columns: Sequence[str], edges: DataFrame, q: int,
               keys: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """(keys..., by..., feature, bin, n): rows per bin, `bin` NULL for missing values.

    Bins are closed on the left; a value on repeated edges falls in the last of them.
    """
    long = long_values(df, columns, [*keys, *by], keep_null=True)
    ends = broadcast_counted(edges.select(*by, "feature", "edges"), F.size("edges") + len(by) + 1)
    placed = position_in(long.join(ends, [*by, "feature"]), "value", "edges", q - 1, "bin")
    bin_no = F.expr("if(value is null, null, bin) as bin")
    return placed.groupBy(*keys, *by, "feature", bin_no).agg(F.expr("count(*) as n"))


def _sides(reference: DataFrame, actual: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Reference and monitored rows in one table, told apart by `is_ref`."""
    return reference.select(
        F.lit(True).alias("is_ref"), F.lit(None).cast("int").alias(PERIOD), *columns,
    ).unionByName(actual.select(
        F.lit(False).alias("is_ref"), F.col(PERIOD).cast("int").alias(PERIOD), *columns))


def side_counts(actual: DataFrame, reference: DataFrame | None, columns: Sequence[str],
                edges: DataFrame, q: int, by: Sequence[str] = (),
                reference_counts: DataFrame | None = None) -> DataFrame:
    """(is_ref, period, by..., feature, bin, n) of both sides, from one pass over the data; stored
    `reference_counts` (by..., feature, bin, n) replace the pass over the reference."""
    keys = ("is_ref", PERIOD)
    if reference_counts is None:
        both = _sides(reference.select(*by, *columns), actual, [*by, *columns])
        return bin_counts(both, columns, edges, q, keys, by)
    counted = bin_counts(actual, columns, edges, q, (PERIOD,), by)
    return _sides(reference_counts, counted, [*by, "feature", "bin", "n"])


def drift_terms(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bin by bin: shares on both sides and their PSI and KL terms.

    (by..., feature, period, bin, ref_share, act_share, psi_term, kl_term, n_ref, n_actual, rows_ref,
    rows_actual). Every period gets every bin that any side fills; bins empty everywhere add nothing.
    """
    key = [*by, "feature"]
    # One small shuffle by (group, column); everything below keeps that partitioning.
    seen = F.collect_set(PERIOD).over(Window.partitionBy(*key))
    per_bin = (
        counts.withColumn("periods", seen)
        .groupBy(*key, "bin").agg(
            F.expr("sum(if(is_ref, n, 0)) as ref_n"),
            F.expr("map_from_entries(collect_list(if(is_ref, null, struct(period, n)))) as act"),
            F.first("periods").alias("periods"))
        .select(*key, "bin", "ref_n", "act", F.explode("periods").alias(PERIOD))
        .withColumn("act_n", F.expr("coalesce(try_element_at(act, period), 0)"))
    )
    whole = Window.partitionBy(*key, PERIOD)
    totals = per_bin.select(
        *key, PERIOD, "bin", "ref_n", "act_n",
        F.sum(F.expr("if(bin is null, 0, ref_n)")).over(whole).alias("n_ref"),
        F.sum(F.expr("if(bin is null, 0, act_n)")).over(whole).alias("n_actual"),
        F.sum("ref_n").over(whole).alias("rows_ref"),
        F.sum("act_n").over(whole).alias("rows_actual"),
    ).where("bin is not null")
    shares = totals.withColumns({
        "ref_share": F.expr(f"if(ref_n > 0, ref_n / n_ref, {EMPTY_SHARE!r}D)"),
        "act_share": F.expr(f"if(act_n > 0, act_n / n_actual, {EMPTY_SHARE!r}D)"),
    })
    return shares.withColumns({
        "psi_term": F.expr("(ref_share - act_share) * ln(ref_share / act_share)"),
        "kl_term": F.expr("ref_share * ln(ref_share / act_share)"),
    })


def drift_values(terms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, period, n_ref, n_actual, rows_ref, rows_actual, psi, kl)."""
    return terms.groupBy(*by, "feature", PERIOD).agg(
        *[F.first(c).alias(c) for c in ("n_ref", "n_actual", "rows_ref", "rows_actual")],
        F.sum("psi_term").alias("psi"), F.sum("kl_term").alias("kl"))


def measure_drift(actual: DataFrame, reference: DataFrame | None, columns: Sequence[str], q: int,
                  by: Sequence[str] = (), edges: DataFrame | None = None,
                  reference_counts: DataFrame | None = None, rows_per_task: int | None = None) -> DataFrame:
    """PSI and KL of each column (and group) of each period against the reference.

    Stored `edges` and `reference_counts` spare the scans of the reference.
    """
    if edges is None:
        edges = reference_edges(reference, columns, q, by, rows_per_task)
    counts = side_counts(actual, reference, columns, edges, q, by, reference_counts)
    return drift_values(drift_terms(counts, by), by)


def data_drift(metric: str, actual: DataFrame, reference: DataFrame, q: int,
               columns: Sequence[str] | None = None, rows_per_task: int | None = None) -> DataFrame:
    """(period, feature, metric_value): unrounded PSI or KL of all common numeric columns, NULL where a side
    has no value."""
    name = metric.lower()
    if name not in ("psi", "kl"):
        raise ValueError(f"unknown drift metric {metric!r}: PSI or KL")
    columns = columns or comparable_columns(actual, reference, exclude=(PERIOD,))
    values = measure_drift(actual, reference, columns, q, rows_per_task=rows_per_task)
    both = (F.col("n_ref") > 0) & (F.col("n_actual") > 0)
    return values.select(PERIOD, "feature", F.when(both, F.col(name)).alias("metric_value"))


def drift_bins(actual: DataFrame, reference: DataFrame, columns: Sequence[str], q: int,
               rows_per_task: int | None = None) -> DataFrame:
    """Bin detail with all q bins: (period, feature, bin, lo, hi, ref_share, act_share, psi_term,
    kl_term). Bins between repeated edges hold nothing; lo and hi are NULL on the open ends."""
    edges = reference_edges(reference, columns, q, rows_per_task=rows_per_task)
    terms = drift_terms(side_counts(actual, reference, columns, edges, q))
    # q rows per column and period, whatever the data hold: filled bins keep theirs, others are added.
    parts = ("ref_share", "act_share", "psi_term", "kl_term")
    filled = terms.groupBy("feature", PERIOD).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", F.struct(*parts)))).alias("filled"))
    grid = filled.join(broadcast_counted(edges, F.size("edges") + 2), "feature").select(
        PERIOD, "feature", "filled", "edges", F.explode(F.sequence(F.lit(0), F.lit(q - 1))).alias("bin"))
    term = F.try_element_at("filled", F.col("bin"))
    empty = {"ref_share": EMPTY_SHARE, "act_share": EMPTY_SHARE, "psi_term": 0.0, "kl_term": 0.0}
    return grid.select(
        PERIOD, "feature", "bin",
        F.get("edges", F.col("bin") - 1).alias("lo"), F.get("edges", F.col("bin")).alias("hi"),
        *[F.coalesce(term[c], F.lit(empty[c])).alias(c) for c in parts])


def psi_report(actual: DataFrame, reference: DataFrame | None, q: int, columns: Sequence[str] | None = None,
               exclude: Sequence[str] = (), min_count: int = 10, edges: DataFrame | None = None,
               reference_counts: DataFrame | None = None, rows_per_task: int | None = None) -> DataFrame:
    """(period, feature, n_ref, n_actual, psi): columns with more than `min_count` values on both
    sides, psi rounded to 5 places. Order it with `sort_report`."""
    columns = columns or comparable_columns(actual, reference, exclude=(PERIOD, *exclude))
    values = measure_drift(actual, reference, columns, q, edges=edges,
                           reference_counts=reference_counts, rows_per_task=rows_per_task)
    enough = (F.col("n_ref") > min_count) & (F.col("n_actual") > min_count)
    return values.where(enough).select(
        PERIOD, "feature", "n_ref", "n_actual", F.bround("psi", 5).alias("psi"))


def sort_report(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("psi"), "feature", PERIOD)


def score_drift(actual: DataFrame, reference: DataFrame, score: str, q: int,
                **kwargs) -> DataFrame:
    """PSI report of the score column; a table without it is an error."""
    for name, df in (("monitored", actual), ("reference", reference)):
        if score not in df.columns:
            raise ValueError(f"score column {score!r} is not in the {name} table")
    return psi_report(actual, reference, q, columns=[score], **kwargs)


def group_drift(actual: DataFrame, reference: DataFrame | None, group: str, columns: Sequence[str], q: int,
                min_rows: int = 10, edges: DataFrame | None = None,
                reference_counts: DataFrame | None = None, rows_per_task: int | None = None) -> DataFrame:
    """(period, group, columna, psi, n_actual): drift inside each score group, bins taken from the
    group's own reference; groups under `min_rows` rows on either side are left out."""
    known = F.col(group).isNotNull()
    shared = [c for c in columns if c in actual.columns]
    if reference is not None:
        shared = [c for c in shared if c in reference.columns]
        reference = reference.where(known)
    values = measure_drift(actual.where(known), reference, shared, q, by=(group,),
                           edges=edges, reference_counts=reference_counts, rows_per_task=rows_per_task)
    enough = (F.col("rows_ref") >= min_rows) & (F.col("rows_actual") >= min_rows)
    return values.where(enough & (F.col("n_ref") > 0) & (F.col("n_actual") > 0)).select(
        PERIOD, group, F.col("feature").alias("columna"), F.bround("psi", 5).alias("psi"),
        F.col("rows_actual").alias("n_actual"))


def mean_psi(report: DataFrame) -> DataFrame:
    """(period, psi_medio): mean of the already rounded values."""
    return report.groupBy(PERIOD).agg(F.avg("psi").alias("psi_medio"))


def with_status(df: DataFrame, psi: str = "psi_medio") -> DataFrame:
    return df.withColumns({"status": status_band(F.col(psi)), "colour": status_colour(F.col(psi))})


def rolling_psi(history: DataFrame, window: int, keys: Sequence[str] = ("stage",),
                value: str = "psi_medio") -> DataFrame:
    """Add `rolling_psi`: mean over the last `window` strictly earlier periods that have a result,
    0 if there is none. Rows are numbered by the results up to them, so a frame of values spans the window."""
    ordered = Window.partitionBy(*keys).orderBy(PERIOD)
    known = F.col(value).isNotNull().cast("int")
    before = F.coalesce(F.sum(known).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A row without a result stands at the number of results before it, one with a result at its own.
    numbered = history.withColumn("_at", before + known).withColumn("_before", before)
    recent = Window.partitionBy(*keys).orderBy("_at").rangeBetween(-window, -1)
    upto = Window.partitionBy(*keys).orderBy("_at").rangeBetween(-window + 1, 0)
    mean = F.when(F.col(value).isNotNull(), F.avg(value).over(recent)).otherwise(F.avg(value).over(upto))
    return numbered.withColumn("rolling_psi", F.coalesce(mean, F.lit(0.0))).drop("_at", "_before")
