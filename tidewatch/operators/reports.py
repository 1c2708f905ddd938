"""Tables behind the monitoring report: matrices, time lines, traffic light, alerts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import as_number, status_band, status_text
from tidewatch.operators.drift import rolling_psi
from tidewatch.runtime import broadcast_counted, materialize

# Stages in report order, and the fields of an operational row.
STAGES = ("raw", "pre", "score", "grupo")
OPS_FIELDS = ("duration_s", "ram_proc_mb", "ram_delta_mb", "cpu_pct", "ram_sys_pct", "ram_sys_mb")


def known_values(df: DataFrame, column: str) -> list:
    """Distinct non-null values, sorted: period or stage lists that become report columns."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def psi_matrix(report: DataFrame, periods: Sequence[int], top_n: int) -> DataFrame:
    """(feature, p1, p2, ...): psi by feature and period, missing as 0; the `top_n` features with the
    highest psi in any period."""
    names = {p: f"p{p}" for p in periods}
    wide = report.groupBy("feature").agg(*[
        F.coalesce(F.max(F.when(F.col("period") == p, F.col("psi"))), F.lit(0.0)).alias(name)
        for p, name in names.items()])
    worst = F.greatest(*names.values()) if len(names) > 1 else F.col(*names.values())
    return wide.orderBy(F.desc(worst), "feature").limit(top_n)


def group_matrix(drift: DataFrame, periods: Sequence[int], group: str = "grupo_ejec",
                 column: str = "score") -> DataFrame:
    """(group, p1, p2, ...): psi of the score inside each group, missing as 0."""
    return drift.where(F.col("columna") == column).groupBy(group).agg(*[
        F.coalesce(F.max(F.when(F.col("period") == p, F.col("psi"))), F.lit(0.0)).alias(f"p{p}")
        for p in periods])


def score_density(df: DataFrame, score: str, bins: int = 40, keys: Sequence[str] = ("period",)) -> DataFrame:
    """(period, bin, lo, hi, n, density): equal-width bins over each period's own range, area 1."""
    value = as_number(F.col(score))
    scored = df.select(*keys, value.alias("x")).where("x is not null")
    spans = scored.groupBy(*keys).agg(
        F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.count("x").alias("total"))
    # One value only: a unit-wide range around it.
    flat = F.col("min_x") == F.col("max_x")
    spans = spans.select(
        *keys, "total", F.when(flat, F.col("min_x") - 0.5).otherwise(F.col("min_x")).alias("from_x"),
        F.when(flat, F.col("max_x") + 0.5).otherwise(F.col("max_x")).alias("to_x"))
    spans = materialize(spans.withColumn("width", (F.col("to_x") - F.col("from_x")) / bins), "score-spans")
    place = F.floor((F.col("x") - F.col("from_x")) / (F.col("to_x") - F.col("from_x")) * bins)
    counts = (
        scored.join(broadcast_counted(spans), list(keys))
        .groupBy(*keys, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = spans.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    filled = grid.join(counts, [*keys, "bin"], "left")
    n = F.coalesce("n", F.lit(0))
    return filled.select(
        *keys, "bin", (F.col("from_x") + F.col("bin") * F.col("width")).alias("lo"),
        (F.col("from_x") + (F.col("bin") + 1) * F.col("width")).alias("hi"), n.alias("n"),
        (n / (F.col("total") * F.col("width"))).alias("density"))


def stage_grid(summary: DataFrame, periods: Sequence[int], stages: Sequence[str] = STAGES,
               window: int = 3, rolled_stage: str = "score") -> DataFrame:
    """(stage, period, psi_medio, rolling_psi): every stage and period, missing psi as 0, with the
    moving average of the score stage."""
    spark = summary.sparkSession
    grid = spark.createDataFrame([(s, int(p)) for s in stages for p in periods], "stage string, period int")
    dense = grid.join(summary.select("stage", "period", "psi_medio"), ["stage", "period"], "left")
    rolled = rolling_psi(dense, window)
    return rolled.select(
        "stage", "period", F.coalesce("psi_medio", F.lit(0.0)).alias("psi_medio"),
        F.when(F.col("stage") == rolled_stage, F.col("rolling_psi")).alias("rolling_psi"))


def traffic_light(summary: DataFrame, periods: Sequence[int], stages: Sequence[str] = STAGES) -> DataFrame:
    """(period, raw, pre, score, grupo): `STATUS 0.123` per stage, a dash where there is no result."""
    spark = summary.sparkSession
    grid = spark.createDataFrame([(int(p),) for p in periods], "period int")
    wide = summary.groupBy("period").agg(*[
        F.max(F.when(F.col("stage") == s, F.col("psi_medio"))).alias(s) for s in stages])
    return grid.join(wide, "period", "left").select(
        "period", *[status_text(F.col(s)).alias(s) for s in stages])


def run_summary(summary: DataFrame) -> DataFrame:
    """(stage, period, status, psi_medio) of stages with a result."""
    return summary.where("psi_medio is not null").select(
        "stage", "period", status_band(F.col("psi_medio")).alias("status"), "psi_medio")


def metric_history(summary: DataFrame, run_id: str) -> DataFrame:
    """(run_id, name, value): one metric `psi_{stage}_p{period}` per result."""
    name = F.format_string("psi_%s_p%d", "stage", "period")
    return summary.where("psi_medio is not null").select(
        F.lit(run_id).alias("run_id"), name.alias("name"), F.col("psi_medio").alias("value"))


def ops_timeline(runs: DataFrame, summary: DataFrame) -> DataFrame:
    """One operational row per (stage, period): absent measurements are 0, an absent psi stays NULL."""
    measured = [F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c in runs.columns else F.lit(0.0).alias(c)
                for c in OPS_FIELDS]
    joined = runs.join(summary.select("stage", "period", "psi_medio"), ["stage", "period"], "left")
    return joined.select("stage", "period", *measured, "psi_medio")


def ops_alerts(ops: DataFrame, max_duration_s: float = 30.0, max_ram_delta_mb: float = 200.0,
               max_ram_sys_pct: float = 80.0) -> DataFrame:
    """(kind_no, stage, period, message): slow stages, then memory growth, then system memory; strictly
    above the threshold."""
    # The fields, the alert texts, and their decimal places.
    checks = [
        ("duration_s", max_duration_s, "LENTO  [%s p%d]: %.1fs > umbral %ss", 1),
        ("ram_delta_mb", max_ram_delta_mb, "RAM+   [%s p%d]: +%.0fMB > umbral %sMB", 0),
        ("ram_sys_pct", max_ram_sys_pct, "SYSRAM [%s p%d]: Sistema al %.0f%% RAM > umbral %s%%", 0),
    ]
    entries = []
    for kind, (column, limit, text, places) in enumerate(checks, start=1):
        message = F.format_string(text, F.col("stage"), F.col("period"),
                                  F.bround(F.col(column), places), F.lit(str(limit)))
        entries.append(F.when(F.col(column) > limit,
                              F.struct(F.lit(kind).alias("kind_no"), message.alias("message"))))
    listed = ops.select("stage", "period", F.explode(F.array(*entries)).alias("alert"))
    return listed.where("alert is not null").select("alert.kind_no", "stage", "period", "alert.message")


def first_alerts(alerts: DataFrame, n: int = 4, stages: Sequence[str] = STAGES) -> DataFrame:
    """The first alerts by kind, then in report order of the stages, then by period."""
    place = F.array_position(F.array(*[F.lit(s) for s in stages]), F.col("stage"))
    return alerts.orderBy("kind_no", F.when(place > 0, place).asc_nulls_last(), "stage", "period").limit(n)


def duration_pivot(ops: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """(period, raw, pre, score, grupo, ram_sys_pct): duration by stage (0 if absent) and mean system
    memory."""
    return ops.groupBy("period").agg(
        *[F.coalesce(F.max(F.when(F.col("stage") == s, F.col("duration_s"))), F.lit(0.0)).alias(s)
          for s in stages],
        F.avg("ram_sys_pct").alias("ram_sys_pct"))


def memory_pivot(ops: DataFrame, periods: Sequence[int]) -> DataFrame:
    """(stage, p1, p2, ...): mean memory growth; NULL where a stage did not run."""
    return ops.groupBy("stage").agg(*[
        F.avg(F.when(F.col("period") == p, F.col("ram_delta_mb"))).alias(f"p{p}") for p in periods])


def stage_summary(results: dict[str, DataFrame]) -> DataFrame:
    """(stage, period, psi_medio) of several stages' (period, psi_medio) tables."""
    tagged = [df.select(F.lit(stage).alias("stage"), "period", "psi_medio") for stage, df in results.items()]
    return reduce(DataFrame.unionByName, tagged)


def latest(registry: DataFrame, name: str = "folder", pattern: str = "yyyy-MM-dd_HH-mm-ss") -> DataFrame:
    """The registry row whose folder name parses to the latest time; other names are ignored."""
    stamped = registry.withColumn("_ts", F.try_to_timestamp(F.col(name), F.lit(pattern)))
    return stamped.where("_ts is not null").orderBy(F.desc("_ts"), F.col(name)).limit(1).drop("_ts")
