"""Monitoring of any number of periods against the stored reference: one job per stage."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.models.learners import batch_inference
from tidewatch.models.registry import load_production
from tidewatch.operators import drift as D
from tidewatch.operators import reports as R
from tidewatch.operators.delivery import postprocess
from tidewatch.params import MonitorParams
from tidewatch.plans.prepare import prepare, typed_raw
from tidewatch.runtime import materialize, side_by_side
from tidewatch.sources.readers import load_reference
from tidewatch.sources.writers import PERIODS, write_delivery, write_table

REPORT_STAGES = {"raw": "raw", "pre": "preprocessed", "score": "score", "grupo": "grupo_ejec"}


@dataclass
class Profile:
    """What monitoring needs of the reference: edges and bin counts, a few thousand rows per column."""

    edges: DataFrame
    counts: DataFrame


@dataclass
class StageResult:
    stage: str
    report: DataFrame | None
    summary: DataFrame
    seconds: float
    error: str | None = None


def build_profile(reference: DataFrame, columns: Sequence[str], q: int, root: str, stage: str,
                  by: Sequence[str] = ()) -> Profile:
    """Compute and store the reference's edges and bin counts, so later runs do not scan it again."""
    spark = reference.sparkSession
    edges_path, counts_path = f"{root}/edges_{stage}", f"{root}/counts_{stage}"
    D.reference_edges(reference, columns, q, by).write.mode("overwrite").parquet(edges_path)
    edges = spark.read.parquet(edges_path)
    D.bin_counts(reference, columns, edges, q, by=by).write.mode("overwrite").parquet(counts_path)
    return Profile(edges, spark.read.parquet(counts_path))


def load_profile(spark: SparkSession, root: str, stage: str) -> Profile:
    try:
        return Profile(spark.read.parquet(f"{root}/edges_{stage}"), spark.read.parquet(f"{root}/counts_{stage}"))
    except AnalysisException as error:
        raise FileNotFoundError(
            f"reference profile {stage!r} not found in {root}; run the training phase first") from error


def monitor_stage(spark: SparkSession, stage: str, report: Callable[[], DataFrame],
                  periods: Sequence[int]) -> StageResult:
    """Run one stage for all periods. A failing stage keeps its rows, with a NULL psi, and does not stop
    the others. A group stage without any measurable group counts as 0."""
    if stage not in REPORT_STAGES:
        raise ValueError(f"unknown stage {stage!r}: {', '.join(REPORT_STAGES)}")
    expected = spark.createDataFrame([(int(p),) for p in periods], "period int")
    began = time.monotonic()
    try:
        table, error = materialize(report(), f"drift-{stage}"), None
        means = expected.join(D.mean_psi(table), "period", "left")
        if stage == "grupo":
            means = means.fillna(0.0, subset=["psi_medio"])
    except Exception as failure:  # noqa: BLE001 - any failure of a stage is recorded, not raised
        table, error = None, f"{type(failure).__name__}: {failure}"
        means = expected.withColumn("psi_medio", F.lit(None).cast("double"))
    summary = means.select(F.lit(stage).alias("stage"), "period", "psi_medio")
    return StageResult(stage, table, summary, round(time.monotonic() - began, 2), error)


def monitor_stages(spark: SparkSession, reports: dict[str, Callable[[], DataFrame]],
                   periods: Sequence[int]) -> list[StageResult]:
    """All stages side by side, results in their order. Each records its own failure, so none stops another."""
    calls = [partial(monitor_stage, spark, stage, report, periods) for stage, report in reports.items()]
    return side_by_side(spark, calls, len(REPORT_STAGES), "stages")


def stage_runs(spark: SparkSession, results: Sequence[StageResult], periods: Sequence[int]) -> DataFrame:
    """Operational rows: a stage's wall time, shared by the periods it handled together. Host readings
    belong to single machines and stay NULL."""
    rows = [(r.stage, int(p), r.seconds, r.error) for r in results for p in periods]
    df = spark.createDataFrame(rows, "stage string, period int, duration_s double, error string")
    return df.withColumns({c: F.lit(None).cast("double") for c in R.OPS_FIELDS if c != "duration_s"})


def stage_records(spark: SparkSession, results: Sequence[StageResult], periods: Sequence[int]) -> DataFrame:
    """`stage_runs` with what came of each stage: psi_medio, the rows of its report and the values they
    compare (0 where a stage failed)."""
    records = stage_runs(spark, results, periods).join(
        R.stage_summary({r.stage: r.summary for r in results}), ["stage", "period"], "left")
    counted = [r.report.groupBy("period").agg(F.count(F.lit(1)).alias("report_rows"),
                                              F.sum("n_actual").alias("values_compared"))
               .withColumn("stage", F.lit(r.stage)) for r in results if r.report is not None]
    if not counted:
        zero = F.lit(0).cast("long")
        return records.withColumns({"report_rows": zero, "values_compared": zero})
    sizes = reduce(DataFrame.unionByName, counted)
    return records.join(sizes, ["stage", "period"], "left").fillna(0, ["report_rows", "values_compared"])


def store_run(spark: SparkSession, root: str, run_id: str, results: Sequence[StageResult],
              periods: Sequence[int], at: dt.datetime | None = None) -> None:
    """Append a run's stage records, drift reports and metric history to the tables in `root`, each row
    with the run's name and time. Reports of a stage go to `drift_{stage}`."""
    mark = {"run_id": F.lit(run_id), "ts": F.lit(at or dt.datetime.now())}

    def append(df: DataFrame, name: str) -> None:
        df.withColumns(mark).write.mode("append").parquet(f"{root}/{name}")

    append(stage_records(spark, results, periods).coalesce(1), "stage_records")
    append(R.metric_history(R.stage_summary({r.stage: r.summary for r in results}), run_id).coalesce(1),
           "metric_history")
    for result in results:
        if result.report is not None:
            append(result.report, f"drift_{result.stage}")


def stage_reports(spark: SparkSession, params: MonitorParams, periods: Sequence[int], raw: DataFrame | None,
                  prepared: DataFrame | None, scores: DataFrame | None, replica: DataFrame | None,
                  profiles: dict[str, Profile]) -> list[StageResult]:
    """The stages whose tables are given, against stored reference profiles."""
    q, spec = params.psi_quantiles, params.spec

    def against(stage: str, actual: DataFrame, columns: Sequence[str]) -> Callable[[], DataFrame]:
        profile = profiles[stage]
        return lambda: D.psi_report(actual.where(F.col("period").isin(*periods)), None, q, columns,
                                    edges=profile.edges, reference_counts=profile.counts)

    reports = {}
    if raw is not None:
        reports["raw"] = against("raw", raw, raw_columns(raw, params))
    if prepared is not None:
        reports["pre"] = against("pre", prepared, list(spec.features))
    if scores is not None:
        reports["score"] = against("score", scores, [params.score_col])
    if replica is not None:
        profile = profiles["grupo"]
        reports["grupo"] = lambda: D.group_drift(
            replica.where(F.col("period").isin(*periods)), None, params.group_col,
            ["score", params.points_col], q, edges=profile.edges, reference_counts=profile.counts)
    return monitor_stages(spark, reports, periods)


def raw_columns(raw: DataFrame, params: MonitorParams, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric raw columns under drift watch: all but our own row identity, the period and the target."""
    spec = params.spec
    held = {spec.row_id, spec.period, spec.target, *exclude}
    return [c for c in D.comparable_columns(raw, raw) if c not in held]


def summarise(results: Sequence[StageResult]) -> DataFrame:
    return D.with_status(R.stage_summary({r.stage: r.summary.select("period", "psi_medio") for r in results}))


def run_monitoring_phase(spark: SparkSession, raw: DataFrame, params: MonitorParams, root: str,
                         run_date: dt.date | None = None) -> dict[str, DataFrame]:
    """Prepare, score, deliver and watch all monitored periods at once. Returns the report tables.

    Prepared rows, scores and deliveries of the monitored periods replace those of earlier runs; other periods stay.
    `raw` needs row identity and period; `root` holds what the training phase stored, and takes the run's
    stage records, drift reports and metric history.
    """
    spec, periods = params.spec, list(params.monitoring_periods)
    load_reference(spark, root)
    profiles = {stage: load_profile(spark, root, stage) for stage in REPORT_STAGES}
    model = load_production(spark, f"{root}/models", params.model_name)
    if model is None:
        raise FileNotFoundError(f"no production model {params.model_name!r} in {root}; run the training phase first")

    raw = raw.where(F.col(spec.period).isin(*periods))
    typed = typed_raw(raw, spec)
    monitored = F.col(spec.period).isin(*periods)
    write_table(prepare(raw, spec), f"{root}/prepared_oot", replace=PERIODS)
    prepared = spark.read.parquet(f"{root}/prepared_oot").where(monitored)
    held = [spec.row_id, spec.period, *spec.post_columns]

    def score() -> tuple[DataFrame, DataFrame]:
        write_table(batch_inference(model, prepared, held, params.score_col), f"{root}/scored_oot", replace=PERIODS)
        scored = spark.read.parquet(f"{root}/scored_oot").where(monitored)
        return scored, materialize(postprocess(scored, spec, run_date, params.score_col), "replica")

    # The drift of raw and prepared rows needs no scores, and that of scores no delivery: they run side by side.
    features, (scored, replica) = side_by_side(spark, [
        partial(stage_reports, spark, params, periods, typed, prepared, None, None, profiles), score], 2, "monitoring")
    scores, _ = side_by_side(spark, [
        partial(stage_reports, spark, params, periods, None, None, scored, replica, profiles),
        partial(write_delivery, replica, f"{root}/delivery_oot")], 2, "delivery")
    results = [*features, *scores]
    summary = materialize(summarise(results), "stage-summary")
    by_stage = {r.stage: r.report for r in results}
    runs = stage_runs(spark, results, periods)
    timeline = R.ops_timeline(runs, summary)
    tables = {
        "stage_summary": summary,
        "stage_runs": runs,
        "stage_grid": R.stage_grid(summary, periods, window=params.moving_avg_window),
        "traffic_light": R.traffic_light(summary, periods),
        "run_summary": R.run_summary(summary),
        "score_density": R.score_density(scored, params.score_col),
        "ops_timeline": timeline,
        "ops_alerts": R.ops_alerts(timeline, params.alert_duration_s, params.alert_ram_delta_mb,
                                   params.alert_ram_sys_pct),
        "delivery": replica,
    }
    for stage in ("raw", "pre", "score"):
        if by_stage.get(stage) is not None:
            tables[f"drift_{stage}"] = by_stage[stage]
            tables[f"psi_matrix_{stage}"] = R.psi_matrix(by_stage[stage], periods, params.top_n_vars)
    if by_stage.get("grupo") is not None:
        tables["drift_grupo"] = by_stage["grupo"]
        tables["group_matrix"] = R.group_matrix(by_stage["grupo"], periods, params.group_col)
    now = dt.datetime.now()
    store_run(spark, root, f"monitoring_{now:%Y%m%d_%H%M%S}", results, periods, now)
    return tables
