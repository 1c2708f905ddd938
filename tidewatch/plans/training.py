"""Training phase: reference build, in-sample drift, candidates, champion, reference scores."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.models import registry as reg
from tidewatch.models.learners import FAMILIES, batch_inference
from tidewatch.models.search import search
from tidewatch.models.training import evaluate, fit_candidates, pick_champion, prepare_sets
from tidewatch.operators import drift as D
from tidewatch.operators.delivery import postprocess
from tidewatch.params import MonitorParams
from tidewatch.plans.monitoring import (
    Profile, StageResult, build_profile, monitor_stage, raw_columns, stage_reports, stage_runs, store_run, summarise,
)
from tidewatch.plans.prepare import prepare, split_sets, typed_raw
from tidewatch.runtime import side_by_side
from tidewatch.sources.writers import write_delivery, write_table


def train_and_promote(spark: SparkSession, prepared: DataFrame, params: MonitorParams, root: str,
                      families=FAMILIES, settings: Mapping[str, dict] | None = None,
                      search_options: dict | None = None) -> DataFrame:
    """Fit the candidates (or search their settings), log the run, store and promote the champion.
    Returns the candidates' metrics."""
    spec = params.spec
    train, test = split_sets(prepared, spec, params.test_share, params.split_seed)
    train, test, features = prepare_sets(train, test, spec.target, keep=[spec.row_id])
    if search_options is None:
        candidates = fit_candidates(train, features, spec.target, spec.row_id, families,
                                    params.model_seed, settings)
    else:
        candidates = search(train, features, spec.target, spec.row_id, families,
                            seed=params.model_seed, **search_options)
    path = f"{root}/candidate_metrics"
    evaluate(candidates, train, test, spec.target).write.mode("overwrite").parquet(path)
    metrics = spark.read.parquet(path)
    winner, row = pick_champion(candidates, metrics, params.max_decay_pct)
    performance = {k: v for k, v in (row or {}).items() if k != "ml_name" and v is not None}
    reg.log_run(spark, f"{root}/model_runs", uuid.uuid4().hex, f"training_{params.model_name}", {
        "model_name": params.model_name, "training_periods": list(params.training_periods),
        "psi_quantiles": params.psi_quantiles, "best_model_type": winner.family if winner else None,
    }, performance)
    if winner is None:
        raise RuntimeError("no candidate is under the decay limit; production keeps its model")
    folder = reg.save_model(spark, winner, performance, f"{root}/models")
    reg.promote(spark, f"{root}/models", params.model_name, folder, row["auc_test"])
    return metrics


def run_training_phase(spark: SparkSession, raw: DataFrame, params: MonitorParams, root: str,
                       run_date: dt.date | None = None, retrain: bool = True, families=FAMILIES,
                       settings: Mapping[str, dict] | None = None,
                       search_options: dict | None = None) -> dict[str, DataFrame]:
    """From raw training periods to a production model and a stored reference.

    `raw` needs row identity, period and target. The first training period is the baseline for raw drift,
    scores and groups; all of them together are the reference for prepared features and later periods.
    """
    spec, q, periods = params.spec, params.psi_quantiles, list(params.training_periods)
    first, later = periods[0], periods[1:]
    raw = raw.where(F.col(spec.period).isin(*periods))
    write_table(typed_raw(raw, spec), f"{root}/reference_raw")
    typed = spark.read.parquet(f"{root}/reference_raw")
    write_table(prepare(raw, spec, with_target=True), f"{root}/reference_pre")
    prepared = spark.read.parquet(f"{root}/reference_pre")
    at_first, after = F.col(spec.period) == first, F.col(spec.period).isin(*later)

    watched = raw_columns(typed, params)

    def watch_raw() -> StageResult:
        return monitor_stage(spark, "raw", lambda: D.psi_report(typed.where(after), typed.where(at_first), q, watched), later)

    def watch_prepared() -> tuple[Profile, list[StageResult]]:
        profile = build_profile(prepared, spec.features, q, root, "pre")
        return profile, stage_reports(spark, params, later, None, prepared, None, None, {"pre": profile})

    # They only share the two tables just written. Training comes after: nothing is promoted without its profiles.
    raw_result, raw_profile, (pre_profile, pre_results) = side_by_side(spark, [
        watch_raw, partial(build_profile, typed, watched, q, root, "raw"), watch_prepared], 3, "training")
    in_sample = [raw_result, *pre_results]
    profiles = {"raw": raw_profile, "pre": pre_profile}

    metrics = None
    if retrain or reg.production_folder(spark, f"{root}/models", params.model_name) is None:
        metrics = train_and_promote(spark, prepared, params, root, families, settings, search_options)
    model = reg.load_production(spark, f"{root}/models", params.model_name)

    held = [spec.row_id, spec.period, *spec.post_columns]
    base = prepared.where(at_first).drop(spec.target)
    batch_inference(model, base, held, params.score_col).write.mode("overwrite").parquet(f"{root}/reference_scores")
    scored = spark.read.parquet(f"{root}/reference_scores")
    postprocess(scored, spec, run_date, params.score_col).write.mode("overwrite").parquet(f"{root}/reference_replica")
    replica = spark.read.parquet(f"{root}/reference_replica")
    grouped = replica.where(F.col(params.group_col).isNotNull())
    _, profiles["score"], profiles["grupo"] = side_by_side(spark, [
        partial(write_delivery, replica, f"{root}/delivery_train"),
        partial(build_profile, scored, [params.score_col], q, root, "score"),
        partial(build_profile, grouped, ["score", params.points_col], q, root, "grupo", by=(params.group_col,)),
    ], 3, "reference")
    reference = stage_reports(spark, params, [first], None, None, scored, replica, profiles)

    now = dt.datetime.now()
    for results, watched_periods in ((in_sample, later), (reference, [first])):
        store_run(spark, root, f"training_{now:%Y%m%d_%H%M%S}", results, watched_periods, now)
    summary = summarise([*in_sample, *reference])
    runs = stage_runs(spark, in_sample, later).unionByName(stage_runs(spark, reference, [first]))
    tables = {"stage_summary": summary, "stage_runs": runs, "delivery": replica}
    for result in (*in_sample, *reference):
        if result.report is not None:
            tables[f"drift_{result.stage}"] = result.report
    if metrics is not None:
        tables["metrics"] = metrics
    return tables
