import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidewatch.catalog import fixtures as fx
from tidewatch.catalog import queries as Q
from tidewatch.models import registry as reg
from tidewatch.models.learners import predict
from tidewatch.models.search import SPACES, draw_settings, real, search, whole
from tidewatch.models.training import Candidate, evaluate, fit_candidates, pick_champion
from tidewatch import runtime
from tidewatch.plans import monitoring, training
from tidewatch.plans.monitoring import run_monitoring_phase
from tidewatch.plans.training import run_training_phase
from tidewatch.runtime import materialize

SMALL_SETTINGS = {"gbt": {"maxIter": 8, "maxDepth": 3}, "forest": {"numTrees": 8, "maxDepth": 4},
                  "logistic": {"maxIter": 20}}


@pytest.fixture(scope="module")
def sets(spark, sf):
    return Q._sets(spark, sf)


def test_candidates_champion_and_registry(spark, sets, tmp_path):
    train, test, features = sets
    fitted = fit_candidates(train, features, "target", "row_id", settings=SMALL_SETTINGS)
    metrics = evaluate(fitted, train, test, "target")
    rows = {r["ml_name"]: r for r in metrics.collect()}
    assert set(rows) == {"gbt", "forest", "logistic"} and all(0.5 < r["auc_train"] <= 1 for r in rows.values())
    winner, row = pick_champion(fitted, metrics, max_decay=100)
    assert row["auc_test"] == max(r["auc_test"] for r in rows.values())
    assert pick_champion(fitted, metrics, max_decay=-1000) == (None, None)

    root = str(tmp_path / "models")
    assert reg.load_latest(spark, root) == (None, None)
    for day in (1, 2):
        folder = reg.save_model(spark, winner, row, root, dt.datetime(2024, 1, day))
        assert reg.promote(spark, root, "m", folder, row["auc_test"]) == day
    with pytest.raises(Exception):
        reg.save_model(spark, winner, row, root, dt.datetime(2024, 1, 2))
    with pytest.raises(ValueError):
        reg.promote(spark, root, "m", None, None)
    assert reg.production_folder(spark, root, "m") == folder == "2024-01-02_00-00-00"
    model, metadata = reg.load_latest(spark, root)
    assert metadata["ml_name"] == winner.family and metadata["performance"]["auc_test"] == row["auc_test"]
    before = {r["row_id"]: r["predictions"] for r in predict(winner.model, test).collect()}
    after = {r["row_id"]: r["predictions"] for r in predict(model, test).collect()}
    assert before == after and all(0 <= p <= 1 for p in after.values())


def test_search_draws_are_repeatable_and_in_range(spark, sets):
    assert draw_settings(SPACES["gbt"], 15) == draw_settings(SPACES["gbt"], 15)
    for settings in draw_settings(SPACES["forest"], 15):
        assert 100 <= settings["numTrees"] < 500 and 3 <= settings["maxDepth"] < 10
        assert 0.7 <= float(settings["featureSubsetStrategy"]) <= 1.0
    train, _, features = sets
    space = {"logistic": {"maxIter": whole(3, 6), "regParam": real(0.0, 0.1)}}
    one, two = (search(train, features, "target", "row_id", ["logistic"], space, n_iter=2)[0] for _ in range(2))
    assert one.settings == two.settings and one.best_auc_cv == pytest.approx(two.best_auc_cv)


def test_training_then_monitoring(spark, sf, tmp_path):
    raw = materialize(Q.raw_with_target(spark, sf), "raw")
    root = str(tmp_path / "engine")
    params = replace(fx.PARAMS, monitoring_periods=(5, 6, 99))
    with pytest.raises(FileNotFoundError, match="raw"):
        run_monitoring_phase(spark, raw, params, root)
    trained = run_training_phase(spark, raw, params, root, dt.date(2024, 1, 31), families=["logistic"],
                                 settings=SMALL_SETTINGS)
    got = {(r["stage"], r["period"]): r["psi_medio"] for r in trained["stage_summary"].collect()}
    assert set(got) == {(s, p) for s in ("raw", "pre") for p in (2, 3, 4)} | {("score", 1), ("grupo", 1)}
    assert got["score", 1] == 0 and got["grupo", 1] == 0 and all(v is not None for v in got.values())

    tables = run_monitoring_phase(spark, raw.drop("target"), params, root, dt.date(2024, 1, 31))
    rows = {(r["stage"], r["period"]): r for r in tables["stage_summary"].collect()}
    assert len(rows) == 12 and rows["raw", 5]["psi_medio"] > 0
    assert rows["raw", 99]["psi_medio"] is None and rows["raw", 99]["status"] is None
    assert tables["traffic_light"].count() == 3 and tables["stage_grid"].count() == 12
    assert tables["psi_matrix_pre"].columns == ["feature", "p5", "p6", "p99"]
    assert tables["delivery"].select("period").distinct().count() == 2
    history = spark.read.parquet(f"{root}/metric_history").where("run_id like 'monitoring%'")
    assert history.where("ts is not null").count() == len([r for r in rows.values() if r["psi_medio"] is not None])
    records = spark.read.parquet(f"{root}/stage_records").where("run_id like 'monitoring%'").collect()
    assert len(records) == 12 and all(r["ts"] and r["duration_s"] > 0 for r in records)
    assert all((r["values_compared"] > 0) == (r["period"] != 99) for r in records if r["stage"] != "grupo")
    assert spark.read.parquet(f"{root}/drift_raw").select("run_id").distinct().count() == 2
    again = run_training_phase(spark, raw, params, root, dt.date(2024, 1, 31), retrain=False)
    assert "metrics" not in again and reg.registry(spark, f"{root}/models").count() == 1


def test_phases_run_independent_parts_side_by_side(spark, sf, tmp_path, monkeypatch):
    """Parts that need nothing of each other are handed over together, and their results come back in the order of stages."""
    asked, own = [], runtime.side_by_side

    def noted(spark, calls, threads, label):
        asked.append((label, len(calls)))
        return own(spark, calls, threads, label)

    for phase in (training, monitoring):
        monkeypatch.setattr(phase, "side_by_side", noted)
    raw, root = materialize(Q.raw_with_target(spark, sf), "raw"), str(tmp_path / "engine")
    training.run_training_phase(spark, raw, fx.PARAMS, root, dt.date(2024, 1, 31), families=["logistic"], settings=SMALL_SETTINGS)
    assert ("training", 3) in asked and ("reference", 3) in asked
    tables = monitoring.run_monitoring_phase(spark, raw.drop("target"), fx.PARAMS, root, dt.date(2024, 1, 31))
    assert ("monitoring", 2) in asked and ("delivery", 2) in asked
    assert [r["stage"] for r in tables["stage_runs"].collect()] == [s for s in ("raw", "pre", "score", "grupo") for _ in (5, 6)]


def test_no_champion_leaves_production_alone(spark, sf, tmp_path):
    raw = materialize(Q.raw_with_target(spark, sf), "raw")
    params = replace(fx.PARAMS, max_decay_pct=-1000.0)
    with pytest.raises(RuntimeError, match="production keeps"):
        run_training_phase(spark, raw, params, str(tmp_path / "e"), families=["logistic"], settings=SMALL_SETTINGS)
    assert reg.production_folder(spark, str(tmp_path / "e/models"), params.model_name) is None
    assert isinstance(Candidate("logistic", None, 0.0, {}).settings, dict)


def test_periods_are_one_job_and_independent(spark, sf):
    """A period's result does not change when other periods are monitored with it."""
    base = fx.base(spark, sf)
    reference = fx.periods(base, fx.REFERENCE_PERIODS)
    from tidewatch.operators.drift import psi_report

    both = {(r["period"], r["feature"]): r["psi"] for r in psi_report(fx.periods(base, (5, 6)), reference, 10, fx.NUMERIC).collect()}
    alone = psi_report(base.where(F.col("period") == 5), reference, 10, fx.NUMERIC).collect()
    assert {k: v for k, v in both.items() if k[0] == 5} == {(r["period"], r["feature"]): r["psi"] for r in alone}
