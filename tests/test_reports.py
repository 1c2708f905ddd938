import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import reports as R


def summary(spark):
    rows = [("raw", 11, 0.05), ("raw", 12, 0.2), ("pre", 11, None), ("score", 11, 0.3), ("grupo", 12, 0.0)]
    return spark.createDataFrame(rows, "stage string, period int, psi_medio double")


def test_psi_matrix_orders_by_worst_period(spark):
    rows = [(11, "a", 0.1), (12, "a", 0.2), (11, "b", 0.5), (12, "c", 0.2), (11, "d", 0.01)]
    df = spark.createDataFrame(rows, "period int, feature string, psi double")
    assert [tuple(r) for r in R.psi_matrix(df, [11, 12], 3).collect()] == [("b", 0.5, 0.0), ("a", 0.1, 0.2), ("c", 0.0, 0.2)]
    assert R.psi_matrix(df, [11], 1).collect()[0]["feature"] == "b"


def test_group_matrix_takes_scores_only(spark):
    rows = [(11, 1, "score", 0.1), (11, 1, "puntuacion", 9.0), (12, 2, "score", 0.2)]
    df = spark.createDataFrame(rows, "period int, grupo_ejec int, columna string, psi double")
    assert sorted(tuple(r) for r in R.group_matrix(df, [11, 12]).collect()) == [(1, 0.1, 0.0), (2, 0.0, 0.2)]


def test_density_equals_numpy(spark):
    rng = np.random.default_rng(8)
    values = {1: rng.random(300), 2: np.full(5, 0.5)}
    df = spark.createDataFrame([(p, float(v)) for p, x in values.items() for v in x], "period int, s double")
    got = R.score_density(df, "s").toPandas()
    for p, x in values.items():
        part = got[got.period == p].sort_values("bin")
        density, edges = np.histogram(x, bins=40, density=True)
        np.testing.assert_allclose(part.density, density)
        np.testing.assert_allclose(part.lo, edges[:-1])


def test_density_of_a_large_input_keeps_its_result(spark, monkeypatch):
    df = spark.createDataFrame([(p, float(i % 17)) for p in (1, 2) for i in range(100)], "period int, s double")
    small = sorted(R.score_density(df, "s", 10).collect())
    monkeypatch.setattr("tidewatch.runtime.BROADCAST_BYTES", 0)
    assert sorted(R.score_density(df, "s", 10).collect()) == small


def test_grid_light_summary_history(spark):
    s = summary(spark)
    grid = {(r["stage"], r["period"]): (r["psi_medio"], r["rolling_psi"]) for r in R.stage_grid(s, [11, 12]).collect()}
    assert len(grid) == 8 and grid["pre", 11] == (0.0, None) and grid["score", 12] == (0.0, 0.3)
    light = {r["period"]: r.asDict() for r in R.traffic_light(s, [11, 12, 13]).collect()}
    assert light[11] == {"period": 11, "raw": "OK 0.050", "pre": "—", "score": "ALARM 0.300", "grupo": "—"}
    assert light[13]["raw"] == "—" and light[12]["raw"] == "WARN 0.200"
    assert R.run_summary(s).count() == 4
    names = {r["name"]: r["value"] for r in R.metric_history(s, "r").collect()}
    assert names == {"psi_raw_p11": 0.05, "psi_raw_p12": 0.2, "psi_score_p11": 0.3, "psi_grupo_p12": 0.0}


def test_timeline_and_alerts(spark):
    runs = spark.createDataFrame(
        [("raw", 11, 31.0, 200.0, 80.1), ("pre", 11, 30.0, 250.4, 80.0), ("raw", 12, None, 201.0, 95.0)],
        "stage string, period int, duration_s double, ram_delta_mb double, ram_sys_pct double")
    timeline = R.ops_timeline(runs, summary(spark))
    rows = {(r["stage"], r["period"]): r for r in timeline.collect()}
    assert rows["raw", 12]["duration_s"] == 0.0 and rows["raw", 11]["cpu_pct"] == 0.0 and rows["pre", 11]["psi_medio"] is None
    alerts = R.ops_alerts(timeline).orderBy("kind_no", "stage", "period").collect()
    assert [r["message"] for r in alerts] == [
        "LENTO  [raw p11]: 31.0s > umbral 30.0s", "RAM+   [pre p11]: +250MB > umbral 200.0MB",
        "RAM+   [raw p12]: +201MB > umbral 200.0MB", "SYSRAM [raw p11]: Sistema al 80% RAM > umbral 80.0%",
        "SYSRAM [raw p12]: Sistema al 95% RAM > umbral 80.0%"]
    assert R.first_alerts(R.ops_alerts(timeline, 0, 0, 0)).count() == 4
    pivot = {r["period"]: r for r in R.duration_pivot(timeline).collect()}
    assert pivot[11]["raw"] == 31.0 and pivot[11]["score"] == 0.0 and pivot[11]["ram_sys_pct"] == pytest.approx(80.05)
    memory = {r["stage"]: r for r in R.memory_pivot(timeline, [11, 12]).collect()}
    assert memory["pre"]["p12"] is None and memory["raw"]["p12"] == 201.0


def test_latest_ignores_other_names(spark):
    names = ["2024-01-02_03-04-05", "2024-01-02_03-04-06", "notes", "2023-12-31_23-59-59", "99-99"]
    df = spark.createDataFrame([(n,) for n in names], "folder string")
    assert [r["folder"] for r in R.latest(df).collect()] == ["2024-01-02_03-04-06"]
    assert R.latest(df.where(F.col("folder") == "notes")).count() == 0
    assert R.known_values(df.withColumn("x", F.length("folder")), "x") == [5, 19]


def test_first_alerts_follow_the_order_of_stages(spark):
    rows = [(1, s, 1, "m") for s in ("grupo", "score", "pre", "raw")] + [(1, "raw", 2, "m"), (2, "raw", 1, "m")]
    alerts = spark.createDataFrame(rows, "kind_no int, stage string, period int, message string")
    got = [(r["stage"], r["period"]) for r in R.first_alerts(alerts).collect()]
    assert got == [("raw", 1), ("raw", 2), ("pre", 1), ("score", 1)]
