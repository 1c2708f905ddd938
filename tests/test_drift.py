import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift as D
from tidewatch.plans.monitoring import monitor_stage, summarise


def expected(ref, act, q):
    """PSI, KL and shares straight from the definition."""
    edges = np.percentile(ref, np.linspace(0, 100, q + 1))
    inner = edges[1:-1]
    shares = []
    for x in (ref, act):
        counts = np.bincount(np.searchsorted(inner, x, side="right"), minlength=q)
        share = counts / len(x)
        shares.append(np.where(share == 0, 1e-6, share))
    r, a = shares
    return ((r - a) * np.log(r / a)).sum(), (r * np.log(r / a)).sum(), r, a


def sample(seed=5, n=900):
    rng = np.random.default_rng(seed)
    ref = pd.DataFrame({"x": rng.normal(0, 1, n), "k": rng.integers(0, 5, n), "flag": rng.random(n) < 0.3,
                        "flat": np.ones(n)})
    act = pd.concat([
        pd.DataFrame({"period": p, "x": rng.normal(p / 10, 1 + p / 20, m), "k": rng.integers(0, 4 + p, m),
                      "flag": rng.random(m) < 0.3 + p / 20, "flat": np.ones(m)})
        for p, m in ((1, 400), (2, 250))], ignore_index=True)
    return ref, act


@pytest.mark.parametrize("rows", [None, 100])
@pytest.mark.parametrize("q", [1, 10, 1000])
def test_psi_and_kl_equal_definition(spark, q, rows):
    ref, act = sample()
    columns = ["x", "k", "flag", "flat"]
    got = D.measure_drift(spark.createDataFrame(act), spark.createDataFrame(ref), columns, q, rows_per_task=rows).toPandas()
    assert len(got) == 2 * len(columns)
    for row in got.itertuples():
        side = act[act.period == row.period][row.feature].astype(float).to_numpy()
        psi, kl, *_ = expected(ref[row.feature].astype(float).to_numpy(), side, q)
        assert row.n_ref == len(ref) and row.n_actual == len(side)
        assert row.psi == pytest.approx(psi, abs=1e-9) and row.kl == pytest.approx(kl, abs=1e-9)


def test_bin_detail_is_dense_and_sums_to_one(spark):
    ref, act = sample()
    got = D.drift_bins(spark.createDataFrame(act), spark.createDataFrame(ref), ["x", "k"], 10).toPandas()
    assert len(got) == 2 * 2 * 10
    for (period, feature), part in got.groupby(["period", "feature"]):
        part = part.sort_values("bin")
        psi, _, r, a = expected(ref[feature].to_numpy(float), act[act.period == period][feature].to_numpy(float), 10)
        np.testing.assert_allclose(part.ref_share, r)
        np.testing.assert_allclose(part.act_share, a)
        assert part.psi_term.sum() == pytest.approx(psi)
        assert part.ref_share[part.ref_share > 1e-6].sum() == pytest.approx(1)
    first = got[got.bin == 0]
    assert first.lo.isna().all() and got[got.bin == 9].hi.isna().all()


def test_same_data_has_no_drift_and_repartition_changes_nothing(spark):
    ref, act = sample()
    r = spark.createDataFrame(ref)
    same = D.psi_report(r.withColumn("period", F.lit(1)), r, 1000).collect()
    assert len(same) == 4 and all(row["psi"] == 0 for row in same)
    a = spark.createDataFrame(act)
    one = {(x["period"], x["feature"]): x["psi"] for x in D.psi_report(a, r, 10).collect()}
    two = {(x["period"], x["feature"]): x["psi"] for x in D.psi_report(a.repartition(9), r.repartition(3), 10).collect()}
    assert one == two


def test_report_needs_more_than_ten_values_on_both_sides(spark):
    rows = [(1, float(i), float(i) if i < 10 else None, float(i) if i < 11 else None, None) for i in range(30)]
    actual = spark.createDataFrame(rows, "period int, full double, ten double, eleven double, none double")
    reference = spark.createDataFrame([r[1:] for r in rows], "full double, ten double, eleven double, none double")
    found = {r["feature"]: (r["n_ref"], r["n_actual"]) for r in D.psi_report(actual, reference, 4).collect()}
    assert found == {"full": (30, 30), "eleven": (11, 11)}


def test_nan_counts_as_missing_and_infinity_falls_in_outer_bins(spark):
    reference = spark.createDataFrame([(float(i),) for i in range(20)], "x double")
    values = [float("nan"), None, float("inf"), float("-inf"), *map(float, range(20))]
    actual = spark.createDataFrame([(1, v) for v in values], "period int, x double")
    row = D.measure_drift(actual, reference, ["x"], 4).first()
    assert (row["rows_actual"], row["n_actual"]) == (24, 22)
    bins = D.drift_bins(actual, reference, ["x"], 4).orderBy("bin").collect()
    assert [round(b["act_share"] * 22) for b in bins] == [6, 5, 5, 6]


def test_columns_are_chosen_by_type_on_both_sides(spark):
    actual = spark.createDataFrame([(1, 1, "a", True, 2.0)], "period int, a int, b string, c boolean, only double")
    reference = spark.createDataFrame([(1.0, 3, False)], "a double, b int, c boolean")
    assert D.comparable_columns(actual, reference, exclude=("period",)) == ["a", "c"]
    assert D.comparable_columns(actual, reference, exclude=("period", "a")) == ["c"]


def test_group_drift_uses_each_groups_own_bins_and_row_limit(spark):
    rng = np.random.default_rng(1)
    ref = pd.DataFrame({"grupo_ejec": np.repeat([1, 2, 3], [40, 10, 9]), "score": rng.random(59), "puntuacion": rng.random(59)})
    act = pd.DataFrame({"grupo_ejec": np.repeat([1, 2, 3, 4], [30, 9, 50, 30]), "score": rng.random(119), "puntuacion": rng.random(119)})
    act["period"] = 7
    act.loc[act.index[:5], "score"] = np.nan
    got = D.group_drift(spark.createDataFrame(act), spark.createDataFrame(ref), "grupo_ejec", ["score", "puntuacion", "other"], 5).toPandas()
    assert sorted(zip(got.grupo_ejec, got.columna, got.n_actual)) == [(1, "puntuacion", 30), (1, "score", 30)]
    for row in got.itertuples():
        psi, *_ = expected(ref[ref.grupo_ejec == 1][row.columna].to_numpy(), act[act.grupo_ejec == 1][row.columna].dropna().to_numpy(), 5)
        assert row.psi == pytest.approx(psi, abs=1e-5)


def test_stored_profile_gives_the_same_result(spark):
    ref, act = sample()
    r, a = spark.createDataFrame(ref), spark.createDataFrame(act)
    columns = ["x", "k"]
    edges = D.reference_edges(r, columns, 10)
    counts = D.bin_counts(r, columns, edges, 10)
    direct = sorted(D.psi_report(a, r, 10, columns).collect())
    assert sorted(D.psi_report(a, None, 10, columns, edges=edges, reference_counts=counts).collect()) == direct


def test_score_column_must_exist(spark):
    df = spark.createDataFrame([(1, 1.0)], "period int, x double")
    with pytest.raises(ValueError, match="predictions"):
        D.score_drift(df, df, "predictions", 10)
    with pytest.raises(ValueError):
        D.data_drift("JS", df, df, 10)


def test_failed_stage_is_kept_without_result_and_empty_groups_count_zero(spark):
    def broken():
        raise ValueError("no file")

    empty = spark.createDataFrame([], "period int, grupo_ejec int, columna string, psi double, n_actual bigint")
    failed = monitor_stage(spark, "raw", broken, [5, 6])
    results = [failed, monitor_stage(spark, "grupo", lambda: empty, [5]), monitor_stage(spark, "score", lambda: empty, [5])]
    assert "no file" in failed.error
    rows = {(r["stage"], r["period"]): (r["psi_medio"], r["status"]) for r in summarise(results).collect()}
    assert rows == {("raw", 5): (None, None), ("raw", 6): (None, None), ("grupo", 5): (0.0, "OK"), ("score", 5): (None, None)}
    with pytest.raises(ValueError):
        monitor_stage(spark, "unknown", broken, [1])


def test_rolling_mean_skips_missing_and_later_periods(spark):
    rows = [("score", 1, 0.1), ("score", 2, None), ("score", 3, 0.3), ("score", 5, 0.5), ("score", 9, 0.9), ("raw", 2, 0.7)]
    df = spark.createDataFrame(rows, "stage string, period int, psi_medio double")
    got = {(r["stage"], r["period"]): round(r["rolling_psi"], 6) for r in D.rolling_psi(df, 2).collect()}
    assert got == {("score", 1): 0, ("score", 2): 0.1, ("score", 3): 0.1, ("score", 5): 0.2, ("score", 9): 0.4, ("raw", 2): 0}


def test_status_limits(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.0999, 0.1, 0.2499, 0.25, None)], "psi_medio double")
    assert [r["status"] for r in D.with_status(df).collect()] == ["OK", "OK", "WARN", "WARN", "ALARM", None]


def test_a_side_without_values_has_no_drift(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    act = spark.createDataFrame([(1, None)] * 50 + [(2, 3.0)] * 50, "period int, x double")
    got = {r["period"]: r["metric_value"] for r in D.data_drift("KL", act, ref, 10, ["x"]).collect()}
    assert got[1] is None and got[2] > 0
