import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import quantiles as Q
from tidewatch.operators import ranges as RG
from tidewatch.runtime import materialize


def frame(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "g": rng.integers(0, 3, n), "x": rng.normal(0, 10, n), "few": rng.integers(0, 4, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 5.0, rng.random(n) * 9), "flat": np.full(n, 2.5),
    })
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("rows", [None, 100])
@pytest.mark.parametrize("q", [2, 10, 1000])
def test_cuts_equal_numpy(spark, rows, q):
    pdf, df = frame(spark)
    columns = ["x", "few", "hot", "flat"]
    got = Q.exact_cuts(df, columns, q, rows_per_task=rows).toPandas()
    for c in columns:
        values = pdf[c].dropna().to_numpy()
        mine = got[got.feature == c].sort_values("cut")
        assert list(mine.cut) == list(range(1, q)) and set(mine.n) == {len(values)}
        np.testing.assert_allclose(mine.edge, np.percentile(values, np.linspace(0, 100, q + 1))[1:-1], atol=1e-9)


@pytest.mark.parametrize("rows", [None, 100])
def test_cuts_by_group_and_chosen_cuts(spark, rows):
    pdf, df = frame(spark)
    cuts = [0, 35, 87, 500, 1000]
    got = Q.exact_cuts(df, ["x"], 1000, cuts, by=["g"], rows_per_task=rows).toPandas()
    for g, part in pdf.groupby("g"):
        mine = got[got.g == g].sort_values("cut")
        assert list(mine.cut) == cuts
        np.testing.assert_allclose(mine.edge, part.x.dropna().quantile([c / 1000 for c in cuts]), atol=1e-9)


@pytest.mark.parametrize("rows", [None, 100])
@pytest.mark.parametrize("values", [[4.0], [4.0, 7.0], [float("-inf"), 1.0, 2.0, float("inf")]])
def test_tiny_inputs(spark, rows, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = Q.exact_cuts(df, ["x"], 4, rows_per_task=rows).orderBy("cut").toPandas()
    assert len(got) == 3
    if np.isfinite(values).all():
        np.testing.assert_allclose(got.edge, np.percentile(values, [25, 50, 75]))


def test_result_does_not_depend_on_partitioning_or_sample(spark, monkeypatch):
    _, df = frame(spark)
    whole = Q.exact_cuts(df, ["x", "hot"], 50, rows_per_task=100).orderBy("feature", "cut").collect()
    monkeypatch.setattr(RG, "SAMPLE_PER_RANGE", 1)
    monkeypatch.setattr(Q, "RANGES_PER_CUT", 1)
    coarse = Q.exact_cuts(df.repartition(7), ["x", "hot"], 50, rows_per_task=400).orderBy("feature", "cut").collect()
    assert whole == coarse


def test_bad_cuts_are_refused(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        Q.exact_cuts(df, ["x"], 10, [11])


def test_position_counts_ends_at_or_below(spark):
    ends = [1.0, 2.0, 2.0, 5.0]
    values = [0.0, 1.0, 1.5, 2.0, 4.9, 5.0, 99.0, None]
    df = spark.createDataFrame([(v, ends) for v in values], "value double, ends array<double>")
    got = [r["p"] for r in RG.position_in(df, "value", "ends", len(ends), "p").collect()]
    assert got == [0, 1, 1, 3, 3, 4, 4, 0]
    assert RG.position_in(df, "value", "ends", 0, "p").where(F.col("p") != 0).count() == 0


def test_null_and_unseen_keys_spread_over_ranges(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.lit(1)).alias("g"), F.lit("x").alias("feature"),
                                    F.rand(3).alias("value"))
    written = materialize(df, "ranged")
    plan, most = RG.plan_ranges(written, ["g"], 400)
    assert most == 50 and plan.count() == 2
    sample = RG.sample_for_ranges(written, plan, ["g"])
    for held in (sample, sample.where("g = 1")):  # without rows of a key, the ends of all keys serve
        placed = RG.add_range(written, held, plan, ["g"], most)
        assert placed.groupBy("g", "range_no").count().agg(F.max("count")).first()[0] < 4 * 400
    got = Q.exact_cuts(df.withColumnRenamed("value", "x").drop("feature"), ["x"], 4, by=["g"], rows_per_task=1000)
    want = {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("value", [0.25, 0.5, 0.75]).alias("p")).collect()}
    for g, edges in want.items():
        mine = [r["edge"] for r in got.where(F.col("g").eqNullSafe(F.lit(g))).orderBy("cut").collect()]
        assert np.allclose(mine, edges)


def test_a_key_with_half_the_table_among_thousands(spark):
    """Each key is sampled at its own rate, so no window sees more than a key's own ranges ask for."""
    rows = spark.range(120_000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 3001).alias("g"),
                                       F.rand(5).alias("x"))
    written = materialize(rows, "hot")
    plan, most = RG.plan_ranges(written, ["g"], 1000)
    assert [(r["g"], r["rows"], r["ranges"]) for r in plan.collect()] == [(-1, 60_000, 60)]
    sample = RG.sample_for_ranges(written, plan, ["g"])
    assert sample.count() < 2 * RG.SAMPLE_PER_RANGE * 60
    placed = RG.add_range(RG.long_values(written, ["x"], ["g"]), RG.long_values(sample, ["x"], ["g", "ranges"]), plan, ["g"], most)
    assert placed.groupBy("g", "range_no").count().agg(F.max("count")).first()[0] < 3 * 1000
    got = {(r["g"], r["cut"]): r["edge"] for r in Q.exact_cuts(rows, ["x"], 4, by=["g"], rows_per_task=1000).collect()}
    want = rows.groupBy("g").agg(F.percentile("x", [0.25, 0.5, 0.75]).alias("p")).collect()
    assert len(got) == 3 * len(want)
    assert all(np.isclose(got[(r["g"], k + 1)], r["p"][k]) for r in want for k in range(3))
