import datetime as dt
import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import columns as fn
from tidewatch.operators import delivery as DL
from tidewatch.operators import ranking as R
from tidewatch.params import GROUP_CUTS_PER_MILLE, FeatureSpec
from tidewatch.sources import readers, writers

SPEC = FeatureSpec()


def scored(spark, n=700, seed=2):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "row_id": np.arange(n), "period": rng.choice([1, 2], n, p=[0.7, 0.3]), "partition": "202401",
        "key_value": np.where(rng.random(n) < 0.35, 7, rng.integers(0, n // 2, n)), "codunicocli": rng.integers(1, 10**6, n),
        "grp_campecs06m": rng.choice(["G1", "G2", "G3", "G4", "ZZ"], n), "prob_value_contact": rng.random(n),
        "monto": rng.random(n) * 1000, "prob": rng.random(n),
    })
    pdf.loc[::50, "prob_value_contact"] = np.nan
    return pdf, spark.createDataFrame(pdf)


def reference_delivery(pdf):
    """The delivery rules in pandas, one period at a time."""
    out = []
    weights = {"G1": 0.066, "G2": 0.028, "G3": 0.022, "G4": 0.008}
    for _, part in pdf.groupby("period"):
        part = part.copy()
        part["puntuacion"] = (part.prob * part.prob_value_contact.fillna(1e-6) * np.log(part.monto + 1)
                              * part.grp_campecs06m.map(weights).fillna(0.004))
        part["grupo"] = pd.qcut(part.puntuacion, [c / 1000 for c in GROUP_CUTS_PER_MILLE], labels=range(10, 0, -1)).astype(int)
        part = part.sort_values(["puntuacion", "row_id"], ascending=[False, True]).drop_duplicates("key_value")
        part["orden"] = np.arange(1, len(part) + 1)
        out.append(part)
    return pd.concat(out)


@pytest.mark.parametrize("rows", [None, 100])
def test_delivery_equals_pandas(spark, rows):
    pdf, df = scored(spark)
    got = DL.postprocess(df, SPEC, dt.date(2024, 3, 9), rows_per_task=rows).toPandas().sort_values(["period", "orden"])
    want = reference_delivery(pdf).sort_values(["period", "orden"])
    assert list(got.orden) == list(want.orden) and list(got.coddoc) == list(want.key_value)
    assert list(got.grupo_ejec) == list(want.grupo)
    np.testing.assert_allclose(got.puntuacion, want.puntuacion)
    assert set(got.fec_replica) == {"20240309"} and set(got.tipdoc) == {"1"} and set(got.modelo) == {"EC OMNICANAL"}
    assert list(got.columns) == ["period", *DL.DELIVERY_ORDER]


def test_group_sizes_follow_the_fractions(spark):
    df = spark.range(1000).select(F.lit(1).alias("period"), F.col("id").cast("double").alias("s"))
    sizes = {r["g"]: r["count"] for r in R.execution_groups(df, "s", out="g").groupBy("g").count().collect()}
    cuts = GROUP_CUTS_PER_MILLE
    assert all(abs(sizes[10 - i] - (cuts[i + 1] - cuts[i])) <= 1 for i in range(10))


@pytest.mark.parametrize("rows", [None, 100])
def test_equal_cuts_raise_and_null_scores_have_no_group(spark, rows):
    flat = spark.createDataFrame([(1, 5.0)] * 20, "period int, s double")
    with pytest.raises(Exception, match="not unique"):
        R.execution_groups(flat, "s", rows_per_task=rows).collect()
    scores = [(1, float(i)) for i in range(100)] + [(1, None), (1, float("nan"))]
    got = R.execution_groups(spark.createDataFrame(scores, "period int, s double"), "s", rows_per_task=rows)
    assert got.where("grupo_ejec is null").count() == 2


@pytest.mark.parametrize("rows", [None, 100])
def test_rank_is_a_permutation_even_when_one_score_fills_a_third(spark, rows):
    rng = np.random.default_rng(4)
    n = 3000
    pdf = pd.DataFrame({"row_id": rng.permutation(n), "period": rng.choice([1, 2, 3], n),
                        "s": np.where(rng.random(n) < 0.4, 0.5, rng.random(n))})
    df = spark.createDataFrame(pdf).withColumn("s", F.when(F.col("row_id") % 40 != 0, F.col("s")))
    got = R.rank_rows(df, [F.desc_nulls_last("s"), F.asc("row_id")], by=("period",), rows_per_task=rows).toPandas()
    pdf.loc[pdf.row_id % 40 == 0, "s"] = np.nan
    for period, part in pdf.groupby("period"):
        want = part.sort_values(["s", "row_id"], ascending=[False, True], na_position="last").row_id
        mine = got[got.period == period].sort_values("orden")
        assert list(mine.row_id) == list(want) and list(mine.orden) == list(range(1, len(want) + 1))


def test_rank_without_groups_and_with_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "a")], "id int, g string")
    got = R.rank_rows(df, [F.asc("id")], by=("g",), out="n", rows_per_task=100).orderBy("id").collect()
    assert [r["n"] for r in got] == [1, 1, 2, 2]
    got = R.rank_rows(df, [F.desc("id")], out="n", rows_per_task=100).orderBy("id").collect()
    assert [r["n"] for r in got] == [4, 3, 2, 1]


def test_best_per_key_joins_null_keys_and_limits_before_the_shuffle(spark):
    rows = [(None, 1.0, 1), (None, 3.0, 2), (5, None, 3), (5, 2.0, 4), (5, 2.0, 5)]
    df = spark.createDataFrame(rows, "k int, s double, row_id int")
    best = R.best_per_key(df, ["k"], [F.desc_nulls_last("s"), F.asc("row_id")])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(r["row_id"] for r in best.collect()) == [2, 4]


def test_splits_are_stable_and_of_right_size(spark):
    df = spark.range(2000).withColumnRenamed("id", "row_id")
    one = {r["row_id"] for r in R.hash_split(df, "row_id").where("is_test").collect()}
    two = {r["row_id"] for r in R.hash_split(df.repartition(11), "row_id").where("is_test").collect()}
    assert one == two and abs(len(one) - 660) < 80
    whole = {r["row_id"] for r in R.exact_split(df, "row_id").where("is_test").collect()}
    hashes = sorted((r["h"], r["row_id"]) for r in df.withColumn("h", fn.hash_fraction(F.col("row_id"), 123, 13)).collect())
    assert whole == {i for _, i in hashes[:660]}
    for buckets in (1, 7, 1 << 20):
        assert {r["row_id"] for r in R.exact_split(df, "row_id", buckets=buckets).where("is_test").collect()} == whole
    assert R.exact_split(spark.range(10).withColumnRenamed("id", "row_id"), "row_id").where("is_test").count() == 4
    assert R.exact_split(df.where("row_id < 0"), "row_id").count() == 0


def test_exact_split_with_repeated_and_null_keys(spark):
    keys = [None] * 5 + ["a"] * 40 + list("bcdefgh")
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    order = [r["k"] for r in df.withColumn("h", fn.hash_fraction(F.col("k"), 123, 13)).orderBy("h", "k").collect()]
    for share in (0.02, 0.05, 0.33, 0.6, 0.95, 1.0):
        split = R.exact_split(df, "k", share)
        n = math.ceil(share * len(keys))
        assert split.count() == len(keys) and split.select("i").distinct().count() == len(keys)
        assert Counter(r["k"] for r in split.where("is_test").collect()) == Counter(order[:n])


def test_scores_meet_attributes_on_identity(spark):
    post = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "period int, row_id int, x string")
    scores = spark.createDataFrame([(1, 2, 0.7), (1, 9, 0.1)], "period int, row_id int, predictions double")
    got = DL.attach_scores(post, scores, SPEC).orderBy("row_id").collect()
    assert [r["prob"] for r in got] == [None, 0.7]


def test_zero_pad(spark):
    texts = ["7", "-42", "+5", "12345678901", "1234567890", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(fn.zero_pad(F.col("x"), 10)).collect()]
    assert got == [t.zfill(10) if t else None for t in texts]
    numbers = spark.createDataFrame([(12345.0,), (-7.0,)], "x double")
    assert [r[0] for r in numbers.select(fn.zero_pad(F.col("x"), 10)).collect()] == ["0000012345", "-000000007"]


def test_value_score_edges(spark):
    rows = [(0.5, None, 10.0, None), (0.5, 0.2, -1.0, "G1"), (0.5, 0.2, float("nan"), "G1"), (None, 0.2, 3.0, "G2")]
    df = spark.createDataFrame(rows, "p double, c double, m double, g string")
    got = [r[0] for r in df.select(fn.value_score(F.col("p"), F.col("c"), fn.as_number(F.col("m")), F.col("g"))).collect()]
    assert got[0] == pytest.approx(0.5 * 1e-6 * np.log(11) * 0.004)
    assert got[1:] == [None, None, None]


def test_delivery_file_roundtrip(spark, tmp_path):
    _, df = scored(spark, 200)
    replica = DL.postprocess(df, SPEC, dt.date(2024, 3, 9))
    path = writers.write_delivery(replica, str(tmp_path / "delivery"), rows_per_task=40)
    assert len(list((tmp_path / "delivery").rglob("*.csv"))) > replica.select("period").distinct().count()
    lines = [p.read_text().splitlines() for p in sorted((tmp_path / "delivery").rglob("*.csv"))]
    assert all(x[0] == "|".join(DL.DELIVERY_ORDER) for x in lines)
    assert all(x.endswith("|") and '"' not in x for block in lines for x in block[1:])
    back = readers.read_delivery(spark, path)
    assert back.count() == replica.count()
    assert sorted(r["orden"] for r in back.where("period = 2").collect()) == list(range(1, replica.where("period = 2").count() + 1))
