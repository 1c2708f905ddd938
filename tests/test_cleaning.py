import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import cleaning as C
from tidewatch.params import DEFAULT_SPEC, FeatureSpec
from tidewatch.plans.prepare import prepare, split_sets, typed_raw, with_row_id

SPEC = FeatureSpec(numeric=("a", "b"), category="cat", allowed=("X",))


def raw(spark):
    rows = [
        (1, 1, "1.5", "", "X", "202401", "k1", "c1", "G1", "0.5", "10", 1),
        (2, 1, "null", "2", "Y", "202401", "k2", "c2", None, None, "20", 0),
        (3, 1, "None", "0.1", None, "202401", "k3", "c3", "G9", "", "30", 0),
    ]
    return spark.createDataFrame(
        rows, "row_id int, period int, a string, b string, cat string, partition string, key_value string, "
              "codunicocli string, grp_campecs06m string, prob_value_contact string, monto string, target int")


def test_contract_has_sixty_columns():
    assert len(DEFAULT_SPEC.numeric) == 58 and len(set(DEFAULT_SPEC.features)) == 60
    assert DEFAULT_SPEC.features[-2:] == ("ent_1erlntcrallsfm01_INTERBANK", "ent_1erlntcrallsfm01_OTRO")


def test_clean_features(spark):
    rows = C.project_features(C.clean_features(raw(spark), SPEC), SPEC, with_target=True).orderBy("row_id").collect()
    assert rows[0].asDict() == {"row_id": 1, "period": 1, "target": 1, "a": 1.5, "b": -9999999.0, "cat_X": True, "cat_OTRO": False}
    assert (rows[1]["a"], rows[1]["b"], rows[1]["cat_OTRO"]) == (-9999999.0, 2.0, True)
    assert rows[2]["b"] == pytest.approx(np.float32(0.1)) and rows[2]["cat_OTRO"]


def test_text_that_is_no_number_raises_unless_lenient(spark):
    bad = raw(spark).withColumn("a", F.lit("abc"))
    with pytest.raises(Exception):
        C.clean_features(bad, SPEC).collect()
    assert {r["a"] for r in C.clean_features(bad, SPEC, lenient=True).collect()} == {-9999999.0}


def test_one_hot_null_and_unseen_values(spark):
    df = spark.createDataFrame([(1, "X"), (2, None), (3, "new")], "id int, cat string")
    forced = C.one_hot(df, "cat", ["X", "gone"]).orderBy("id").collect()
    assert [(r["cat_X"], r["cat_gone"]) for r in forced] == [(True, False), (False, False), (False, False)]
    assert C.one_hot(df, "cat").columns == ["id", "cat_X", "cat_new"]
    with pytest.raises(ValueError, match="more than 1"):
        C.category_values(df, "cat", most=1)
    with pytest.raises(ValueError):
        C.one_hot(df, "cat", most=1)


def test_normalise_and_align(spark):
    df = spark.createDataFrame([(True, 3, 1.00005, "s")], "flag boolean, i int, d double, s string").withColumn("f", F.lit(0.1).cast("float"))
    out = C.normalise_types(df)
    assert [t for _, t in out.dtypes] == ["int", "bigint", "double", "string", "double"]
    row = out.first()
    assert (row["flag"], row["i"], row["f"]) == (1, 3, 0.1)
    aligned = C.align_columns(df, ["i", "missing", "d"], keep=["s"])
    assert aligned.columns == ["s", "i", "missing", "d"] and aligned.first()["missing"] == 0
    assert C.split_target(df, "i") == ("i", ["flag", "d", "s", "f"]) and C.split_target(df)[0] == "flag"


def test_prepare_keeps_identity_and_needs_no_join(spark):
    df = prepare(raw(spark), SPEC, with_target=True)
    assert df.columns == ["row_id", "period", "target", *SPEC.features, *SPEC.post_columns]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    with pytest.raises(ValueError, match="monto"):
        prepare(raw(spark), FeatureSpec(numeric=("a", "monto"), category="cat", allowed=("X",)))


def test_typed_raw_fills_nothing(spark):
    rows = typed_raw(raw(spark), SPEC).orderBy("row_id").collect()
    assert [r["a"] for r in rows] == [1.5, None, None] and [r["monto"] for r in rows] == [10.0, 20.0, 30.0]
    assert rows[2]["prob_value_contact"] is None


def test_row_id_from_key_or_position(spark):
    spec = FeatureSpec(row_id="rid")
    assert [r["rid"] for r in with_row_id(raw(spark), spec, "key_value").collect()] == ["k1", "k2", "k3"]
    numbered = with_row_id(raw(spark), spec)
    assert numbered.select("rid").distinct().count() == 3 and numbered.inputFiles()


def test_split_sets_cover_all_rows_once(spark):
    big = spark.range(400).select(F.col("id").alias("row_id"), F.lit(1).alias("target"), *[
        F.lit(0.0).alias(c) for c in SPEC.features])
    for exact in (False, True):
        train, test = split_sets(big, SPEC, exact=exact)
        ids = [r["row_id"] for r in train.union(test).collect()]
        assert len(ids) == 400 == len(set(ids))
    assert test.count() == 132
