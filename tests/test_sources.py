import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import runtime
from tidewatch.models import registry
from tidewatch.runtime import broadcast_counted, materialize, shared_folder, tasks_for
from tidewatch.sources import readers, writers


def write(folder, name, text):
    (folder / name).write_text(text)


def test_periods_meet_by_name(spark, tmp_path):
    write(tmp_path, "p1_extrac.csv", "a,b\n1,x\n2,\n")
    write(tmp_path, "p2_extrac.csv", "b,a,c\ny,3,null\n")
    df = readers.read_raw(spark, str(tmp_path), [1, 2])
    rows = sorted((r["period"], r["a"], r["b"], r["c"]) for r in df.fillna("-").collect())
    assert rows == [(1, "1", "x", "-"), (1, "2", "-", "-"), (2, "3", "y", "null")]
    with pytest.raises(Exception):
        readers.read_raw(spark, str(tmp_path), [3]).collect()
    with pytest.raises(ValueError):
        readers.read_periods(spark, str(tmp_path), [])
    with pytest.raises(ValueError):
        readers.read_raw(spark, str(tmp_path), [1], fmt="xls")


def test_folder_scan_takes_period_from_name_and_meets_headers_by_name(spark, tmp_path):
    write(tmp_path, "p3_extrac.csv", "a,b\n1,x\n")
    write(tmp_path, "p14_extrac.csv", "a,b\n2,y\n")
    write(tmp_path, "notes.txt", "z\n")
    rows = sorted((r["period"], r["a"]) for r in readers.read_folder(spark, str(tmp_path)).collect())
    assert rows == [(3, "1"), (14, "2")]

    write(tmp_path, "p15_extrac.csv", "b,a\nq,9\n")
    write(tmp_path, "p16_extrac.csv", "c,a\n7,8\n")
    write(tmp_path, "p18_extrac.csv", "")
    parts = tmp_path / "p17_extrac.csv"
    parts.mkdir()
    write(parts, "part-0.csv", "a,b\n5,s\n")
    write(parts, "part-1.csv", "a,b\n6,t\n")
    df = readers.read_folder(spark, str(tmp_path))
    rows = sorted((r["period"], r["a"], r["b"], r["c"]) for r in df.fillna("-").collect())
    assert rows == [(3, "1", "x", "-"), (14, "2", "y", "-"), (15, "9", "q", "-"), (16, "8", "-", "7"),
                    (17, "5", "s", "-"), (17, "6", "t", "-")]
    typed = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.IntegerType())])
    df = readers.read_folder(spark, str(tmp_path), schema=typed)
    assert df.columns == ["b", "a", "period"] and df.agg(F.sum("a"), F.count("b")).first()[:] == (31, 5)

    write(parts, "part-2.csv", "b,a\nu,7\n")  # parts of one file must agree
    with pytest.raises(Exception):
        readers.read_folder(spark, str(tmp_path)).collect()
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_folder(spark, str(tmp_path / "empty")).collect()


def test_model_and_period_from_path(spark):
    df = spark.createDataFrame([("/d/p1_x/p12_extrac.csv",)], "path string")
    row = df.select(readers.period_from_path(F.col("path")), readers.model_from_path(F.col("path"))).first()
    assert tuple(row) == (12, "extrac")


def test_parquet_folder_merges_schemas_and_prunes_periods(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "period int, x string"), path)
    writers.write_table(spark.createDataFrame([(3, "c", 5)], "period int, x string, y int"), path, mode="append")
    df = readers.read_raw(spark, path, [2, 3], fmt="parquet")
    assert sorted((r["period"], r["x"], r["y"]) for r in df.fillna(0).collect()) == [(2, "b", 0), (3, "c", 5)]
    assert "PartitionFilters: [period" in df._jdf.queryExecution().executedPlan().toString()


def test_reference_parts_are_named_when_missing(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    writers.save_reference({"raw": df, "pre": df, "scores": df}, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="replica"):
        readers.load_reference(spark, str(tmp_path))
    writers.save_reference({"replica": df}, str(tmp_path))
    assert set(readers.load_reference(spark, str(tmp_path))) == set(readers.REFERENCE_PARTS)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) in (spark.conf.get("spark.checkpoint.dir"), spark.sparkContext.getCheckpointDir())


def test_counted_rows_decide_tasks_and_broadcast(spark, monkeypatch):
    """A small file may hold many rows: what counts is the rows and values, not the bytes."""
    flat = materialize(spark.range(2_000_000).selectExpr("1 as x"), "flat")
    assert tasks_for(flat) == 2 and tasks_for(materialize(spark.range(10), "few")) == 1 and tasks_for(flat, 500_000) == 4
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 1_000_000)
    assert broadcast_counted(flat) is flat
    wide = materialize(spark.range(10).selectExpr("id", "sequence(1, 100000) as ends"), "wide")
    assert broadcast_counted(wide, F.size("ends") + 1) is wide and broadcast_counted(wide.select("id")) is not wide


def test_overwriting_a_period_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "scores")

    def put(rows, **options):
        writers.write_table(spark.createDataFrame(rows, "period int, x string"), path, **options)

    put([(5, "a"), (6, "b")], replace=writers.PERIODS)
    put([(6, "c"), (6, "d"), (7, "e")], replace=writers.PERIODS)
    assert sorted((r["period"], r["x"]) for r in spark.read.parquet(path).collect()) == [(5, "a"), (6, "c"), (6, "d"), (7, "e")]
    put([(8, "f")])
    assert [r["period"] for r in spark.read.parquet(path).collect()] == [8]


def test_quarantine_names_files_and_rows(spark, tmp_path):
    write(tmp_path, "p1_extrac.csv", "a,b\n1,x\n2\n3,y,z\n4,w\n")
    write(tmp_path, "p2_extrac.csv", "b,a,_record\nq,notanumber,k\nr,9,k\n")
    write(tmp_path, "p3_extrac.csv", "\n")
    write(tmp_path, "p4_extrac.csv", "")
    rows, rejected = readers.read_folder_checked(spark, str(tmp_path))
    assert sorted((r["period"], r["a"]) for r in rows.collect()) == [(1, "1"), (1, "4"), (2, "9"), (2, "notanumber")]
    found = sorted((r["period"], r["record"] or "", r["reason"]) for r in rejected.collect())
    assert [f[:2] for f in found] == [(1, "2"), (1, "3,y,z"), (3, "")] and found[2][2] == "no header"
    assert all(r["file"].endswith(f"p{r['period']}_extrac.csv") for r in rejected.collect())
    typed = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows, rejected = readers.read_folder_checked(spark, str(tmp_path), typed)
    assert rows.columns == ["a", "b", "period"] and rows.agg(F.sum("a")).first()[0] == 14
    assert rejected.where("record is not null").count() == 3 and rows.select("b").count() == 3


def test_promotions_at_one_moment_get_numbers_of_their_own(spark, tmp_path):
    root = str(tmp_path)
    numbers = runtime.side_by_side(spark, [lambda k=k: registry.promote(spark, root, "m", f"f{k}", 0.5) for k in range(6)], 6, "race")
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    held = {r["version"]: r["folder"] for r in registry.registry(spark, root).collect()}
    assert held == {n: f"f{k}" for k, n in enumerate(numbers)} and registry.production_folder(spark, root, "m") == held[6]
    assert registry.promote(spark, root, "other", "g", None) == 1
