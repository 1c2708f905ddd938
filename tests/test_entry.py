"""Queries next to their SQL on the smallest tables; the whole list runs with tools/check_queries.py."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import rows_of

QUICK = ["psi_report_raw", "psi_q1000_ties", "kl_report", "drift_bins", "group_drift", "exec_groups", "order_rank",
         "delivery_file", "fill_sentinel", "one_hot_discovered", "normalise_types", "exact_split", "score_density",
         "traffic_light", "ops_alerts", "auc_decay", "scan_csv_roundtrip", "scan_folder_by_name",
         "feature_tables", "stored_run"]


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = {n for n in set(entry.queries()) - set(entry.oracle_sql()) if not re.match(r"op\d+_|pipeline$", n)}
    assert not without


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and [r["psi"] for r in rows] == sorted((r["psi"] for r in rows), reverse=True)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())
