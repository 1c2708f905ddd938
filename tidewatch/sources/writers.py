"""Sinks: feature, attribute and score tables, delivery files, reference snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.operators.cleaning import project_features, project_post
from tidewatch.params import FeatureSpec
from tidewatch.runtime import tasks_for


#: What an overwrite replaces: the whole table, or only the periods that the new rows hold. Periods are staged and moved in
#: place one by one when the job commits, so a failing job leaves all of them as they were.
WHOLE, PERIODS = "static", "dynamic"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by_period: bool = True, replace: str = WHOLE) -> str:
    """Parquet, one folder per period so that later reads prune to the periods they need."""
    writer = df.write.mode(mode)
    if by_period and "period" in df.columns:
        writer = writer.partitionBy("period").option("partitionOverwriteMode", replace)
    writer.parquet(path)
    return path


def write_features(clean: DataFrame, spec: FeatureSpec, path: str, with_target: bool = False) -> str:
    """Feature table; the periods of `clean` are replaced, others stay. So for attributes and scores."""
    return write_table(project_features(clean, spec, with_target), path, replace=PERIODS)


def write_post(clean: DataFrame, spec: FeatureSpec, path: str) -> str:
    return write_table(project_post(clean, spec), path, replace=PERIODS)


def write_scores(scored: DataFrame, spec: FeatureSpec, path: str, score: str = "predictions") -> str:
    return write_table(scored.select(spec.row_id, spec.period, score), path, replace=PERIODS)


def write_delivery(delivery: DataFrame, path: str, mode: str = "overwrite", rows_per_task: int | None = None) -> str:
    """Pipe-delimited text with a header, a folder per period, best rows first within each file. Periods that
    `delivery` does not hold stay as they are.

    Rows are spread over tasks by ranges of the rank, so a large period becomes several ordered files.
    `delivery` should be a written table: its rows are counted, which gives the tasks, then sampled and read.
    """
    tasks = tasks_for(delivery, rows_per_task)
    (
        delivery.repartitionByRange(tasks, "period", "orden").sortWithinPartitions("period", "orden")
        .write.mode(mode).partitionBy("period").option("partitionOverwriteMode", PERIODS)
        .option("sep", "|").option("header", True).option("emptyValue", "").csv(path)
    )
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def save_reference(parts: dict[str, DataFrame], root: str) -> str:
    """Write reference snapshots `reference_{part}` as parquet."""
    for part, df in parts.items():
        df.write.mode("overwrite").parquet(f"{root}/reference_{part}")
    return root
