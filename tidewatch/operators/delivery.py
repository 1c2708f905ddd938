"""From scores to the delivery table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import params as P
from tidewatch.functions.columns import as_number, value_score, zero_pad
from tidewatch.operators.ranking import best_per_key, execution_groups, rank_rows
from tidewatch.params import FeatureSpec
from tidewatch.runtime import materialize


def attach_scores(post: DataFrame, scores: DataFrame, spec: FeatureSpec, score: str = "predictions",
                  out: str = "prob") -> DataFrame:
    """Meet scores and attributes on row identity; a row without score keeps a NULL."""
    keys = [c for c in (spec.period, spec.row_id) if c in post.columns and c in scores.columns]
    return post.join(scores.select(*keys, F.col(score).alias(out)), keys, "left")


def with_value_score(df: DataFrame, spec: FeatureSpec, probability: str = "prob",
                     out: str = "puntuacion") -> DataFrame:
    return df.withColumn(out, value_score(
        as_number(F.col(probability)), as_number(F.col(spec.contact_probability)),
        as_number(F.col(spec.amount)), F.col(spec.campaign_group)))


def delivery_columns(df: DataFrame, spec: FeatureSpec, run_date: dt.date, probability: str = "prob",
                     points: str = "puntuacion", group: str = "grupo_ejec") -> DataFrame:
    """Names, constants and formats of the delivery table; `orden` is added by the ranking."""
    return df.select(
        spec.row_id, spec.period,
        F.col(spec.partition).cast("string").alias("codmes"),
        F.lit(P.DOCUMENT_TYPE).alias("tipdoc"),
        F.col(spec.document).alias("coddoc"),
        F.col(points).alias("puntuacion"),
        F.lit(P.DELIVERY_MODEL_LABEL).alias("modelo"),
        F.date_format(F.lit(run_date), "yyyyMMdd").alias("fec_replica"),
        F.col(group).alias("grupo_ejec"),
        F.col(probability).alias("score"),
        zero_pad(F.col(spec.customer), P.CUSTOMER_ID_WIDTH).alias("variable1"),
        F.col(spec.amount).alias("variable2"),
        F.lit("").alias("variable3"))


# Order of the delivery columns.
DELIVERY_ORDER = ("codmes", "tipdoc", "coddoc", "puntuacion", "modelo", "fec_replica", "grupo_ejec",
                  "score", "orden", "variable1", "variable2", "variable3")


def postprocess(scored: DataFrame, spec: FeatureSpec, run_date: dt.date | None = None,
                probability: str = "prob", rows_per_task: int | None = None) -> DataFrame:
    """Value score, groups per period, best row per document, rank: the delivery table with `period`.

    Rows without a score come last and have no group.
    """
    df = materialize(with_value_score(scored, spec, probability), "valued")  # read by the cuts and by the rows
    df = execution_groups(df, "puntuacion", by=(spec.period,), rows_per_task=rows_per_task)
    df = delivery_columns(df, spec, run_date or dt.date.today(), probability)
    order = [F.desc_nulls_last("puntuacion"), F.asc(spec.row_id)]
    df = best_per_key(df, [spec.period, "coddoc"], order)
    df = rank_rows(df, order, by=(spec.period,), rows_per_task=rows_per_task)
    return df.select(spec.period, *DELIVERY_ORDER)
