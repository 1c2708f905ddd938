"""Stand-ins for the pipeline's inputs, built from the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.params import FeatureSpec, MonitorParams
from tidewatch.runtime import new_folder
from tidewatch.sources.writers import write_table

NUMERIC = ("o_totalprice", "c_acctbal", "n_lines", "sum_qty", "sum_price", "avg_discount", "avg_tax")

SPEC = FeatureSpec(
    numeric=NUMERIC, category="segment", allowed=("BUILDING",), partition="codmes",
    document="key_value", customer="codunicocli", campaign_group="grp",
)
REFERENCE_PERIODS = (1, 2, 3, 4)
MONITORED_PERIODS = (5, 6)
PARAMS = MonitorParams(
    training_periods=REFERENCE_PERIODS, monitoring_periods=MONITORED_PERIODS, psi_quantiles=10, spec=SPEC,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FIRST_YEAR = 1995


def orders_of(spark: SparkSession, sf_dir: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """Orders, of some periods if wanted. The span of the periods is also stated on the date itself, so
    the scan skips what lies outside."""
    orders = table(spark, sf_dir, "orders")
    if wanted is None:
        return orders
    first, after = (dt.date(FIRST_YEAR - 1 + p, 1, 1) for p in (min(wanted), max(wanted) + 1))
    date = F.col("o_orderdate")
    return orders.where((date >= F.lit(first)) & (date < F.lit(after))
                        & (F.year(date) - (FIRST_YEAR - 1)).isin(*wanted))


def base(spark: SparkSession, sf_dir: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """One row per order: identity, period (year), post attributes, numeric features, a category."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.round(F.avg("l_tax"), 6).alias("avg_tax"))
    # Orders and their lines are both large: a sort-merge join on the order key, spread over all tasks.
    joined = (
        orders_of(spark, sf_dir, wanted)
        .join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    priority = F.col("o_orderpriority")
    group = (F.when(priority == "1-URGENT", "G1").when(priority == "2-HIGH", "G2")
             .when(priority == "3-MEDIUM", "G3").when(priority == "4-NOT SPECIFIED", "G4"))
    contact = F.when(F.col("o_orderkey") % 11 != 0, (F.col("o_orderkey") % 97 + 1) / F.lit(100.0))
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return joined.select(
        F.col("o_orderkey").alias("row_id"),
        (year - (FIRST_YEAR - 1)).alias("period"),
        (year * 100 + month).cast("string").alias("codmes"),
        F.col("o_custkey").alias("key_value"),
        F.col("c_custkey").alias("codunicocli"),
        group.alias("grp"),
        contact.alias("prob_value_contact"),
        F.col("o_totalprice").alias("monto"),
        F.col("c_mktsegment").alias("segment"),
        *NUMERIC)


def with_score(df: DataFrame) -> DataFrame:
    """A score that SQL can compute too."""
    logit = (F.coalesce("c_acctbal", F.lit(0)) / 5000 - 1 + F.coalesce("sum_qty", F.lit(0)) / 200
             - F.coalesce("avg_discount", F.lit(0)) * 10)
    return df.withColumn("prob", 1 / (1 + F.exp(-logit)))


def scored(spark: SparkSession, sf_dir: str, wanted: Sequence[int] | None = None) -> DataFrame:
    return with_score(base(spark, sf_dir, wanted))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table with one folder per period, as the pipeline does between its steps, and
    read it back: scans of some periods read only their folders."""
    spark = df.sparkSession
    path = write_table(df, new_folder(spark, label))
    return spark.read.schema(df.schema).parquet(path)


def periods(df: DataFrame, wanted) -> DataFrame:
    return df.where(F.col("period").isin(*wanted))


def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One operational row per (stage, period), made from the events."""
    kind = F.col("event_type")
    stage = (F.when(kind == "view", "raw").when(kind == "click", "pre")
             .when(kind == "purchase", "score").when(kind == "signup", "grupo"))
    # Decimals, so that the difference has no binary noise to round.
    cents = F.col("value").cast("decimal(18,2)")
    return (
        table(spark, sf_dir, "events").where(kind != "error")
        .groupBy(stage.alias("stage"), F.dayofmonth("ts").alias("period"))
        .agg(F.round(F.avg("value") * 0.6, 2).alias("duration_s"),
             F.round(F.max(cents) - F.min(cents), 1).cast("double").alias("ram_delta_mb"),
             F.least(F.round(F.avg("value") * 1.6, 1), F.lit(100.0)).alias("ram_sys_pct"))
    )
