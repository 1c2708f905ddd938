"""From raw columns to model features: one narrow projection per table, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import columns as fn
from tidewatch.params import FeatureSpec


def null_tokens(df: DataFrame, tokens: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value texts become NULL in every string column (or in `columns`)."""
    names = set(columns if columns is not None else
                [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    return df.select(*[
        fn.missing_to_null(F.col(c), tokens).alias(c) if c in names else F.col(c) for c in df.columns
    ])


def to_float32(df: DataFrame, columns: Sequence[str], lenient: bool = False) -> DataFrame:
    """Cast to 32-bit floats. A text that is no number raises; `lenient` makes it NULL."""
    def cast(c: str) -> Column:
        return F.col(c).try_cast("float") if lenient else F.col(c).cast("float")

    return df.withColumns({c: F.when(~F.isnan(cast(c)), cast(c)) for c in columns})


def fill_sentinel(df: DataFrame, columns: Sequence[str], sentinel: float) -> DataFrame:
    return df.fillna(sentinel, subset=list(columns))


def collapse_categories(df: DataFrame, column: str, allowed: Sequence[str], other: str,
                        missing: str) -> DataFrame:
    return df.withColumn(column, fn.collapse_category(F.col(column), allowed, other, missing))


def category_values(df: DataFrame, column: str, most: int = 1000) -> list[str]:
    """Distinct values of a category, sorted. They become columns: more than `most` is an error, found
    without bringing them all to the driver."""
    values = df.select(F.col(column).cast("string").alias("v")).where("v is not null").distinct()
    rows = values.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values: collapse it before one-hot encoding")
    return sorted(r["v"] for r in rows)


def one_hot(df: DataFrame, column: str, categories: Sequence[str] | None = None, most: int = 1000) -> DataFrame:
    """Replace a category by one boolean column per value; NULL rows are false everywhere.

    With `categories` the columns are fixed, whatever the data hold; without, they are discovered, and more
    than `most` of them are an error, since each becomes a column of the table.
    """
    values = list(categories) if categories is not None else category_values(df, column, most)
    flags = [
        F.coalesce(F.col(column) == F.lit(v), F.lit(False)).alias(f"{column}_{v}") for v in values
    ]
    return df.select(*[c for c in df.columns if c != column], *flags)


def clean_features(raw: DataFrame, spec: FeatureSpec, lenient: bool = False) -> DataFrame:
    """All cleaning steps on a raw table: tokens, 32-bit numbers with the sentinel, strings,
    category collapse, one-hot with the spec's fixed categories."""
    df = null_tokens(raw, spec.tokens)
    df = to_float32(df, spec.numeric, lenient)
    df = fill_sentinel(df, spec.numeric, spec.sentinel)
    df = df.withColumn(spec.partition, F.col(spec.partition).cast("string"))
    df = collapse_categories(df, spec.category, spec.allowed, spec.other_category, spec.missing_category)
    return one_hot(df, spec.category, spec.categories)


def _identity(df: DataFrame, spec: FeatureSpec) -> list[str]:
    return [c for c in (spec.row_id, spec.period) if c in df.columns]


def project_features(clean: DataFrame, spec: FeatureSpec, with_target: bool = False) -> DataFrame:
    """Row identity, [target], features in contract order."""
    target = [spec.target] if with_target else []
    return clean.select(*_identity(clean, spec), *target, *spec.features)


def project_post(clean: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Row identity and the attributes the delivery table needs later."""
    return clean.select(*_identity(clean, spec), *spec.post_columns)


def normalise_types(df: DataFrame, keep: Sequence[str] = (), places: int = 4) -> DataFrame:
    """Booleans to int, integers to long, floats to doubles rounded half-even."""
    def convert(field: T.StructField) -> Column:
        col = F.col(field.name)
        if field.name in keep:
            return col
        if isinstance(field.dataType, T.BooleanType):
            return col.cast("int").alias(field.name)
        if isinstance(field.dataType, T.IntegralType):
            return col.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.FractionalType) and not isinstance(field.dataType, T.DecimalType):
            return F.bround(col.cast("double"), places).alias(field.name)
        return col

    return df.select(*[convert(f) for f in df.schema])


def align_columns(df: DataFrame, train_columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The training columns in training order: absent ones are 0, others are dropped."""
    aligned = [F.col(c) if c in df.columns else F.lit(0).alias(c) for c in train_columns]
    return df.select(*keep, *aligned)


def split_target(df: DataFrame, target: str | None = None) -> tuple[str, list[str]]:
    """Label and feature names; without a name the first column is the label."""
    label = target or df.columns[0]
    return label, [c for c in df.columns if c != label]
