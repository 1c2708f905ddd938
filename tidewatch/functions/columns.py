"""Column expressions. Everything here is a built-in Spark expression: no Python per row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import params as P

# Drift bands (upper limit, label, colour); above the last limit it is an alarm.
STATUS_BANDS = ((0.10, "OK", "#27ae60"), (0.25, "WARN", "#f39c12"))
STATUS_TOP = ("ALARM", "#e74c3c")


def missing_to_null(col: Column, tokens: Iterable[str]) -> Column:
    """Texts that stand for a missing value become NULL."""
    return F.when(~col.isin(*tokens), col)


def as_number(col: Column) -> Column:
    """Any numeric or boolean as double, with NaN as NULL."""
    value = col.cast("double")
    return F.when(~F.isnan(value), value)


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def collapse_category(col: Column, allowed: Iterable[str], other: str, missing: str) -> Column:
    """Values outside the allowed list, and missing ones, become `other`."""
    filled = F.coalesce(col.cast("string"), F.lit(missing))
    return F.when(filled.isin(*allowed), filled).otherwise(F.lit(other))


def zero_pad(col: Column, width: int) -> Column:
    """Left-pad with zeros, keep a leading sign in front, never cut longer texts. Whole numbers stored with a
    fraction of zeros lose it first; other texts stay as they are."""
    text = F.regexp_replace(col.cast("string"), r"^([+-]?\d+)\.0+$", "$1")
    signed = text.rlike("^[+-]")
    padded = F.when(
        signed, F.concat(F.substring(text, 1, 1), F.lpad(F.substr(text, F.lit(2)), width - 1, "0"))
    ).otherwise(F.lpad(text, width, "0"))
    return F.when(F.length(text) >= width, text).otherwise(padded)


def freshness_weight(group: Column) -> Column:
    chain = F
    for name, value in P.FRESHNESS_WEIGHTS.items():
        chain = chain.when(group == name, F.lit(value))
    return chain.otherwise(F.lit(P.FRESHNESS_OTHER))


def log1p_amount(amount: Column) -> Column:
    """ln(amount + 1); NULL where the logarithm has no finite value."""
    return F.when(amount > -1, F.log(amount + 1))


def value_score(probability: Column, contact: Column, amount: Column, group: Column) -> Column:
    """Expected value of contacting a customer."""
    filled = F.coalesce(contact, F.lit(P.CONTACT_PROBABILITY_FILL))
    return probability * filled * log1p_amount(amount) * freshness_weight(group)


def _banded(psi: Column, part: int) -> Column:
    label = F.when(psi.isNull(), F.lit(None).cast("string"))
    for band in STATUS_BANDS:
        label = label.when(psi < band[0], F.lit(band[part]))
    return label.otherwise(F.lit(STATUS_TOP[part - 1]))


def status_band(psi: Column) -> Column:
    """OK, WARN or ALARM; NULL for a stage without a result."""
    return _banded(psi, 1)


def status_colour(psi: Column) -> Column:
    return _banded(psi, 2)


def status_text(psi: Column) -> Column:
    """`STATUS 0.123`, or a dash where there is no result."""
    shown = F.format_string("%s %.3f", status_band(psi), F.bround(psi, 3))
    return F.when(psi.isNull(), F.lit("—")).otherwise(shown)


def hash_fraction(key: Column, seed: int, digits: int = 8) -> Column:
    """A whole number from the first hex digits of md5(key ‖ seed): the same for a key in every
    run and under every partitioning."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")
