"""Cleaning and flag expressions used when raw leads become features."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadgrade import constants as C


def strip(col: Column) -> Column:
    """Remove any leading and trailing whitespace (``trim`` removes spaces only)."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def yes_no(col: Column) -> Column:
    """1 for a trimmed, case-blind "yes", else 0; null is 0."""
    return F.coalesce(F.lower(strip(col)) == "yes", F.lit(False)).cast("tinyint")


def is_member(col: Column, values: Iterable[str]) -> Column:
    """1 when the untrimmed value is one of ``values``, else 0; null is 0."""
    return F.coalesce(col.isin(*values), F.lit(False)).cast("tinyint")


def is_exactly(col: Column, value: str) -> Column:
    """1 when the trimmed value equals ``value`` (case-sensitive); null is 0."""
    return F.coalesce(strip(col) == value, F.lit(False)).cast("tinyint")


def drop_placeholder(col: Column, placeholder: str = C.SELECT_PLACEHOLDER) -> Column:
    return F.nullif(col, F.lit(placeholder))


def nan_to_null(col: Column) -> Column:
    """Missing numbers are null everywhere in the engine; NaN sorts above all."""
    return F.when(~F.isnan(col), col)


def time_per_visit(total_time: Column, visits: Column) -> Column:
    """Time divided by visits, or by one when visits is null or not positive."""
    return total_time / F.when(visits > 0, visits).otherwise(F.lit(1.0))


def clip_upper(col: Column, limit: Column) -> Column:
    """Upper clip that keeps null null (``least`` would return the limit)."""
    return F.when(col > limit, limit).otherwise(col)


def clip_normalize(col: Column, upper: Column) -> Column:
    """Null as zero, divide by ``upper``, clamp to [0, 1]; zero if upper <= 0."""
    ratio = F.coalesce(col, F.lit(0.0)) / F.nullif(upper, F.lit(0.0))
    return F.when(
        upper > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio))
    ).otherwise(F.lit(0.0))


def scale(col: Column, mean: Column, std: Column) -> Column:
    """z-score; a zero deviation divides by one."""
    return (col - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std)


def time_bucket(seconds: Column) -> Column:
    chain = F.when(seconds.isNull() | F.isnan(seconds), "unknown")
    for limit, name in C.TIME_BUCKETS:
        chain = chain.when(seconds < limit, name)
    return chain.otherwise("high")


def given_or_placeholder(col: Column) -> Column:
    """Trimmed value; null, blank and "select" become the not-given text."""
    text = strip(col)
    missing = text.isNull() | (text == "") | (F.lower(text) == "select")
    return F.when(missing, C.NOT_GIVEN).otherwise(text)


def r6(col: Column | str) -> Column:
    """Round to six places at the output edge (adding zero folds -0.0)."""
    return F.round(col, 6) + F.lit(0.0)


def r9(col: Column | str) -> Column:
    """Round to nine places: quantiles lie between six-place values, on a finer grid."""
    return F.round(col, 9) + F.lit(0.0)
