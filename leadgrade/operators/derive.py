"""Raw lead -> 25 derived columns, as one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import (
    drop_placeholder,
    is_exactly,
    is_member,
    time_per_visit,
    yes_no,
)
from leadgrade.sources.schema import require_columns


def flag_columns(available: Sequence[str]) -> dict[str, Column]:
    """The 0/1 flags that the available raw columns allow."""
    flags = {c: yes_no(F.col(c)) for c in C.YES_NO_FLAGS if c in available}
    if "country" in available:
        flags["country_is_india"] = is_exactly(F.col("country"), "India")
    if "last_activity" in available:
        activity = F.col("last_activity")
        flags["is_high_intent_activity"] = is_member(activity, C.HIGH_INTENT_ACTIVITIES)
        flags["is_negative_activity"] = is_member(activity, C.NEGATIVE_ACTIVITIES)
    return flags


def derived_columns() -> dict[str, Column]:
    channels = [yes_no(F.col(c)).cast("int") for c in C.CHANNEL_FLAGS]
    total = channels[0]
    for flag in channels[1:]:
        total = total + flag
    return {
        **{c: F.col(c).cast("double") for c in C.CLIPPED_NUMERIC},
        "total_time_per_visit": time_per_visit(
            F.col("total_time_spent").cast("double"), F.col("total_visits").cast("double")
        ),
        "channel_diversity_count": total.cast("tinyint"),
        **{c: drop_placeholder(F.col(c)) for c in C.CATEGORICAL},
        **flag_columns(C.REQUIRED_RAW),
    }


def dropped_columns(raw: DataFrame) -> DataFrame:
    """(column, reason, n_present) of the raw columns that are no features: why each is left
    out, and in how many rows it has a value. Absent columns are skipped."""
    reasons = {
        **dict.fromkeys(C.ID_COLUMNS, "identifier"),
        **dict.fromkeys(C.POST_OUTCOME_COLUMNS, "known only after the outcome"),
        **dict.fromkeys(C.DEAD_FLAGS, "constant"),
    }
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(why).alias("reason"), F.count(c).alias("n_present")
        )
        for c, why in reasons.items()
        if c in raw.columns
    ]
    return raw.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def derive_features(leads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, then the 25 derived columns in their fixed order.

    Ids, post-outcome columns and dead flags do not survive the projection. The
    narrow select is also what lets the scan read only the needed columns.
    """
    require_columns(leads, C.REQUIRED_RAW, "derive_features")
    columns = derived_columns()
    return leads.select(*keep, *[columns[c].alias(c) for c in C.DERIVED_ORDER])
