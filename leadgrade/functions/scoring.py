"""Priority formula, score lookup, class weights."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadgrade import constants as C


def resolve_weights(
    weight_conversion: float | None = None, weight_sentiment: float | None = None
) -> tuple[float, float]:
    """Both weights or neither; they must be non-negative and sum to one."""
    if (weight_conversion is None) != (weight_sentiment is None):
        raise ValueError("give both priority weights or neither")
    if weight_conversion is None or weight_sentiment is None:
        return C.WEIGHT_CONVERSION, C.WEIGHT_SENTIMENT
    if abs(weight_conversion + weight_sentiment - 1.0) > C.WEIGHT_TOLERANCE:
        raise ValueError(
            f"priority weights must sum to 1: {weight_conversion} + {weight_sentiment}"
        )
    if weight_conversion < 0 or weight_sentiment < 0:
        raise ValueError(
            "priority weights must be non-negative: "
            f"{weight_conversion}, {weight_sentiment}"
        )
    return weight_conversion, weight_sentiment


def literal_map(values: Mapping[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def attitude_score(label: Column, scores: Mapping[str, float] | None = None) -> Column:
    """Score of a label; null for an unknown label."""
    return F.try_element_at(literal_map(scores or C.ATTITUDE_SCORES), label)


def priority(
    p_conversion: Column,
    label: Column,
    weight_conversion: float | None = None,
    weight_sentiment: float | None = None,
    scores: Mapping[str, float] | None = None,
) -> Column:
    """``w_c * p + w_s * score(label)``; null when the label is unknown."""
    w_c, w_s = resolve_weights(weight_conversion, weight_sentiment)
    return F.lit(w_c) * p_conversion + F.lit(w_s) * attitude_score(label, scores)


def bad_score_reason(
    p_conversion: Column, label: Column, scores: Mapping[str, float] | None = None
) -> Column:
    """Why a row cannot be scored; null for a good row."""
    known = list(scores or C.ATTITUDE_SCORES)
    in_range = (p_conversion >= 0) & (p_conversion <= 1) & ~F.isnan(p_conversion)
    return F.when(
        ~F.coalesce(in_range, F.lit(False)), "p_conversion_out_of_range"
    ).when(~F.coalesce(label.isin(*known), F.lit(False)), "unknown_attitude")


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
