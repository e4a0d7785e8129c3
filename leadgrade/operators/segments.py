"""Engagement score, attitude segments, prompt context, language draw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import clip_normalize, given_or_placeholder, time_bucket
from leadgrade.functions.hashing import hash_normal, hash_uniform, weighted_choice
from leadgrade.functions.scoring import literal_map
from leadgrade.plans.ordered import quantiles

ENGAGEMENT_INPUTS = ("total_time_spent", "total_visits", "page_views_per_visit")


def engagement_score(
    leads: DataFrame,
    noise: float = C.ENGAGEMENT_NOISE,
    seed: int = C.DEFAULT_SEED,
    row_id: str = "lead_id",
) -> DataFrame:
    """Add ``engagement`` from time, visits, pages and the last activity.

    Nulls count as zero before the 95th percentile is taken, unlike in the
    feature clip. The three limits come from one ordering.
    """
    filled = leads.select(
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ENGAGEMENT_INPUTS]
    ).unpivot([], list(ENGAGEMENT_INPUTS), "column", "value")
    limits = (
        quantiles(filled, "value", {"q": C.CLIP_QUANTILE}, ["column"])
        .groupBy()
        .agg(
            *[
                F.max(F.when(F.col("column") == c, F.col("q"))).alias(f"_q_{c}")
                for c in ENGAGEMENT_INPUTS
            ]
        )
    )
    score = F.lit(0.0)
    for c in ENGAGEMENT_INPUTS:
        part = clip_normalize(F.col(c), F.col(f"_q_{c}"))
        score = score + F.lit(C.ENGAGEMENT_WEIGHTS[c]) * part
    bonus = F.try_element_at(literal_map(C.ACTIVITY_BONUS), F.col("last_activity"))
    score = score + F.lit(C.ENGAGEMENT_WEIGHTS["activity_bonus"]) * F.coalesce(
        bonus, F.lit(0.0)
    )
    if noise:
        score = score + F.lit(noise) * hash_normal(F.col(row_id), f"noise{seed}")
    wide = leads.crossJoin(F.broadcast(limits)).withColumn("engagement", score)
    return wide.drop(*[f"_q_{c}" for c in ENGAGEMENT_INPUTS])


def assign_segments(
    leads: DataFrame,
    noise: float = C.ENGAGEMENT_NOISE,
    seed: int = C.DEFAULT_SEED,
    row_id: str = "lead_id",
) -> DataFrame:
    """Add ``attitude``: engaged or not at the median, then by random friction.

    The outcome column is not used.
    """
    scored = engagement_score(leads, noise, seed, row_id).withColumn(
        "_friction", hash_normal(F.col(row_id), f"friction{seed}")
    )
    median = quantiles(scored, "engagement", {"_median": 0.5}).select("_median")
    engaged = F.col("engagement") >= F.col("_median")
    warm = F.when(
        F.col("_friction") >= C.FRICTION_CUT_ENGAGED, "positive_engagement"
    ).otherwise("objection")
    cold = F.when(F.col("_friction") < C.FRICTION_CUT_DISENGAGED, "disengaged").otherwise(
        "neutral"
    )
    return (
        scored.crossJoin(F.broadcast(median))
        .withColumn("attitude", F.when(engaged, warm).otherwise(cold))
        .drop("_friction", "_median")
    )


def with_time_bucket(leads: DataFrame) -> DataFrame:
    return leads.withColumn("time_bucket", time_bucket(F.col("total_time_spent")))


def neutral_context(leads: DataFrame) -> DataFrame:
    """Add ``context``: five fields that say nothing about the outcome."""
    context = F.struct(
        given_or_placeholder(F.col("lead_source")).alias("lead_source"),
        given_or_placeholder(F.col("specialization")).alias("specialization"),
        given_or_placeholder(F.col("occupation")).alias("occupation"),
        given_or_placeholder(F.col("last_activity")).alias("last_activity"),
        time_bucket(F.col("total_time_spent")).alias("time_bucket"),
    )
    return leads.withColumn("context", context)


def assign_language(
    leads: DataFrame,
    mix: dict[str, float] | None = None,
    seed: int = C.DEFAULT_SEED,
    row_id: str = "lead_id",
) -> DataFrame:
    """Add ``language``, drawn by weight; weights are normalized to one."""
    draw = hash_uniform(F.col(row_id), f"lang{seed}")
    return leads.withColumn("language", weighted_choice(draw, mix or C.LANGUAGE_MIX))
