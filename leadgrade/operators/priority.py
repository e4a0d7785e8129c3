"""Priority table, validation, top lists, capture and weight sweeps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.functions.scoring import (
    attitude_score,
    bad_score_reason,
    priority,
    resolve_weights,
)


def priority_table(
    scored: DataFrame,
    predictions: DataFrame,
    weight_conversion: float | None = None,
    weight_sentiment: float | None = None,
    scores: Mapping[str, float] | None = None,
) -> DataFrame:
    """Inner join on ``lead_id``, scores, and ``priority`` to six places (the edge)."""
    joined = scored.join(predictions, "lead_id")
    priced = with_priority(joined, weight_conversion, weight_sentiment, scores)
    return priced.withColumn("priority", r6("priority"))


def with_priority(
    df: DataFrame,
    weight_conversion: float | None = None,
    weight_sentiment: float | None = None,
    scores: Mapping[str, float] | None = None,
    label: str = "predicted_attitude",
) -> DataFrame:
    p, attitude = F.col("p_conversion"), F.col(label)
    mix = priority(p, attitude, weight_conversion, weight_sentiment, scores)
    return df.withColumns(
        {"sentiment_score": attitude_score(attitude, scores), "priority": mix}
    )


def checked_priority(
    df: DataFrame,
    weight_conversion: float | None = None,
    weight_sentiment: float | None = None,
    scores: Mapping[str, float] | None = None,
    label: str = "predicted_attitude",
) -> DataFrame:
    """Like ``with_priority``, but a bad row fails the query with its reason."""
    out = with_priority(df, weight_conversion, weight_sentiment, scores, label)
    reason = bad_score_reason(F.col("p_conversion"), F.col(label), scores)
    message = F.concat(reason, F.lit(" for lead "), F.col("lead_id").cast("string"))
    return out.withColumn(
        "priority",
        F.when(reason.isNotNull(), F.raise_error(message).cast("double")).otherwise(
            F.col("priority")
        ),
    )


def quarantine(
    df: DataFrame,
    scores: Mapping[str, float] | None = None,
    label: str = "predicted_attitude",
) -> DataFrame:
    """Rows tagged with ``reject_reason``; null marks a row that can be scored."""
    reason = bad_score_reason(F.col("p_conversion"), F.col(label), scores)
    return df.withColumn("reject_reason", reason)


def check_top_arguments(n: int, min_priority: float, max_n: int | None = None) -> None:
    if n < 0 or (max_n is not None and n > max_n):
        raise ValueError(f"n must be in [0, {'any' if max_n is None else max_n}]; got {n}")
    if not 0.0 <= min_priority <= 1.0:
        raise ValueError(f"min_priority must be in [0, 1]; got {min_priority}")


def top_leads(
    ranked: DataFrame, n: int = 10, min_priority: float = 0.0, max_n: int | None = None
) -> DataFrame:
    """First ``n`` leads by priority at or above the floor; ties by id. A caller that
    wants to refuse long lists passes ``max_n``."""
    check_top_arguments(n, min_priority, max_n)
    if min_priority > 0.0:
        ranked = ranked.where(F.col("priority") >= min_priority)
    return ranked.orderBy(F.desc("priority"), "lead_id").limit(n)


def top_list(
    ranked: DataFrame, n: int = 10, min_priority: float = 0.0, max_n: int | None = None
) -> DataFrame:
    """``top_leads`` with ``total_available``, the number of all leads. An empty list is one
    row that holds the total and nulls."""
    total = ranked.agg(
        F.count("*").alias("total_available"),
        F.count_if(F.col("priority") >= min_priority).alias("_above"),
    )
    top = top_leads(ranked, n, min_priority, max_n)
    nothing = total.where((F.col("_above") == 0) | F.lit(n == 0))
    listed = top.crossJoin(F.broadcast(total))
    return listed.unionByName(nothing, allowMissingColumns=True).drop("_above")


def join_overlap(
    leads: DataFrame, predictions: DataFrame, floor: float = C.JOIN_OVERLAP_FLOOR
) -> DataFrame:
    """Share of distinct predicted leads that exist as leads, and whether it is enough."""
    wanted = predictions.select("lead_id").distinct()
    known = leads.select("lead_id").distinct().withColumn("_known", F.lit(1))
    share = F.count("_known") / F.nullif(F.count("*"), F.lit(0))
    return wanted.join(known, "lead_id", "left").agg(
        F.count("*").alias("n_predictions"),
        F.count("_known").alias("n_matched"),
        r6(share).alias("overlap"),
        (share >= floor).alias("ok"),
    )


def require_overlap(leads: DataFrame, predictions: DataFrame) -> None:
    row = join_overlap(leads, predictions).first()
    if not row["ok"]:
        raise ValueError(
            f"only {row['overlap']} of the predictions join a lead; "
            f"at least {C.JOIN_OVERLAP_FLOOR} must"
        )


def _base_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("base_rate"))


def top_n_capture(
    ranked: DataFrame, sizes: Sequence[int] = C.CAPTURE_SIZES, label: str = "converted"
) -> DataFrame:
    """Positives among the first N and lift over the base rate, per N.

    The largest N rows are found by a top-k, so only that many rows are numbered.
    """
    top = ranked.orderBy(F.desc("priority"), "lead_id").limit(max(sizes))
    first = F.sort_array(
        F.collect_list(
            F.struct((-F.col("priority")).alias("s"), "lead_id", F.col(label).alias("y"))
        )
    )
    head = top.agg(first.alias("_top"))

    def captured(n: int):
        part = F.slice("_top", 1, n)
        return F.struct(
            F.lit(n).alias("n"),
            F.size(part).alias("actual_n"),
            F.aggregate(part, F.lit(0), lambda a, x: a + x["y"]).alias("captured"),
        )

    rows = head.select(F.inline(F.array(*[captured(n) for n in sizes])))
    rate = F.col("captured") / F.nullif("actual_n", F.lit(0))
    return rows.crossJoin(F.broadcast(_base_rate(ranked, label))).select(
        "n",
        "actual_n",
        "captured",
        r6(rate).alias("capture_rate"),
        r6("base_rate").alias("base_rate"),
        r6(rate / F.nullif("base_rate", F.lit(0.0))).alias("lift"),
    )


def weight_sweep(
    ranked: DataFrame,
    grid: Sequence[float] = C.WEIGHT_GRID,
    top_n: int = 50,
    label: str = "converted",
) -> DataFrame:
    """Capture in the top N for each conversion weight.

    ``row_number() <= N`` is cut per task before the shuffle, so each weight moves
    at most N rows per task.
    """
    settings = [
        F.struct(F.lit(w).alias("w_conv"), F.lit(1.0 - w).alias("w_sent")) for w in grid
    ]
    for w in grid:
        resolve_weights(w, 1.0 - w)
    each = ranked.select(
        "lead_id",
        F.col(label).alias("_y"),
        "p_conversion",
        "sentiment_score",
        F.inline(F.array(*settings)),
    ).withColumn(
        "_p",
        F.col("w_conv") * F.col("p_conversion")
        + F.col("w_sent") * F.col("sentiment_score"),
    )
    order = Window.partitionBy("w_conv", "w_sent").orderBy(F.desc("_p"), "lead_id")
    top = each.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top_n)
    found = top.groupBy("w_conv", "w_sent").agg(
        F.count("*").alias("actual_n"), F.sum("_y").cast("bigint").alias("captured")
    )
    rate = F.col("captured") / F.col("actual_n")
    return found.crossJoin(F.broadcast(_base_rate(ranked, label))).select(
        "w_conv",
        r6("w_sent").alias("w_sent"),
        "actual_n",
        "captured",
        r6(rate).alias("capture_rate"),
        r6(rate / F.nullif("base_rate", F.lit(0.0))).alias("lift"),
    )
