"""Ranking metrics: AUC, average precision, curves, gain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.functions.hashing import hash_bucket, hash_uniform
from leadgrade.plans.ordered import (
    TIE_SEED,
    bucket_count,
    running_rows,
    running_totals,
)


def score_counts(
    df: DataFrame, score: str, label: str, groups: Sequence[str] = ()
) -> DataFrame:
    """(groups, score, pos, neg): one row per distinct score of the labelled rows."""
    y = F.col(label).cast("int")
    return df.where(y.isNotNull()).groupBy(*groups, F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )


def cumulative(
    counts: DataFrame,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Counts with running and total positives and negatives, best score first."""
    return running_totals(counts, "score", ["pos", "neg"], groups)


def roc_auc_expr() -> Column:
    """Area over distinct scores; equal scores count half. Null with one class."""
    above = F.col("cum_pos") - F.col("pos") + F.col("pos") / F.lit(2.0)
    pairs = F.max("total_pos").cast("double") * F.max("total_neg")
    return F.sum(F.col("neg") * above) / F.nullif(pairs, F.lit(0.0))


def average_precision_expr() -> Column:
    """Step-wise sum of precision over recall gains (no interpolation)."""
    precision = F.col("cum_pos") / F.nullif(F.col("cum_pos") + F.col("cum_neg"), F.lit(0))
    positives = F.nullif(F.max("total_pos"), F.lit(0))
    return F.sum(F.col("pos") * precision) / positives


def ranking_metrics(
    df: DataFrame, score: str, label: str, groups: Sequence[str] = ()
) -> DataFrame:
    """n, positives, roc_auc and average_precision, per group."""
    return (
        cumulative(score_counts(df, score, label, groups), groups)
        .groupBy(*groups)
        .agg(
            F.max(F.col("total_pos") + F.col("total_neg")).alias("n"),
            F.max("total_pos").alias("n_positive"),
            r6(roc_auc_expr()).alias("roc_auc"),
            r6(average_precision_expr()).alias("average_precision"),
        )
    )


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score."""
    return cumulative(score_counts(df, score, label)).select(
        F.col("score").alias("threshold"),
        r6(F.col("cum_neg") / F.nullif("total_neg", F.lit(0))).alias("fpr"),
        r6(F.col("cum_pos") / F.nullif("total_pos", F.lit(0))).alias("tpr"),
    )


def pr_points(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    taken = F.nullif(F.col("cum_pos") + F.col("cum_neg"), F.lit(0))
    return cumulative(score_counts(df, score, label)).select(
        F.col("score").alias("threshold"),
        r6(F.col("cum_pos") / taken).alias("precision"),
        r6(F.col("cum_pos") / F.nullif("total_pos", F.lit(0))).alias("recall"),
    )


def rank_rows(df: DataFrame, score: str, row_id: str = "lead_id") -> DataFrame:
    """Add ``rank``: 1 for the best score."""
    return running_rows(df, score, row_id, {"rank": F.lit(1)}).drop("total_rank")


def ranked_rows(
    df: DataFrame, score: str, label: str, row_id: str = "lead_id"
) -> DataFrame:
    """Row number from the best score down, with running positives."""
    y = F.coalesce(F.col(label).cast("int"), F.lit(0))
    return running_rows(df, score, row_id, {"rank": F.lit(1), "cum_positive": y})


def gain_curve(
    df: DataFrame, score: str, label: str, row_id: str = "lead_id"
) -> DataFrame:
    """(rank, fraction, gain) per row."""
    return ranked_rows(df, score, label, row_id).select(
        "rank",
        r6(F.col("rank") / F.col("total_rank")).alias("fraction"),
        r6(F.col("cum_positive") / F.nullif("total_cum_positive", F.lit(0))).alias("gain"),
    )


def gain_at_fraction(
    df: DataFrame,
    score: str,
    label: str,
    fractions: Sequence[float] = C.GAIN_FRACTIONS,
    row_id: str = "lead_id",
) -> DataFrame:
    """Share of positives in the top ``ceil(f * n)`` rows; 0 without positives.

    Rows are ordered as in ``ranked_rows``, but only the rows a cut falls among are
    ordered: first the score of the k-th row is found from counts per score, then
    the hash bucket among the rows with that score, then the rows of that bucket.
    Each step has one row per fraction, so its broadcast is bounded by the argument
    list, and the rows themselves are filtered by it before any shuffle.
    """
    buckets = bucket_count(df.sparkSession)
    base = df.select(
        F.col(score).cast("double").alias("score"),
        F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("pos"),
        F.col(row_id).alias("_id"),
    )
    per_score = base.groupBy("score").agg(F.count("*").alias("n"), F.sum("pos").alias("pos"))

    def size(f: float) -> Column:
        return F.ceil(F.lit(float(f)) * F.col("total_n").cast("double"))

    wanted = [f for f in dict.fromkeys(fractions) if f > 0]
    steps = running_totals(
        per_score, "score", ["n", "pos"], reaching=("n", [size(f) for f in wanted])
    )
    cuts = F.array(
        *[
            F.struct(F.lit(float(f)).alias("fraction"), size(f).alias("k"))
            for f in wanted
        ]
    )
    at_score = (
        steps.select("*", F.inline(cuts))
        .where((F.col("k") > F.col("cum_n") - F.col("n")) & (F.col("k") <= F.col("cum_n")))
        .select(
            "fraction",
            "k",
            "score",
            "total_pos",
            (F.col("cum_n") - F.col("n")).alias("_n0"),
            (F.col("cum_pos") - F.col("pos")).alias("_p0"),
        )
    )
    tied = (
        base.join(F.broadcast(at_score), "score")
        .withColumn("_u", hash_uniform(F.col("_id"), TIE_SEED))
        .withColumn("_tb", hash_bucket(F.col("_u"), buckets))
    )
    upto = (
        Window.partitionBy("fraction")
        .orderBy("_tb")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    facts = ["fraction", "k", "total_pos", "_n0", "_p0"]
    at_cell = (
        tied.groupBy(*facts, "_tb")
        .agg(F.count("*").alias("n"), F.sum("pos").alias("pos"))
        .withColumn("_n1", F.sum("n").over(upto))
        .withColumn("_p1", F.sum("pos").over(upto))
        .withColumn("_want", F.col("k") - F.col("_n0"))
        .where(F.col("_want").between(F.col("_n1") - F.col("n") + 1, F.col("_n1")))
        .select(
            "fraction",
            "_tb",
            (F.col("_n1") - F.col("n")).alias("_n1"),
            (F.col("_p1") - F.col("pos")).alias("_p1"),
        )
    )
    order = Window.partitionBy("fraction").orderBy("_u", "_id")
    found = (
        tied.join(F.broadcast(at_cell), ["fraction", "_tb"])
        .withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") <= F.col("k") - F.col("_n0") - F.col("_n1"))
        .groupBy("fraction", "k")
        .agg(
            (F.max(F.col("_p0") + F.col("_p1")) + F.sum("pos")).alias("_hits"),
            F.max("total_pos").alias("_p"),
        )
    )
    values = F.array(*[F.lit(float(f)) for f in fractions])
    grid = df.sparkSession.range(1).select(F.explode(values).alias("fraction"))
    gain = F.col("_hits") / F.nullif("_p", F.lit(0))
    return grid.join(found, "fraction", "left").select(
        "fraction",
        F.coalesce("k", F.lit(0)).cast("bigint").alias("k"),
        r6(F.coalesce(gain, F.lit(0.0))).alias("gain"),
    )


def argmax_row(df: DataFrame, score: str, row_id: str = "lead_id") -> DataFrame:
    """The row with the highest score; ties by smallest id."""
    return df.orderBy(F.desc(score), row_id).limit(1)
