"""Exact stratified splits, folds and subsamples; split overlap tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.plans.ordered import cut_by_quota


def _named(df: DataFrame, names: Sequence[str], column: str) -> DataFrame:
    labels = F.array(*[F.lit(n) for n in names])
    return df.withColumn(column, F.get(labels, F.col("part"))).drop("part")


def stratified_split(
    df: DataFrame,
    strata: Sequence[str],
    fractions: dict[str, float],
    row_id: str = "lead_id",
    seed: int | str = C.DEFAULT_SEED,
    column: str = "split",
) -> DataFrame:
    """Assign every row to a named part, with exact counts in every stratum.

    ``fractions`` sum to one; the last part takes the remainder. A part gets the
    first ``floor(cumulative fraction * n + 0.5)`` rows of its stratum in hash
    order, so the split of a row depends on its id and seed alone, up to the cut.
    """
    if abs(sum(fractions.values()) - 1.0) > 1e-9:
        raise ValueError(f"fractions must sum to 1: {fractions}")
    edge, quotas = 0.0, []
    for share in list(fractions.values())[:-1]:
        edge += share
        quotas.append(F.floor(F.lit(round(edge, 12)) * F.col("n_stratum") + 0.5))
    parts = cut_by_quota(df, strata, row_id, quotas, seed)
    return _named(parts, list(fractions), column)


def split_60_20_20(
    df: DataFrame, label: str = "converted", row_id: str = "lead_id"
) -> DataFrame:
    return stratified_split(
        df, [label], {"train": 0.6, "val": 0.2, "test": 0.2}, row_id
    )


def split_80_10_10(
    df: DataFrame,
    strata: Sequence[str] = ("attitude", "language"),
    row_id: str = "lead_id",
    seed: int = C.DEFAULT_SEED,
) -> DataFrame:
    """Train, validation and test parts that keep the joint distribution.

    The hash seed differs from the one of ``split_60_20_20``: two splits of the
    same ids must be independent, or one test part would lie inside the other.
    """
    return stratified_split(
        df.withColumn("stratum", F.concat_ws("_", *strata)),
        ["stratum"],
        {"train": 0.8, "val": 0.1, "test": 0.1},
        row_id,
        f"joint{seed}",
    )


def kfold(
    df: DataFrame,
    strata: Sequence[str],
    k: int = 5,
    row_id: str = "lead_id",
    seed: int | str = C.DEFAULT_SEED,
) -> DataFrame:
    """Add ``fold`` in 0..k-1; the folds of a stratum differ by at most one row."""
    quotas = [F.floor(F.col("n_stratum") * i / k) for i in range(1, k)]
    return cut_by_quota(df, strata, row_id, quotas, f"fold{seed}", "fold")


def stratified_subsample(
    df: DataFrame,
    strata: Sequence[str],
    n_samples: int,
    row_id: str = "lead_id",
    seed: int | str = C.DEFAULT_SEED,
) -> DataFrame:
    """About ``n_samples`` rows: ``max(1, round(n * share))`` of every stratum."""
    share = F.lit(float(n_samples)) * F.col("n_stratum") / F.col("n_total")
    quota = F.least(F.greatest(F.lit(1.0), F.bround(share)), F.col("n_stratum"))
    parts = cut_by_quota(df, strata, row_id, [quota], f"sub{seed}")
    return parts.where(F.col("part") == 0).drop("part")


def split_summary(df: DataFrame, label: str = "converted") -> DataFrame:
    """Rows, positive rate and share of the total per split."""
    counts = df.groupBy("split").agg(
        F.count("*").alias("n"),
        r6(F.avg(F.col(label).cast("double"))).alias("positive_rate"),
    )
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "split", "n", "positive_rate", r6(F.col("n") / F.col("_total")).alias("share")
    )


def split_overlap(rows: DataFrame, split: DataFrame, key: str = "lead_id") -> DataFrame:
    """How many rows fall in each part of another split, with a total line."""
    tagged = rows.select(key).join(split.select(key, "split"), key, "left")
    counts = (
        tagged.rollup("split")
        .agg(F.count("*").alias("n"), F.grouping("split").alias("_g"))
        .select(
            F.when(F.col("_g") == 1, "total")
            .otherwise(F.coalesce("split", F.lit("none")))
            .alias("part"),
            "n",
        )
    )
    total = rows.agg(F.count("*").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "part", "n", r6(F.col("n") / F.nullif("_total", F.lit(0))).alias("share")
    )


def clean_ids(
    sentiment_test: DataFrame, model_split: DataFrame, key: str = "lead_id"
) -> DataFrame:
    """Ids in the sentiment test part that the model did not train on either."""
    model_test = model_split.where(F.col("split") == "test").select(key)
    return sentiment_test.select(key).intersect(model_test)
