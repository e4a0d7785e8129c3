"""Table profiling: balances, rates, missing values, audits, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6, r9
from leadgrade.plans.ordered import quantiles


def class_balance(df: DataFrame, label: str = "converted") -> DataFrame:
    """Rows, positives and positive rate in one pass."""
    y = F.col(label).cast("int")
    return df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(y), F.lit(0)).cast("bigint").alias("n_positive"),
        r6(F.avg(y.cast("double"))).alias("positive_rate"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def positive_rate_by(df: DataFrame, column: str, label: str = "converted") -> DataFrame:
    """Rows and percentage of positives (one decimal) per non-null value."""
    rate = F.avg(F.col(label).cast("double")) * 100
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"), F.round(rate, 1).alias("converted_pct"))
    )


def missing_rates(df: DataFrame, columns: Sequence[str], top: int = 15) -> DataFrame:
    """Share of nulls per column, highest first; one pass over the table."""
    rates = [
        F.struct(
            F.lit(c).alias("column"),
            r6(F.avg(F.col(c).isNull().cast("double"))).alias("missing_rate"),
        )
        for c in columns
    ]
    table = df.agg(F.array(*rates).alias("_r")).select(F.inline("_r"))
    return table.orderBy(F.desc("missing_rate"), "column").limit(top)


def placeholder_audit(
    df: DataFrame, columns: Sequence[str] = C.PLACEHOLDER_COLUMNS
) -> DataFrame:
    """Per column: placeholder rows, null rows, percentage of either."""
    rows = []
    for c in columns:
        picked = F.coalesce(F.col(c) == C.SELECT_PLACEHOLDER, F.lit(False))
        either = (picked | F.col(c).isNull()).cast("double")
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(picked).alias("n_select"),
                F.count_if(F.col(c).isNull()).alias("n_null"),
                r6(F.avg(either) * 100).alias("pct_combined"),
            )
        )
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def co_missingness(
    df: DataFrame, columns: Sequence[str] = C.BLOCK_MISSING_COLUMNS
) -> DataFrame:
    """Rows where all, and any, of the columns are null, and their ratio."""
    nulls = [F.col(c).isNull() for c in columns]
    every, some = nulls[0], nulls[0]
    for n in nulls[1:]:
        every, some = every & n, some | n
    counts = df.agg(
        F.count("*").alias("n"),
        F.count_if(every).alias("n_all_null"),
        F.count_if(some).alias("n_any_null"),
    )
    ratio = F.col("n_all_null") / F.nullif("n_any_null", F.lit(0))
    return counts.withColumn("overlap", r6(ratio))


def flag_variance(
    df: DataFrame, columns: Sequence[str] = (*C.DEAD_FLAGS, *C.CHANNEL_FLAGS)
) -> DataFrame:
    """Yes and No counts per flag and what to do with it."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c) == "Yes").alias("n_yes"),
            F.count_if(F.col(c) == "No").alias("n_no"),
        )
        for c in columns
    ]
    table = df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))
    decision = F.when(F.col("n_yes") == 0, "drop (dead)").otherwise(
        "merge into channel_diversity_count"
    )
    return table.withColumn("decision", decision)


def top_categories(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    value = F.coalesce(F.col(column), F.lit("(missing)")).alias(column)
    counts = df.groupBy(value).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal bins over [0, 1], last bin closed; empty bins are listed with zero."""
    number = F.least(F.floor(F.col(column) * bins), F.lit(bins - 1)).cast("int")
    inside = df.where(F.col(column).between(0, 1))
    counts = inside.groupBy(number.alias("bin")).agg(F.count("*").alias("_n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        r6(F.col("bin") / float(bins)).alias("lower"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"),
    )


def five_numbers(df: DataFrame, column: str, group: str) -> DataFrame:
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return quantiles(df, column, probs, [group]).select(
        group, *[r9(name).alias(name) for name in probs]
    )


def segment_stats(
    ranked: DataFrame, group: str = "predicted_attitude", label: str = "converted"
) -> DataFrame:
    """Rows, mean, median, sample deviation of priority and positive rate per group; a
    null group is a group."""
    key = F.to_json(F.struct(group))
    ranked = ranked.withColumn("_key", key)
    moments = ranked.groupBy("_key", group).agg(
        F.count("*").alias("n"),
        r6(F.avg("priority")).alias("priority_mean"),
        r6(F.stddev_samp("priority")).alias("priority_std"),
        r6(F.avg(F.col(label).cast("double"))).alias("converted_rate"),
    )
    median = quantiles(ranked, "priority", {"m": 0.5}, ["_key"]).select(
        "_key", r9("m").alias("priority_median")
    )
    return moments.join(median, "_key", "left").drop("_key")


def priority_summary(ranked: DataFrame) -> DataFrame:
    moments = ranked.agg(
        F.count("*").alias("n"),
        r6(F.avg("priority")).alias("mean"),
        r6(F.stddev_samp("priority")).alias("std"),
        r6(F.min("priority")).alias("min"),
        r6(F.max("priority")).alias("max"),
    )
    median = quantiles(ranked, "priority", {"m": 0.5}).select(r9("m").alias("median"))
    return moments.crossJoin(F.broadcast(median))


def note_failures(notes: DataFrame) -> DataFrame:
    empty = (F.length("text") == 0) | F.col("text").isNull()
    return notes.agg(
        F.count("*").alias("n"),
        F.count_if(empty).alias("n_empty"),
        r6(F.avg(empty.cast("double"))).alias("failure_rate"),
    )


def sentiment_score_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("predicted_attitude").agg(
        F.count("sentiment_score").alias("n"),
        r6(F.avg("sentiment_score")).alias("mean_score"),
    )


def class_weights(df: DataFrame, label: str = "converted") -> DataFrame:
    """neg/pos ratio (1 without positives) and balanced weights ``n / (2 n_c)``."""
    y = F.col(label).cast("int")
    counts = df.agg(
        F.count_if(y == 0).alias("n_neg"), F.count_if(y == 1).alias("n_pos")
    )
    total = (F.col("n_neg") + F.col("n_pos")).cast("double")

    def balanced(name: str):
        return r6(total / F.nullif(F.col(name) * 2, F.lit(0)))

    ratio = F.when(F.col("n_pos") > 0, F.col("n_neg") / F.nullif("n_pos", F.lit(0)))
    return counts.select(
        "n_neg",
        "n_pos",
        r6(F.coalesce(ratio, F.lit(1.0))).alias("scale_pos_weight"),
        balanced("n_neg").alias("weight_neg"),
        balanced("n_pos").alias("weight_pos"),
    )


def limit_ordered(df: DataFrame, key: str, n: int) -> DataFrame:
    """First n rows by key: a table has no file order to rely on."""
    return df.orderBy(key).limit(n)


def id_set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of ids in both, only left, only right, and whether the sets agree."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    counts = a.join(b, key, "full").agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("n_both"),
        F.count_if(F.col("_r").isNull()).alias("n_only_left"),
        F.count_if(F.col("_l").isNull()).alias("n_only_right"),
    )
    same = (F.col("n_only_left") == 0) & (F.col("n_only_right") == 0)
    return counts.withColumn("same", same)
