"""Binary and multi-class reports, calibration, error tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.plans.ordered import quantiles


def confusion_binary(
    df: DataFrame, score: str, label: str, threshold: float = 0.5
) -> DataFrame:
    """tn, fp, fn, tp with the positive call at ``score >= threshold``."""
    y, hit = F.col(label) == 1, F.col(score) >= threshold
    return df.agg(
        F.lit(float(threshold)).alias("threshold"),
        F.count_if(~y & ~hit).alias("tn"),
        F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"),
        F.count_if(y & hit).alias("tp"),
    )


def threshold_sweep(
    df: DataFrame,
    score: str,
    label: str,
    thresholds: Sequence[float] = C.DECISION_THRESHOLDS,
) -> DataFrame:
    """Positive calls, precision and recall per threshold, all in one pass."""
    y = F.col(label) == 1
    rows = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            F.count_if(F.col(score) >= t).alias("called"),
            F.count_if(y & (F.col(score) >= t)).alias("hits"),
            F.count_if(y).alias("positives"),
            F.count("*").alias("n"),
        )
        for t in thresholds
    ]
    table = df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))

    def share(top: str, bottom: str) -> Column:
        return r6(
            F.coalesce(F.col(top) / F.nullif(F.col(bottom), F.lit(0)), F.lit(0.0))
        )

    return table.select(
        "threshold",
        F.col("called").alias("predicted_positive_n"),
        share("called", "n").alias("predicted_positive_rate"),
        share("hits", "called").alias("precision"),
        share("hits", "positives").alias("recall"),
    )


def calibration(
    df: DataFrame, score: str, label: str, bins: int = C.CALIBRATION_BINS
) -> DataFrame:
    """Mean score, positive share and rows per quantile bin.

    An edge value belongs to the lower bin. Bins are counted by their own rows;
    ``profile.histogram`` has the equal-width counts.
    """
    probs = {f"e{i}": i / bins for i in range(1, bins)}
    edges = quantiles(df, score, probs).select(F.array(*probs).alias("_edges"))
    number = sum(
        (
            (F.col(score) > F.get("_edges", F.lit(i))).cast("int")
            for i in range(bins - 1)
        ),
        F.lit(0),
    )
    return (
        df.crossJoin(F.broadcast(edges))
        .groupBy(number.alias("bin"))
        .agg(
            r6(F.avg(score)).alias("bin_mean_pred"),
            r6(F.avg(F.col(label).cast("double"))).alias("bin_frac_pos"),
            F.count("*").alias("n"),
        )
    )


def confusion_cells(
    df: DataFrame, truth: str, guess: str, groups: Sequence[str] = ()
) -> DataFrame:
    """(groups, truth, guess, n) of the pairs that occur."""
    return df.groupBy(*groups, F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(
        F.count("*").alias("n")
    )


def class_counts(cells: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, label, tp, support, called), from cells only.

    Each cell adds to the support of its true label and the calls of its guess, so
    one explode of the cell table replaces two joins.
    """
    same = F.col("truth") == F.col("guess")
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("truth").alias("label"),
            F.col("n").alias("support"),
            zero.alias("called"),
            F.when(same, F.col("n")).otherwise(zero).alias("tp"),
        ),
        F.struct(
            F.col("guess").alias("label"),
            zero.alias("support"),
            F.col("n").alias("called"),
            zero.alias("tp"),
        ),
    )
    return (
        cells.select(*groups, F.inline(sides))
        .groupBy(*groups, "label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "called", "tp")])
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def class_report(
    df: DataFrame, truth: str, guess: str, groups: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per label (zero where undefined)."""
    counts = class_counts(confusion_cells(df, truth, guess, groups), groups)
    tp = F.col("tp")
    return counts.select(
        *groups,
        "label",
        _ratio(tp, F.col("called")).alias("precision"),
        _ratio(tp, F.col("support")).alias("recall"),
        _ratio(tp * 2, F.col("called") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )


def overall_report(
    df: DataFrame, truth: str, guess: str, groups: Sequence[str] = ()
) -> DataFrame:
    """Rows, accuracy, macro and weighted scores, per group."""
    report = class_report(df, truth, guess, groups)
    n = F.sum("support")
    return report.groupBy(*groups).agg(
        n.cast("bigint").alias("n"),
        r6(F.sum("tp") / n).alias("accuracy"),
        r6(F.avg("precision")).alias("precision_macro"),
        r6(F.avg("recall")).alias("recall_macro"),
        r6(F.avg("f1")).alias("f1_macro"),
        r6(F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
    )


def rounded_report(report: DataFrame) -> DataFrame:
    return report.withColumns({c: r6(c) for c in ("precision", "recall", "f1")}).drop("tp")


def error_breakdown(
    df: DataFrame, truth: str, guess: str, language: str = "language", pairs: int = 10
) -> DataFrame:
    """Errors by language, by true label, and the most frequent confusions.

    One grouping-sets pass; its result has a row per language, label and pair.
    """
    wrong = df.where(F.col(truth) != F.col(guess)).select(
        F.col(language).alias("l"), F.col(truth).alias("t"), F.col(guess).alias("g")
    )
    sets = wrong.groupingSets(
        [[F.col("l")], [F.col("t")], [F.col("t"), F.col("g")]], "l", "t", "g"
    ).agg(F.count("*").alias("n"), F.grouping_id().alias("_id"))
    kinds = sets.select(
        F.when(F.col("_id") == 3, "by_language")
        .when(F.col("_id") == 5, "by_true_class")
        .otherwise("by_pair")
        .alias("kind"),
        F.when(F.col("_id") == 3, F.col("l"))
        .when(F.col("_id") == 5, F.col("t"))
        .otherwise(F.concat("t", F.lit("__to__"), "g"))
        .alias("key"),
        "n",
    )
    order = Window.partitionBy("kind").orderBy(F.desc("n"), "key")
    return (
        kinds.withColumn("_r", F.row_number().over(order))
        .where((F.col("kind") != "by_pair") | (F.col("_r") <= pairs))
        .drop("_r")
    )


def sample_errors(
    df: DataFrame, truth: str, guess: str, per_pair: int = 3, row_id: str = "lead_id"
) -> DataFrame:
    """First errors of each confusion by id; cut per task before the shuffle."""
    order = Window.partitionBy(truth, guess).orderBy(row_id)
    return (
        df.where(F.col(truth) != F.col(guess))
        .withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") <= per_pair)
        .drop("_r")
    )


def metric_pivot(long: DataFrame, key: str, metric: str, value: str, metrics: Sequence[str]) -> DataFrame:
    """Long (key, metric, value) to one row per key; named metrics need no scan."""
    return long.groupBy(key).pivot(metric, list(metrics)).agg(F.first(value))
