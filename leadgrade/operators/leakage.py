"""Leakage checks: suspect columns, cross-validated label AUC, rule flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.operators import contingency, splits
from leadgrade.operators.ranking import cumulative, roc_auc_expr
from leadgrade.plans.sizing import written


def suspect_auc(
    leads: DataFrame,
    columns: Sequence[str] = C.POST_OUTCOME_COLUMNS,
    label: str = "converted",
) -> DataFrame:
    """In-sample AUC of each column alone, missing taken as a level.

    A level's score is its positive rate. Levels with equal rates are one score; a
    level without a labelled row counts as a level but has no score.
    Absent columns are skipped. Everything after the first groupBy is sized by the
    number of levels.
    """
    present = [c for c in columns if c in leads.columns]
    y = F.col(label).cast("int")
    long = leads.select(
        y.alias("_y"),
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("Missing")).alias(c)
            for c in present
        ],
    ).unpivot(["_y"], present, "column", "level")
    levels = long.groupBy("column", "level").agg(
        F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg")
    )
    rows = F.col("pos") + F.col("neg")
    facts = levels.groupBy("column").agg(
        F.count("*").alias("n_unique"),
        F.coalesce(
            F.sum(F.when(F.col("level") == "Missing", rows)), F.lit(0)
        ).alias("n_missing"),
    )
    rate = F.col("pos") / F.nullif(rows, F.lit(0))
    scores = levels.where(rows > 0).groupBy("column", rate.alias("score")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    auc = cumulative(scores, ["column"]).groupBy("column").agg(
        F.round(roc_auc_expr(), 4).alias("auc")
    )
    return auc.join(facts, "column").select("column", "auc", "n_unique", "n_missing")


def cv_category_auc(
    df: DataFrame, column: str, label: str = "converted", k: int = 5
) -> DataFrame:
    """(auc, n_folds): mean out-of-fold AUC of one categorical column.

    A level is scored by its positive rate in the other folds; a level they do not
    hold gets their overall rate. Folds with one class are left out, as are rows
    without a label; a missing value is a level.
    """
    y = F.col(label).cast("int")
    level = F.coalesce(F.col(column).cast("string"), F.lit("Missing"))
    folded = splits.kfold(
        df.where(y.isNotNull()).select("lead_id", level.alias("level"), y.alias("_y")), ["_y"], k
    )
    cell = folded.groupBy("level", "fold").agg(
        F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg")
    )
    by_level = cell.groupBy("level").agg(
        F.sum("pos").alias("pos_l"), F.sum("neg").alias("neg_l")
    )
    by_fold = cell.groupBy("fold").agg(
        F.sum("pos").alias("pos_f"), F.sum("neg").alias("neg_f")
    )
    whole = cell.agg(F.sum("pos").alias("pos_a"), F.sum("neg").alias("neg_a"))
    full = cell.join(by_level, "level").join(by_fold, "fold").crossJoin(F.broadcast(whole))
    pos_out, neg_out = F.col("pos_l") - F.col("pos"), F.col("neg_l") - F.col("neg")
    pos_rest, neg_rest = F.col("pos_a") - F.col("pos_f"), F.col("neg_a") - F.col("neg_f")
    rate = F.coalesce(
        pos_out / F.nullif(pos_out + neg_out, F.lit(0)),
        pos_rest / F.nullif(pos_rest + neg_rest, F.lit(0)),
    )
    scores = full.groupBy("fold", rate.alias("score")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    per_fold = cumulative(scores, ["fold"]).groupBy("fold").agg(roc_auc_expr().alias("_a"))
    return per_fold.agg(
        r6(F.avg("_a")).alias("auc"), F.count("_a").alias("n_folds")
    )


def _band(value, low: float, high: float, names: tuple[str, str, str]):
    return (
        F.when(value.isNull(), "undefined")
        .when(value > high, names[2])
        .when(value < low, names[0])
        .otherwise(names[1])
    )


def leakage_flags(
    auc: DataFrame, association: DataFrame, crosstab: DataFrame, suspects: DataFrame
) -> DataFrame:
    """(rule, subject, level, value) rows from the diagnostic tables."""
    a = auc.select(
        F.lit("attitude_auc").alias("rule"),
        F.lit("attitude").alias("subject"),
        _band(F.col("auc"), C.AUC_TOO_WEAK, C.AUC_TOO_HIGH, ("weak", "healthy", "leakage")).alias(
            "level"
        ),
        F.col("auc").alias("value"),
    )
    v = association.select(
        F.lit("cramers_v").alias("rule"),
        F.lit("attitude").alias("subject"),
        _band(F.col("cramers_v"), *C.CRAMERS_V_BAND, ("low", "in_band", "too_high")).alias(
            "level"
        ),
        F.col("cramers_v").alias("value"),
    )
    one_sided = crosstab.where(
        (F.col("converted_0") == 0) | (F.col("converted_1") == 0)
    ).select(
        F.lit("one_sided_class").alias("rule"),
        F.col("attitude").alias("subject"),
        F.lit("leakage").alias("level"),
        F.least("converted_0", "converted_1").cast("double").alias("value"),
    )
    worst = (
        suspects.orderBy(F.desc("auc"), "column")
        .limit(1)
        .where(F.col("auc") > C.SUSPECT_AUC_LIMIT)
        .select(
            F.lit("suspect_column").alias("rule"),
            F.col("column").alias("subject"),
            F.lit("drop").alias("level"),
            F.col("auc").alias("value"),
        )
    )
    return a.unionByName(v).unionByName(one_sided).unionByName(worst)


def _tidy(df: DataFrame, section: str, key, metrics: Sequence[str]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in metrics
        ]
    )
    return df.select(
        F.lit(section).alias("section"), key.cast("string").alias("key"), F.inline(rows)
    )


def leakage_report(notes: DataFrame, leads: DataFrame) -> DataFrame:
    """The whole bundle as (section, key, metric, value) rows.

    ``notes`` has lead_id, text and attitude, ``leads`` the outcome and the suspects; empty
    notes are left out. The joined rows are counted once; balance, distribution,
    association and crosstab all come from those few cells. The rule flags stand in
    section ``flag``, by subject, as ``rule:level``.
    """
    joined = notes.where(F.length("text") > 0).select("lead_id", "attitude").join(
        leads.select("lead_id", "converted"), "lead_id"
    )
    # Cells, folds and suspects feed a section and the flags each, so they are stored.
    cell = written(contingency.cells(joined, "attitude", "converted"), "cells")
    whole = F.lit("all")
    folded = written(cv_category_auc(joined, "attitude"), "folds")
    suspects = written(suspect_auc(leads), "suspects")
    balance = cell.agg(
        F.sum("o").alias("n"),
        r6(F.sum(F.col("o") * F.col("col")) / F.sum("o")).alias("positive_rate"),
    )
    by_attitude = cell.groupBy("row").agg(F.sum("o").alias("n"))
    parts = [
        _tidy(balance, "balance", whole, ("n", "positive_rate")),
        _tidy(by_attitude, "attitude", F.col("row"), ("n",)),
        _tidy(
            contingency.cell_association(cell),
            "association",
            whole,
            ("chi_square", "cramers_v", "mutual_information"),
        ),
        _tidy(
            contingency.cell_crosstab(cell, "attitude", "converted"),
            "crosstab",
            F.col("attitude"),
            ("converted_0", "converted_1", "converted_0_pct", "converted_1_pct"),
        ),
        _tidy(folded, "cv", whole, ("auc",)),
        _tidy(suspects, "suspect", F.col("column"), ("auc", "n_unique", "n_missing")),
    ]
    flags = leakage_flags(
        folded,
        contingency.cell_association(cell),
        contingency.cell_crosstab(cell, "attitude", "converted"),
        suspects,
    )
    out = flags.select(
        F.lit("flag").alias("section"),
        F.col("subject").alias("key"),
        F.concat_ws(":", "rule", "level").alias("metric"),
        F.col("value").cast("double").alias("value"),
    )
    for p in parts:
        out = out.unionByName(p)
    return out
