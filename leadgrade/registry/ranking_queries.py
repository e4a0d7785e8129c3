"""Splits, ranking metrics, reports, capture and sweeps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.functions.hashing import hash_uniform
from leadgrade.operators import (
    bootstrap,
    classification,
    models,
    notes,
    priority,
    ranking,
    splits,
)
from leadgrade.registry import views as V
from leadgrade.registry.core import register
from leadgrade.registry.profile_queries import fold_sql
from leadgrade.registry.views import with_ctes

# --- splits ---


def _quota(edge: float) -> str:
    return f"floor(CAST({edge} AS DOUBLE) * n_stratum + 0.5)"


LEAD_SPLIT_SQL = V.split_sql(
    "lead_split",
    "(SELECT lead_id, converted FROM leads)",
    "converted",
    "42",
    [("train", _quota(0.6)), ("val", _quota(0.8))],
    "test",
)
NOTE_SPLIT_SQL = V.split_sql(
    "note_split",
    "(SELECT lead_id, attitude || '_' || language AS stratum FROM notes)",
    "stratum",
    "joint42",
    [("train", _quota(0.8)), ("val", _quota(0.9))],
    "test",
)


def lead_split(spark, sf):
    return splits.split_60_20_20(V.raw_leads(spark, sf, ["lead_id", "converted"]))


def note_split(spark, sf):
    rows = V.notes(spark, sf, ("lead_id", "attitude", "language"))
    return splits.split_80_10_10(rows).select("lead_id", "stratum", "split")


register(
    "stratified_split_60_20_20",
    with_ctes(V.LEADS_SQL, LEAD_SPLIT_SQL) + "SELECT * FROM lead_split",
)(lead_split)
register(
    "stratified_split_joint",
    with_ctes(V.NOTES_SQL, NOTE_SPLIT_SQL) + "SELECT * FROM note_split",
)(note_split)


@register(
    "split_summary",
    with_ctes(V.LEADS_SQL, LEAD_SPLIT_SQL)
    + """SELECT split, count(*) AS n, round(avg(CAST(converted AS DOUBLE)), 6) AS positive_rate,
      round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lead_split), 6) AS share
      FROM lead_split GROUP BY split""",
)
def split_summary(spark, sf):
    return splits.split_summary(lead_split(spark, sf))


@register(
    "split_overlap",
    with_ctes(V.LEADS_SQL, LEAD_SPLIT_SQL, V.NOTES_SQL, NOTE_SPLIT_SQL)
    + """SELECT CASE WHEN grouping(s) = 1 THEN 'total' ELSE s END AS part, count(*) AS n,
      round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM note_split WHERE split = 'test'), 6) AS share
      FROM (SELECT coalesce(l.split, 'none') AS s FROM note_split
        LEFT JOIN lead_split l ON l.lead_id = note_split.lead_id WHERE note_split.split = 'test')
      GROUP BY ROLLUP (s)""",
)
def split_overlap(spark, sf):
    test = note_split(spark, sf).where(F.col("split") == "test")
    return splits.split_overlap(test, lead_split(spark, sf))


@register(
    "clean_intersection",
    with_ctes(V.LEADS_SQL, LEAD_SPLIT_SQL, V.NOTES_SQL, NOTE_SPLIT_SQL)
    + """SELECT lead_id FROM note_split WHERE split = 'test'
      INTERSECT SELECT lead_id FROM lead_split WHERE split = 'test'""",
)
def clean_intersection(spark, sf):
    test = note_split(spark, sf).where(F.col("split") == "test")
    return splits.clean_ids(test, lead_split(spark, sf))


@register(
    "stratified_subsample",
    with_ctes(V.NOTES_SQL)
    + f"""SELECT lead_id, attitude FROM (
      SELECT *, row_number() OVER (PARTITION BY attitude ORDER BY {V.u_sql('lead_id', 'sub42')}, lead_id) AS r,
        count(*) OVER (PARTITION BY attitude) AS n, count(*) OVER () AS total
      FROM (SELECT lead_id, attitude FROM notes))
      WHERE r <= greatest(1, round_even(CAST(200 AS DOUBLE) * n / total, 0))""",
)
def stratified_subsample(spark, sf):
    rows = V.notes(spark, sf, ("lead_id", "attitude"))
    return splits.stratified_subsample(rows, ["attitude"], 200)


@register(
    "kfold_assignment",
    with_ctes(V.LEADS_SQL, fold_sql("(SELECT lead_id, converted FROM leads)", "converted"))
    + "SELECT * FROM folded",
)
def kfold_assignment(spark, sf):
    return splits.kfold(V.raw_leads(spark, sf, ["lead_id", "converted"]), ["converted"])


# --- ranking metrics ---

CURVE_SQL = """
per_score AS (
  SELECT p_conversion AS score, CAST(sum(converted) AS DOUBLE) AS pos,
    CAST(sum(1 - converted) AS DOUBLE) AS neg FROM scored GROUP BY p_conversion),
curve AS (
  SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn
  FROM per_score WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""
CURVE = (*V.SCORED, CURVE_SQL)


@register(
    "roc_auc",
    with_ctes(*CURVE)
    + """SELECT CAST(max(tp + tn) AS BIGINT) AS n, CAST(max(tp) AS BIGINT) AS n_positive,
      round(sum(neg * (cum_pos - pos / 2)) / (max(tp) * max(tn)), 6) AS roc_auc FROM curve""",
)
def roc_auc(spark, sf):
    out = ranking.ranking_metrics(V.scored(spark, sf), "p_conversion", "converted")
    return out.select("n", "n_positive", "roc_auc")


@register(
    "average_precision",
    with_ctes(*CURVE)
    + """SELECT round(sum(pos * cum_pos / (cum_pos + cum_neg)) / max(tp), 6) AS average_precision FROM curve""",
)
def average_precision(spark, sf):
    out = ranking.ranking_metrics(V.scored(spark, sf), "p_conversion", "converted")
    return out.select("average_precision")


@register(
    "roc_curve",
    with_ctes(*CURVE)
    + "SELECT score AS threshold, round(cum_neg / tn, 6) AS fpr, round(cum_pos / tp, 6) AS tpr FROM curve",
)
def roc_curve(spark, sf):
    return ranking.roc_points(V.scored(spark, sf), "p_conversion", "converted")


@register(
    "pr_curve",
    with_ctes(*CURVE)
    + """SELECT score AS threshold, round(cum_pos / (cum_pos + cum_neg), 6) AS precision,
      round(cum_pos / tp, 6) AS recall FROM curve""",
)
def pr_curve(spark, sf):
    return ranking.pr_points(V.scored(spark, sf), "p_conversion", "converted")


RANK_SQL = f"""
by_rank AS (
  SELECT lead_id, p_conversion, converted, row_number() OVER w AS rank,
    sum(converted) OVER (w ROWS UNBOUNDED PRECEDING) AS cum_positive,
    count(*) OVER () AS n, sum(converted) OVER () AS positives
  FROM scored WINDOW w AS (ORDER BY p_conversion DESC, {V.u_sql('lead_id', 'tie')}, lead_id))"""


@register(
    "rank_by_score",
    with_ctes(*V.SCORED, RANK_SQL) + "SELECT lead_id, p_conversion, rank FROM by_rank",
)
def rank_by_score(spark, sf):
    rows = V.scored(spark, sf).select("lead_id", "p_conversion")
    return ranking.rank_rows(rows, "p_conversion")


@register(
    "gain_curve",
    with_ctes(*V.SCORED, RANK_SQL)
    + """SELECT rank, round(CAST(rank AS DOUBLE) / n, 6) AS fraction,
      round(CAST(cum_positive AS DOUBLE) / positives, 6) AS gain FROM by_rank""",
)
def gain_curve(spark, sf):
    return ranking.gain_curve(V.scored(spark, sf), "p_conversion", "converted")


@register(
    "gain_at_fraction",
    with_ctes(*V.SCORED, RANK_SQL)
    + " UNION ALL ".join(
        f"""SELECT CAST({f} AS DOUBLE) AS fraction, CAST(ceil(CAST({f} AS DOUBLE) * max(n)) AS BIGINT) AS k,
        round(CAST(sum(converted) FILTER (WHERE rank <= ceil(CAST({f} AS DOUBLE) * n)) AS DOUBLE)
          / max(positives), 6) AS gain FROM by_rank"""
        for f in C.GAIN_FRACTIONS
    ),
)
def gain_at_fraction(spark, sf):
    return ranking.gain_at_fraction(V.scored(spark, sf), "p_conversion", "converted")


@register(
    "confusion_binary",
    with_ctes(*V.SCORED)
    + """SELECT CAST(0.5 AS DOUBLE) AS threshold,
      count(*) FILTER (WHERE converted = 0 AND p_conversion < 0.5) AS tn,
      count(*) FILTER (WHERE converted = 0 AND p_conversion >= 0.5) AS fp,
      count(*) FILTER (WHERE converted = 1 AND p_conversion < 0.5) AS fn,
      count(*) FILTER (WHERE converted = 1 AND p_conversion >= 0.5) AS tp FROM scored""",
)
def confusion_binary(spark, sf):
    return classification.confusion_binary(V.scored(spark, sf), "p_conversion", "converted")


@register(
    "threshold_sweep",
    with_ctes(*V.SCORED)
    + """SELECT threshold, called AS predicted_positive_n,
      round(CAST(called AS DOUBLE) / n, 6) AS predicted_positive_rate,
      round(coalesce(CAST(hits AS DOUBLE) / nullif(called, 0), 0), 6) AS precision,
      round(coalesce(CAST(hits AS DOUBLE) / nullif(positives, 0), 0), 6) AS recall
      FROM (SELECT threshold, count(*) FILTER (WHERE p_conversion >= threshold) AS called,
          count(*) FILTER (WHERE p_conversion >= threshold AND converted = 1) AS hits,
          count(*) FILTER (WHERE converted = 1) AS positives, count(*) AS n
        FROM scored, (SELECT CAST(unnest([0.3, 0.4, 0.5, 0.6, 0.7]) AS DOUBLE) AS threshold)
        GROUP BY threshold)""",
)
def threshold_sweep(spark, sf):
    return classification.threshold_sweep(V.scored(spark, sf), "p_conversion", "converted")


_EDGES = ", ".join(f"quantile_cont(p_conversion, {i / 10}) AS e{i}" for i in range(1, 10))
_BIN = " + ".join(f"CAST(p_conversion > e{i} AS INTEGER)" for i in range(1, 10))


@register(
    "calibration_quantile",
    with_ctes(*V.SCORED)
    + f"""SELECT {_BIN} AS bin, round(avg(p_conversion), 6) AS bin_mean_pred,
      round(avg(CAST(converted AS DOUBLE)), 6) AS bin_frac_pos, count(*) AS n
      FROM scored, (SELECT {_EDGES} FROM scored) GROUP BY 1""",
)
def calibration_quantile(spark, sf):
    return classification.calibration(V.scored(spark, sf), "p_conversion", "converted")


# --- clean subset: capture and sweeps ---

CLEAN_SQL = """
clean AS (
  SELECT ranked.* FROM ranked JOIN lead_split ON lead_split.lead_id = ranked.lead_id
  WHERE split = 'test')"""
CLEAN = (*V.PRIORITY, LEAD_SPLIT_SQL, CLEAN_SQL)


def clean_rows(spark, sf):
    """Priority rows of the leads no model was trained on.

    The split column is computed on the scored leads themselves, which costs no
    join on the id.
    """
    parts = splits.split_60_20_20(V.scored(spark, sf))
    test = parts.where(F.col("split") == "test").drop("split")
    pred = V.predictions(spark, sf).select(
        "lead_id", "language", "true_attitude", "predicted_attitude"
    )
    return priority.priority_table(test, pred)


@register(
    "topn_capture_clean",
    with_ctes(*CLEAN)
    + " UNION ALL ".join(
        f"""SELECT {n} AS n, CAST(count(*) AS INTEGER) AS actual_n, CAST(sum(converted) AS INTEGER) AS captured,
        round(avg(CAST(converted AS DOUBLE)), 6) AS capture_rate, round(max(base), 6) AS base_rate,
        round(avg(CAST(converted AS DOUBLE)) / max(base), 6) AS lift
        FROM (SELECT *, (SELECT avg(CAST(converted AS DOUBLE)) FROM clean) AS base
              FROM clean ORDER BY priority DESC, lead_id LIMIT {n})"""
        for n in C.CAPTURE_SIZES
    ),
)
def topn_capture_clean(spark, sf):
    return priority.top_n_capture(clean_rows(spark, sf))


_W = ", ".join(
    f"(CAST({w!r} AS DOUBLE), CAST({1.0 - w!r} AS DOUBLE))" for w in C.WEIGHT_GRID
)


@register(
    "weight_sweep",
    with_ctes(*CLEAN)
    + f"""SELECT w_conv, round(w_sent, 6) AS w_sent, count(*) AS actual_n, CAST(sum(converted) AS BIGINT) AS captured,
      round(avg(CAST(converted AS DOUBLE)), 6) AS capture_rate,
      round(avg(CAST(converted AS DOUBLE)) / (SELECT avg(CAST(converted AS DOUBLE)) FROM clean), 6) AS lift
      FROM (SELECT *, row_number() OVER (PARTITION BY w_conv
              ORDER BY w_conv * p_conversion + w_sent * sentiment_score DESC, lead_id) AS r
            FROM clean, (VALUES {_W}) AS w(w_conv, w_sent)) WHERE r <= 50 GROUP BY w_conv, w_sent""",
)
def weight_sweep(spark, sf):
    return priority.weight_sweep(clean_rows(spark, sf))


@register(
    "top20_clean",
    with_ctes(*CLEAN)
    + """SELECT lead_id, language, predicted_attitude, p_conversion, priority, converted FROM clean
      ORDER BY priority DESC, lead_id LIMIT 20""",
)
def top20_clean(spark, sf):
    return priority.top_leads(clean_rows(spark, sf), 20).select(
        "lead_id", "language", "predicted_attitude", "p_conversion", "priority", "converted"
    )


# --- multi-class reports ---


@register(
    "confusion_multiclass",
    with_ctes(*V.PREDICTIONS)
    + """SELECT true_attitude AS truth, predicted_attitude AS guess, count(*) AS n
      FROM predictions GROUP BY ALL""",
)
def confusion_multiclass(spark, sf):
    """Notes joined to their predictions under differing column names."""
    truth = V.notes(spark, sf, ("lead_id", "attitude"))
    guess = V.predictions(spark, sf).select("lead_id", "predicted_attitude")
    joined = truth.join(guess, "lead_id")
    return classification.confusion_cells(joined, "attitude", "predicted_attitude")


def report_sql(groups: str = "") -> str:
    g = f"{groups}, " if groups else ""
    return f"""
report AS (
  SELECT {g}label, coalesce(CAST(sum(tp) AS DOUBLE) / nullif(sum(called), 0), 0) AS precision,
    coalesce(CAST(sum(tp) AS DOUBLE) / nullif(sum(support), 0), 0) AS recall,
    coalesce(2.0 * CAST(sum(tp) AS DOUBLE) / nullif(sum(called) + sum(support), 0), 0) AS f1,
    CAST(sum(support) AS BIGINT) AS support, CAST(sum(tp) AS BIGINT) AS tp
  FROM (SELECT {g}true_attitude AS label, 1 AS support, 0 AS called,
          CAST(true_attitude = predicted_attitude AS INTEGER) AS tp FROM predictions
        UNION ALL SELECT {g}predicted_attitude, 0, 1, 0 FROM predictions) GROUP BY {g}label)"""


@register(
    "class_report",
    with_ctes(*V.PREDICTIONS, report_sql())
    + """SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1, support FROM report""",
)
def class_report(spark, sf):
    pred = V.predictions(spark, sf)
    return classification.rounded_report(
        classification.class_report(pred, "true_attitude", "predicted_attitude")
    )


@register(
    "class_report_by_language",
    with_ctes(*V.PREDICTIONS, report_sql("language"))
    + """SELECT language, CAST(sum(support) AS BIGINT) AS n,
      round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS accuracy,
      round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
      round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted
      FROM report GROUP BY language""",
)
def class_report_by_language(spark, sf):
    pred = V.predictions(spark, sf)
    return classification.overall_report(
        pred, "true_attitude", "predicted_attitude", ["language"]
    )


@register(
    "metric_pivot",
    with_ctes(*V.PREDICTIONS, report_sql())
    + """SELECT label, round(max(precision), 6) AS precision, round(max(recall), 6) AS recall,
      round(max(f1), 6) AS f1 FROM report GROUP BY label
      UNION ALL SELECT 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6)
      FROM report""",
)
def metric_pivot(spark, sf):
    """Per-class and macro rows stacked long, then pivoted wide."""
    pred = V.predictions(spark, sf)
    metrics = ["precision", "recall", "f1"]
    report = classification.class_report(pred, "true_attitude", "predicted_attitude")
    macro = report.agg(*[F.avg(m).alias(m) for m in metrics]).withColumn(
        "label", F.lit("macro")
    )
    both = report.select("label", *metrics).unionByName(macro)
    long = both.select("label", *[r6(m).alias(m) for m in metrics]).unpivot(
        ["label"], metrics, "metric", "value"
    )
    return classification.metric_pivot(long, "label", "metric", "value", metrics)


@register(
    "error_breakdown",
    with_ctes(*V.PREDICTIONS, "wrong AS (SELECT * FROM predictions WHERE true_attitude <> predicted_attitude)")
    + """SELECT 'by_language' AS kind, language AS key, count(*) AS n FROM wrong GROUP BY language
      UNION ALL SELECT 'by_true_class', true_attitude, count(*) FROM wrong GROUP BY true_attitude
      UNION ALL SELECT * FROM (SELECT 'by_pair', true_attitude || '__to__' || predicted_attitude AS key,
        count(*) AS n FROM wrong GROUP BY true_attitude, predicted_attitude ORDER BY n DESC, key LIMIT 10)""",
)
def error_breakdown(spark, sf):
    return classification.error_breakdown(
        V.predictions(spark, sf), "true_attitude", "predicted_attitude"
    )


@register(
    "sample_errors",
    with_ctes(*V.PREDICTIONS)
    + """SELECT lead_id, language, true_attitude, predicted_attitude FROM (
      SELECT *, row_number() OVER (PARTITION BY true_attitude, predicted_attitude ORDER BY lead_id) AS r
      FROM predictions WHERE true_attitude <> predicted_attitude) WHERE r <= 3""",
)
def sample_errors(spark, sf):
    pred = V.predictions(spark, sf).select(
        "lead_id", "language", "true_attitude", "predicted_attitude"
    )
    return classification.sample_errors(pred, "true_attitude", "predicted_attitude")


# --- two models side by side, bootstrap ---


def two_models(spark, sf):
    """The fixed formula and a noisier one, for comparisons."""
    noise = hash_uniform(F.col("lead_id"), "alt")
    mixed = F.lit(0.7) * F.col("p_conversion") + F.lit(0.3) * noise
    return V.scored(spark, sf).withColumn("p_other", F.round(mixed, 6))


@register(
    "model_metrics",
    with_ctes(
        *V.SCORED,
        LEAD_SPLIT_SQL,
        f"""both_models AS (
          SELECT 'formula' AS model, split, s.converted, p_conversion FROM scored s JOIN lead_split USING (lead_id)
          UNION ALL SELECT 'noisy', split, s.converted, round(CAST(0.7 AS DOUBLE) * p_conversion
            + CAST(0.3 AS DOUBLE) * {V.u_sql('lead_id', 'alt')}, 6)
          FROM scored s JOIN lead_split USING (lead_id))""",
        """per_score AS (
          SELECT model, split, p_conversion AS score, CAST(sum(converted) AS DOUBLE) AS pos,
            CAST(sum(1 - converted) AS DOUBLE) AS neg FROM both_models GROUP BY 1, 2, 3)""",
        """curve AS (
          SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg FROM per_score
          WINDOW w AS (PARTITION BY model, split ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""",
        "wide AS (SELECT model, split, sum(pos + neg) AS n, "
        "round(sum(neg * (cum_pos - pos / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc, "
        "round(sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos), 6) AS average_precision, "
        + ", ".join(
            f"round(coalesce(sum(pos) FILTER (WHERE score >= {t}) / nullif(sum(pos + neg) FILTER (WHERE score >= {t}), 0), 0), 6)"
            f" AS precision_at_{str(t).replace('.', '_')}, "
            f"round(coalesce(sum(pos) FILTER (WHERE score >= {t}) / sum(pos), 0), 6)"
            f" AS recall_at_{str(t).replace('.', '_')}"
            for t in C.DECISION_THRESHOLDS
        )
        + " FROM curve GROUP BY model, split)",
    )
    + 'SELECT model, split, metric, "value" FROM (UNPIVOT wide ON COLUMNS(* EXCLUDE (model, split)) INTO NAME metric VALUE "value")',
)
def model_metrics(spark, sf):
    both = splits.split_60_20_20(two_models(spark, sf))
    one = both.select(
        F.lit("formula").alias("model"), "split", "converted", "p_conversion"
    )
    two = both.select(
        F.lit("noisy").alias("model"),
        "split",
        "converted",
        F.col("p_other").alias("p_conversion"),
    )
    return models.model_metrics(one.unionByName(two))


# The draws in SQL: the same whole-number steps in 128-bit arithmetic.


def _step_sql(name: str, source: str, x: str, keep: str) -> str:
    """CTEs that mix ``x`` of ``source`` into a column ``name``, one step each."""
    out, at = [], source
    for i, (shift, factor) in enumerate(bootstrap.MIX):
        inner = x if i == 0 else f"{name}_{i - 1}"
        out.append(
            f"{name}{i} AS (SELECT {keep}, ((xor(v, v >> {shift}) * CAST({factor} AS HUGEINT)) % 4294967296)::BIGINT"
            f" AS {name}_{i} FROM (SELECT {keep}, {inner} AS v FROM {at}))"
        )
        at = f"{name}{i}"
    return ", ".join(out)


def draw_sql(cells: str, keep: str, draws: int = C.BOOTSTRAP_DRAWS, seed: int = C.DEFAULT_SEED) -> str:
    """CTEs ending in drawn(<keep>, kind, replicate, drawn): a Poisson count for each row
    (key, kind, n, <keep>) of ``cells`` with n above zero, and every replicate."""
    start = seed * bootstrap.STEP % (1 << 32)
    own = f"{keep}, key, kind, n"
    mixes = [
        f"replicates AS (SELECT range AS replicate, ((range + {start}) % 4294967296)::BIGINT AS x FROM range({draws}))",
        _step_sql("ra", "replicates", "x", "replicate"),
        f"crossed AS MATERIALIZED (SELECT {own}, replicate, ra_2 AS turn, "
        f"xor(xor(key & 4294967295, kind * {bootstrap.KIND}), ra_2) AS x FROM {cells}, ra2 WHERE n > 0)",
        _step_sql("da", "crossed", "x", f"{own}, replicate, turn"),
        f"halves AS MATERIALIZED (SELECT {own}, replicate, xor(((key >> 32) + da_2) & 4294967295, "
        f"((turn * CAST({bootstrap.STEP} AS HUGEINT)) % 4294967296)::BIGINT) AS x FROM da2)",
        _step_sql("db", "halves", "x", f"{own}, replicate"),
        f"""tables AS MATERIALIZED (
          SELECT n, list(p ORDER BY k) AS steps FROM (
            SELECT n, k, sum(exp(k * ln(n) - n - lgamma(k + 1))) OVER (PARTITION BY n ORDER BY k ROWS UNBOUNDED PRECEDING) AS p
            FROM (SELECT n, unnest(range(n + CAST(floor(12 * sqrt(n)) AS BIGINT) + 21)) AS k
              FROM (SELECT DISTINCT n FROM {cells} WHERE n > 0)))
          GROUP BY n)""",
        f"""drawn AS MATERIALIZED (
          SELECT {keep}, kind, replicate,
            len(list_filter(steps, lambda p: p <= (db_2 + CAST(0.5 AS DOUBLE)) / 4294967296)) AS drawn
          FROM db2 JOIN tables USING (n))""",
    ]
    return ", ".join(mixes)


def _score_key(columns: list[str]) -> Column:
    """Key of scores with at most six decimals, the same in any SQL engine."""
    parts = [F.round(F.col(c) * 1000000).cast("bigint").cast("string") for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def _score_key_sql(columns: list[str]) -> str:
    parts = " || ':' || ".join(f"CAST(CAST(round({c} * 1000000) AS BIGINT) AS VARCHAR)" for c in columns)
    return f"CAST('0x' || substr(md5({parts}), 1, 15) AS BIGINT)"


def _interval_sql(metric: str, source: str) -> str:
    half = C.CONFIDENCE_ALPHA / 2
    return (
        f"SELECT '{metric}' AS metric, round(quantile_cont({metric}, {half}), 6) AS lower, "
        f"round(quantile_cont({metric}, {1 - half}), 6) AS upper, round(avg({metric}), 6) AS mean, "
        f"count({metric}) AS n_draws FROM {source}"
    )


_KINDS = "(VALUES (0, 1), (1, 0)) AS k(kind, wanted)"
_WIDE = """sum(CASE WHEN kind = 0 THEN drawn ELSE 0 END) AS pos,
            sum(CASE WHEN kind = 1 THEN drawn ELSE 0 END) AS neg"""


@register(
    "bootstrap_ci",
    with_ctes(
        *V.SCORED,
        f"""cells AS MATERIALIZED (
          SELECT p_conversion AS score, {_score_key_sql(["p_conversion"])} AS key, kind,
            count(*) FILTER (WHERE converted = wanted) AS n
          FROM scored, {_KINDS} WHERE converted IS NOT NULL AND p_conversion IS NOT NULL GROUP BY 1, 2, 3)""",
        draw_sql("cells", "score"),
        f"""per_score AS (SELECT replicate, score, {_WIDE} FROM drawn GROUP BY 1, 2)""",
        """curve AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg FROM per_score
          WINDOW w AS (PARTITION BY replicate ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""",
        """metrics AS (
          SELECT replicate,
            sum(neg * (cum_pos - CAST(pos AS DOUBLE) / 2)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS roc_auc,
            CASE WHEN sum(neg) > 0 THEN sum(CAST(pos AS DOUBLE) * cum_pos / greatest(cum_pos + cum_neg, 1)) / nullif(sum(pos), 0) END
              AS average_precision
          FROM curve GROUP BY replicate)""",
    )
    + _interval_sql("roc_auc", "metrics")
    + " UNION ALL "
    + _interval_sql("average_precision", "metrics"),
)
def bootstrap_ci(spark, sf):
    key = _score_key(["score"])
    return bootstrap.bootstrap_ci(V.scored(spark, sf), "p_conversion", "converted", key=key)


def _side_sql(name: str, score: str) -> str:
    return f"""per_{name} AS (SELECT replicate, {score} AS score, {_WIDE} FROM drawn GROUP BY 1, 2),
        {name} AS (
          SELECT replicate, sum(neg * (cum_pos - CAST(pos AS DOUBLE) / 2)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS auc
          FROM (SELECT *, sum(pos) OVER (PARTITION BY replicate ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos FROM per_{name})
          GROUP BY replicate)"""


@register(
    "paired_bootstrap",
    with_ctes(
        *V.SCORED,
        f"""both_scores AS (
          SELECT p_conversion AS b, converted, round(CAST(0.7 AS DOUBLE) * p_conversion
            + CAST(0.3 AS DOUBLE) * {V.u_sql('lead_id', 'alt')}, 6) AS a FROM scored)""",
        f"""cells AS MATERIALIZED (
          SELECT a, b, {_score_key_sql(["a", "b"])} AS key, kind,
            count(*) FILTER (WHERE converted = wanted) AS n
          FROM both_scores, {_KINDS} WHERE converted IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2, 3, 4)""",
        draw_sql("cells", "a, b"),
        _side_sql("side_a", "a"),
        _side_sql("side_b", "b"),
        "metrics AS (SELECT side_b.auc - side_a.auc AS auc_difference FROM side_a JOIN side_b USING (replicate))",
        f"result AS ({_interval_sql('auc_difference', 'metrics')})",
    )
    + "SELECT *, lower > 0 OR upper < 0 AS significant FROM result",
)
def paired_bootstrap(spark, sf):
    return bootstrap.paired_bootstrap(
        two_models(spark, sf), "p_other", "p_conversion", "converted", key=_score_key(["a", "b"])
    )


_CODES = "list_position([" + ", ".join(f"'{a}'" for a in C.ATTITUDES) + "], {})"


@register(
    "bootstrap_f1",
    with_ctes(
        *V.PREDICTIONS,
        f"""cells AS MATERIALIZED (
          SELECT coalesce({_CODES.format("true_attitude")} - 1, {len(C.ATTITUDES)}) AS t,
            coalesce({_CODES.format("predicted_attitude")} - 1, {len(C.ATTITUDES)}) AS g,
            CAST(0 AS BIGINT) AS kind, count(*) AS n,
            CAST(t * {len(C.ATTITUDES) + 1} + g AS BIGINT) AS key
          FROM predictions GROUP BY 1, 2)""",
        draw_sql("cells", "t, g"),
        """ends AS (
          SELECT replicate, t AS label, drawn, t = g AS hit FROM drawn UNION ALL SELECT replicate, g, drawn, false FROM drawn),
        f1 AS (
          SELECT replicate, label, CAST(2 * sum(drawn) FILTER (WHERE hit) AS DOUBLE) / sum(drawn) AS f1 FROM ends
          WHERE label < """
        + str(len(C.ATTITUDES))
        + """ GROUP BY 1, 2 HAVING sum(drawn) > 0),
        metrics AS (SELECT replicate, avg(coalesce(f1, 0)) AS f1_macro FROM f1 GROUP BY replicate)""",
    )
    + _interval_sql("f1_macro", "metrics"),
)
def bootstrap_f1(spark, sf):
    return bootstrap.bootstrap_f1(
        V.predictions(spark, sf), "true_attitude", "predicted_attitude"
    )


@register(
    "latest_note_per_lead",
    """SELECT conv_id, turn, role, length(text) AS n_chars, md5(text) AS text_md5 FROM (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations)
      WHERE r = 1""",
)
def latest_note_per_lead(spark, sf):
    turns = V.table(spark, sf, "conversations")
    newest = notes.latest_note(turns, "conv_id", F.col("turn"), "turn", "role", "text")
    return newest.select(
        "conv_id",
        "turn",
        "role",
        F.length("text").cast("bigint").alias("n_chars"),
        F.md5("text").alias("text_md5"),
    )
