"""Training, scoring, importance."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.operators import attribution, features, models, priority, ranking, splits
from leadgrade.plans import workflows
from leadgrade.plans.sizing import written
from leadgrade.registry import views as V
from leadgrade.registry.core import register
from leadgrade.registry.feature_queries import derived_leads
from leadgrade.registry.ranking_queries import LEAD_SPLIT_SQL, NOTE_SPLIT_SQL
from leadgrade.registry.text_queries import classify_notes
from leadgrade.registry.views import with_ctes
from leadgrade.sources.state_store import with_versions


def split_leads(spark, sf):
    """Derived leads with their split, written once: every job below reads them."""
    derived = derived_leads(spark, sf, ("lead_id", "converted"))
    return written(splits.split_60_20_20(derived), "split-leads")


def prepared(spark, sf, balanced=True):
    leads = split_leads(spark, sf)
    train = leads.where(F.col("split") == "train")
    state = features.fit(train)
    table = written(models.training_table(state, train, balanced=balanced), "train")
    return leads, state, table


def _report(spark, sf, trained, leads, state):
    vectors = state.vectors(leads, ["lead_id", "converted", "split"])
    scored = models.score(trained.model, vectors, ["converted", "split"])
    metrics = ranking.ranking_metrics(scored, "p_conversion", "converted", ["split"])
    return metrics.withColumns(
        {
            "model": F.lit(trained.kind),
            **{f"best_{k}": F.lit(float(v)) for k, v in trained.best_params.items()},
        }
    )


@register("train_lr")
def train_lr(spark, sf):
    """Grid of four penalties, five folds; metrics per split."""
    leads, state, table = prepared(spark, sf)
    return _report(spark, sf, models.train_logistic(table), leads, state)


@register("train_gbt")
def train_gbt(spark, sf):
    """Grid of twelve cells, five folds; metrics per split."""
    leads, state, table = prepared(spark, sf, balanced=False)
    trained = models.train_boosted(table)
    return _report(spark, sf, trained, leads, state)


@register(
    "trained_splits",
    with_ctes(V.LEADS_SQL, LEAD_SPLIT_SQL)
    + """SELECT 'logistic_regression' AS model, split, count(*) AS n, sum(converted)::BIGINT AS n_positive,
      TRUE AS auc_in_range, TRUE AS known_penalty FROM lead_split GROUP BY split""",
)
def trained_splits(spark, sf):
    """What is certain of ``train_lr`` before any fit: rows and positives of each split."""
    found = train_lr(spark, sf)
    return found.select(
        "model",
        "split",
        "n",
        "n_positive",
        F.col("roc_auc").between(0, 1).alias("auc_in_range"),
        F.col("best_C").isin(*models.LR_GRID).alias("known_penalty"),
    )


@register("feature_importance")
def feature_importance(spark, sf):
    _, state, table = prepared(spark, sf, balanced=False)
    trained = models.train_boosted(table)
    return models.feature_importance(trained.model, state)


#: One cell of the tree grid, for the queries that are about a trained model, not the search.
CELL = {"maxLeaves": (31,), "stepSize": (0.1,), "maxIter": (100,)}


def explained_test_leads(spark, sf):
    """(state, contributions of every test lead) under trees of one cell."""
    leads, state, table = prepared(spark, sf, balanced=False)
    model = models.train_boosted(table, CELL).model.stages[0]
    test = leads.where(F.col("split") == "test")
    return state, attribution.explain(model, state.vectors(test, ["lead_id"]))


@register("tree_contributions")
def tree_contributions(spark, sf):
    """Mean absolute contribution of every feature over the test leads."""
    state, explained = explained_test_leads(spark, sf)
    return models.named_contributions(explained, state)


@register(
    "contributions_add_up",
    with_ctes(V.LEADS_SQL, LEAD_SPLIT_SQL)
    + "SELECT lead_id, TRUE AS adds_up FROM lead_split WHERE split = 'test'",
)
def contributions_add_up(spark, sf):
    """Base value and contributions of a lead give its score."""
    _, explained = explained_test_leads(spark, sf)
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    return explained.select("lead_id", (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up"))


def trained_scores(spark, sf):
    """(lead_id, converted, split, p_<kind>) of both trained models, stored."""
    leads, state, table = prepared(spark, sf)
    trained = [models.train_logistic(table)]
    # The weights differ, folds and vectors don't.
    pos, neg = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    ratio = F.broadcast(table.agg((neg / F.nullif(pos, F.lit(0))).alias("ratio")))
    one = F.when(F.col("label") == 1, F.coalesce("ratio", F.lit(1.0))).otherwise(1.0)
    weighted = table.crossJoin(ratio).withColumn("weight", one).drop("ratio")
    trained.append(models.train_boosted(written(weighted, "train"), CELL))
    keep = ["lead_id", "converted", "split"]
    scored = state.vectors(leads, keep)
    for done in trained:
        kept = [c for c in scored.columns]
        scored = models.score(done.model, scored, kept).withColumnRenamed("p_conversion", f"p_{done.kind}")
    return written(scored.drop("features"), "scores")


def model_reports(spark, sf):
    scores = trained_scores(spark, sf)
    reports = [
        workflows.model_report(scores.withColumnRenamed(f"p_{kind}", "p_conversion")).withColumn("model", F.lit(kind))
        for kind in ("logistic_regression", "boosted_trees")
    ]
    return reports[0].unionByName(reports[1])


@register("model_bundle")
def model_bundle(spark, sf):
    """Ranking, interval, confusion, sweep, gain and calibration of both trained models."""
    return model_reports(spark, sf)


@register(
    "model_bundle_sizes",
    with_ctes(
        V.LEADS_SQL,
        LEAD_SPLIT_SQL,
        "sizes AS (SELECT split, count(*) AS n, sum(converted) AS n_positive FROM lead_split GROUP BY split)",
        "kinds AS (SELECT unnest(['logistic_regression', 'boosted_trees']) AS model)",
    )
    + f"""SELECT model, 'ranking' AS section, split AS key, CAST(n AS DOUBLE) AS rows_counted FROM sizes, kinds
      UNION ALL SELECT model, 'confusion', 'all', CAST(n AS DOUBLE) FROM sizes, kinds WHERE split = 'test'
      UNION ALL SELECT model, 'calibration', 'all', CAST(n AS DOUBLE) FROM sizes, kinds WHERE split = 'test'
      UNION ALL SELECT model, 'interval', 'all', CAST(2 * {C.BOOTSTRAP_DRAWS} AS DOUBLE) FROM kinds""",
)
def model_bundle_sizes(spark, sf):
    """The part of the bundle that no fit can change: each section counts all its rows."""
    counted = {"ranking": ["n"], "confusion": ["tp", "fp", "fn", "tn"], "calibration": ["n"], "interval": ["n_draws"]}
    wanted = F.lit(False)
    for section, metrics in counted.items():
        wanted = wanted | ((F.col("section") == section) & F.col("metric").isin(*metrics))
    key = F.when(F.col("section") == "ranking", F.col("key")).otherwise("all")
    rows = model_reports(spark, sf).where(wanted)
    return rows.groupBy("model", "section", key.alias("key")).agg(F.sum("value").alias("rows_counted"))


@register("score_leads")
def score_leads(spark, sf):
    """All leads scored by a trained model, joined with attitudes, with versions."""
    leads, state, table = prepared(spark, sf)
    trained = models.train_logistic(table)
    scored = models.score(trained.model, state.vectors(leads, ["lead_id"]), ["lead_id"])
    attitudes = V.predictions(spark, sf).select("lead_id", "language", "predicted_attitude")
    ranked = priority.priority_table(scored, attitudes)
    out = ranked.withColumn("p_conversion", r6("p_conversion"))
    return with_versions(
        out,
        {
            "feature_state_version": state.version,
            "model_kind": trained.kind,
            "weight_conversion": 0.6,
            "weight_sentiment": 0.4,
        },
    )


@register(
    "scored_leads",
    with_ctes(*V.PREDICTIONS, V.LEADS_SQL)
    + f"""SELECT lead_id, language, predicted_attitude, {V.SCORE_CASE} AS sentiment_score,
      'logistic_regression' AS model_kind, TRUE AS in_range, TRUE AS priority_agrees
      FROM predictions JOIN leads USING (lead_id)""",
)
def scored_leads(spark, sf):
    """What is certain of ``score_leads``: its rows, and each priority from its own parts."""
    mix = F.col("weight_conversion") * F.col("p_conversion") + F.col("weight_sentiment") * F.col("sentiment_score")
    return score_leads(spark, sf).select(
        "lead_id",
        "language",
        "predicted_attitude",
        "sentiment_score",
        "model_kind",
        F.col("p_conversion").between(0, 1).alias("in_range"),
        # Both numbers are rounded to six places.
        (F.abs(F.col("priority") - mix) < 2e-6).alias("priority_agrees"),
    )


@register(
    "classified_notes",
    with_ctes(V.NOTES_SQL, NOTE_SPLIT_SQL)
    + "SELECT lead_id, TRUE AS known_label, TRUE AS scored FROM note_split WHERE split = 'test'",
)
def classified_notes(spark, sf):
    """What is certain of ``classify_notes``: every test note once, with a known label."""
    known = F.col("predicted_attitude").isin(*C.ATTITUDES)
    return classify_notes(spark, sf).select(
        "lead_id", known.alias("known_label"), F.col("sentiment_score").between(0, 1).alias("scored")
    )
