"""The jobs a user runs end to end, on raw lead and note tables.

Each one reads and writes tables under the given paths, so it can be stopped and
run again, and the next one starts from what is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.operators import (
    bootstrap,
    classification,
    features,
    leakage,
    models,
    priority,
    ranking,
    splits,
)
from leadgrade.operators.derive import derive_features
from leadgrade.operators.features import FeatureState
from leadgrade.plans.sizing import work_dir
from leadgrade.sources import sinks, state_store
from leadgrade.sources.schema import PREDICTION_SCHEMA


def split_leads(leads: DataFrame, path: str) -> DataFrame:
    """Derive features, split 60/20/20 by outcome, store; every later job reads this."""
    derived = derive_features(leads, ["lead_id", "converted"])
    splits.split_60_20_20(derived).write.mode("overwrite").parquet(path)
    return leads.sparkSession.read.parquet(path)


def fit_features(stored: DataFrame, path: str) -> FeatureState:
    """Fit the feature state on the training part and save it."""
    state = features.fit(stored.where(F.col("split") == "train"))
    state_store.save_state(state, path)
    return state_store.load_state(stored.sparkSession, path)


def _tidy(df: DataFrame, section: str, key: Sequence[str]) -> DataFrame:
    """Any small report frame as (section, key, metric, value)."""
    values = [c for c in df.columns if c not in key]
    label = F.concat_ws("/", *[F.col(k).cast("string") for k in key]) if key else F.lit("all")
    return df.select(
        F.lit(section).alias("section"),
        label.alias("key"),
        *[F.col(c).cast("double").alias(c) for c in values],
    ).unpivot(["section", "key"], values, "metric", "value")


def model_report(
    scored: DataFrame, label: str = "converted", draws: int = C.BOOTSTRAP_DRAWS
) -> DataFrame:
    """All metrics of one model from (split, label, p_conversion) rows.

    Ranking metrics for every split; intervals, confusion, thresholds, gain and
    calibration for the test part.
    """
    p = "p_conversion"
    test = scored.where(F.col("split") == "test")
    by_split = ranking.ranking_metrics(scored, p, label, ["split"])
    parts = [
        _tidy(by_split, "ranking", ["split"]),
        _tidy(bootstrap.bootstrap_ci(test, p, label, draws), "interval", ["metric"]),
        _tidy(
            classification.confusion_binary(test, p, label), "confusion", ["threshold"]
        ),
        _tidy(classification.threshold_sweep(test, p, label), "sweep", ["threshold"]),
        _tidy(ranking.gain_at_fraction(test, p, label), "gain", ["fraction"]),
        _tidy(classification.calibration(test, p, label), "calibration", ["bin"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def train_and_report(
    stored: DataFrame,
    state: FeatureState,
    path: str,
    lr_grid: Sequence[float] = models.LR_GRID,
    tree_grid: Mapping[str, Sequence[float]] = models.GBT_GRID,
    draws: int = C.BOOTSTRAP_DRAWS,
    k: int = 5,
) -> DataFrame:
    """Train both models on the training part, save them, write their report.

    The two score columns of one row stay together, so the paired interval sees
    both models on the same resample.
    """
    spark = stored.sparkSession
    train = stored.where(F.col("split") == "train")
    names = [r["name"] for r in state.catalog().orderBy("block", "major", "slot").collect()]
    vectors_path = f"{path}/vectors"
    keep = ["lead_id", "converted", "split"]
    state.vectors(stored, keep).write.mode("overwrite").parquet(vectors_path)
    scored = spark.read.parquet(vectors_path)
    trained = []
    for balanced, fit in (
        (True, lambda t: models.train_logistic(t, lr_grid, k)),
        (False, lambda t: models.train_boosted(t, tree_grid, k)),
    ):
        table_path = f"{path}/training_{'balanced' if balanced else 'ratio'}"
        models.training_table(state, train, k=k, balanced=balanced).write.mode(
            "overwrite"
        ).parquet(table_path)
        done = fit(spark.read.parquet(table_path))
        state_store.save_model(
            spark, done.model, done.kind, features.safe_names(names), f"{path}/{done.kind}"
        )
        trained.append(done)
    for done in trained:
        kept = [c for c in scored.columns]
        scored = models.score(done.model, scored, kept).withColumnRenamed(
            "p_conversion", f"p_{done.kind}"
        )
    columns = [f"p_{done.kind}" for done in trained]
    scored.drop("features").write.mode("overwrite").parquet(f"{path}/scores")
    scores = spark.read.parquet(f"{path}/scores")
    reports = [
        model_report(scores.withColumnRenamed(c, "p_conversion"), draws=draws).withColumn(
            "model", F.lit(done.kind)
        )
        for c, done in zip(columns, trained, strict=True)
    ]
    test = scores.where(F.col("split") == "test")
    paired = bootstrap.paired_bootstrap(test, columns[0], columns[1], "converted", draws)
    best = [
        (done.kind, "best_params", "search", name, float(value))
        for done in trained
        for name, value in {**done.best_params, "cv_roc_auc": done.cv_auc}.items()
    ]
    chosen = spark.createDataFrame(
        best, "model string, section string, key string, metric string, value double"
    )
    report = (
        reports[0]
        .unionByName(reports[1])
        .unionByName(
            _tidy(paired, "trees_minus_logistic", ["metric"]).withColumn("model", F.lit("both"))
        )
        .unionByName(chosen)
    )
    sinks.write_report(report, f"{path}/report")
    return spark.read.schema(report.schema).json(f"{path}/report")


def rank_leads(
    leads: DataFrame,
    predictions: DataFrame,
    state: FeatureState,
    model_path: str,
    path: str,
    weight_conversion: float | None = None,
    weight_sentiment: float | None = None,
) -> DataFrame:
    """Score every lead that has an attitude and store the ranked table.

    Fails before any scoring when too few predictions find their lead. The stored
    table is range-sorted by priority, so a floor or a top list reads few files.
    """
    spark = leads.sparkSession
    model = state_store.load_model(spark, model_path)
    meta = state_store.model_meta(spark, model_path)
    priority.require_overlap(leads, predictions)
    pred = predictions.select("lead_id", "language", "predicted_attitude")
    # Only leads with an attitude are ranked, so no other is scored.
    wanted = leads.join(pred.select("lead_id"), "lead_id", "left_semi")
    derived = derive_features(wanted, ["lead_id"])
    scored = models.score(model, state.vectors(derived, ["lead_id"]), ["lead_id"])
    ranked = priority.checked_priority(
        scored.join(pred, "lead_id"), weight_conversion, weight_sentiment
    )
    w_c, w_s = priority.resolve_weights(weight_conversion, weight_sentiment)
    out = state_store.with_versions(
        ranked.withColumns({c: r6(c) for c in ("p_conversion", "priority")}),
        {
            "feature_state_version": state.version,
            "model_kind": meta["kind"],
            "model_version": meta["version"],
            "weight_conversion": w_c,
            "weight_sentiment": w_s,
        },
    )
    out.orderBy(F.desc("priority"), "lead_id").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def evaluate_notes(
    notes: DataFrame,
    classify: Callable[[DataFrame], DataFrame],
    path: str,
    limit: int | None = None,
    force_refresh: bool = False,
    batch_rows: int | None = None,
) -> DataFrame:
    """Classify the test part of the notes, resuming from what is stored.

    ``classify`` adds ``predicted_attitude``, ``model_name`` and the token and
    latency columns. With ``batch_rows`` the pending notes are first written out in
    hash batches of about that size; each batch reads only its own files and is
    committed before the next starts.
    """
    spark = notes.sparkSession
    parts = splits.split_80_10_10(notes)
    test = parts.where(F.col("split") == "test").withColumn(
        "lead_id", F.col("lead_id").cast("string")
    )
    if limit is not None:
        test = test.orderBy("lead_id").limit(limit)
    if force_refresh:
        none = spark.createDataFrame([], PREDICTION_SCHEMA)
        sinks.append_predictions(spark, none, path, force_refresh=True)
    todo = sinks.pending(test, sinks.stored_predictions(spark, path)).withColumnRenamed(
        "attitude", "true_attitude"
    )
    if not batch_rows:
        sinks.append_predictions(spark, classify(todo), path)
        return sinks.stored_predictions(spark, path)
    rounds = max(1, -(-todo.count() // batch_rows))
    queue_path = work_dir(spark, "pending-notes")
    batch = F.pmod(F.xxhash64("lead_id"), F.lit(rounds)).cast("int")
    todo.withColumn("batch", batch).write.partitionBy("batch").parquet(queue_path)
    queue = spark.read.schema(f"{todo._jdf.schema().toDDL()}, batch int").parquet(queue_path)
    for i in range(rounds):
        part = queue.where(F.col("batch") == i).drop("batch")
        sinks.append_predictions(spark, classify(part), path)
    return sinks.stored_predictions(spark, path)


def write_leakage_report(
    spark: SparkSession, notes: DataFrame, leads: DataFrame, path: str
) -> DataFrame:
    report = leakage.leakage_report(notes, leads)
    sinks.write_report(report, path)
    return spark.read.schema(report.schema).json(path)
