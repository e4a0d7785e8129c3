import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrade.operators import features, models, ranking
from leadgrade.operators.derive import derive_features
from leadgrade.sources import state_store


@pytest.fixture(scope="module")
def training(spark):
    from leadgrade.sources.schema import RAW_LEAD_SCHEMA
    from tests.conftest import raw_row

    rng = np.random.default_rng(2)
    names = RAW_LEAD_SCHEMA.fieldNames()
    rows = []
    for i in range(300):
        time = float(rng.integers(0, 2000))
        y = int(time / 2000 + rng.normal(0, 0.2) > 0.6)
        row = raw_row(
            lead_id=f"l{i:04d}",
            converted=y,
            total_time_spent=time,
            total_visits=float(rng.integers(0, 9)),
            activity_score=None if i % 2 else 15.0,
            lead_source=("Google", "Chat")[i % 2],
        )
        rows.append(tuple(row[n] for n in names))
    leads = spark.createDataFrame(rows, RAW_LEAD_SCHEMA)
    derived = derive_features(leads, ["lead_id", "converted"]).cache()
    state = features.fit(derived)
    return derived, state


def test_training_table(training):
    derived, state = training
    table = models.training_table(state, derived)
    sums = table.groupBy("label").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()
    assert sums[0]["w"] == pytest.approx(sums[1]["w"])
    assert sum(r["w"] for r in sums) == pytest.approx(300)
    assert sorted(r[0] for r in table.select("fold").distinct().collect()) == [0, 1, 2, 3, 4]


def test_logistic_regression(training, spark, tmp_path):
    derived, state = training
    table = models.training_table(state, derived, k=2).cache()
    trained = models.train_logistic(table, (0.1, 1.0), k=2)
    assert trained.best_params["C"] in (0.1, 1.0) and trained.cv_auc > 0.8
    vectors = state.vectors(derived, ["lead_id", "converted"])
    scored = models.score(trained.model, vectors, ["lead_id", "converted"])
    assert scored.where("p_conversion < 0 OR p_conversion > 1 OR p_conversion IS NULL").count() == 0
    assert ranking.ranking_metrics(scored, "p_conversion", "converted").first()["roc_auc"] > 0.85

    path = str(tmp_path / "model")
    names = [r["name"] for r in state.catalog().collect()]
    state_store.save_model(spark, trained.model, trained.kind, names, path)
    assert state_store.model_meta(spark, path)["feature_names"] == names
    loaded = state_store.load_model(spark, path)
    again = models.score(loaded, vectors, ["lead_id", "converted"])
    assert sorted(again.collect()) == sorted(scored.collect())

    for kind, version, match in (("forest", 1, "kind"), (trained.kind, 99, "newer")):
        meta = spark.createDataFrame([(kind, version, 0, names)], state_store._META)
        meta.write.mode("overwrite").json(f"{path}/meta")
        with pytest.raises(ValueError, match=match):
            state_store.load_model(spark, path)


def test_unknown_kind_is_not_saved(spark, tmp_path, training):
    with pytest.raises(ValueError, match="unknown model kind"):
        state_store.save_model(spark, None, "forest", [], str(tmp_path))


def test_regularisation_matches_closed_check(training):
    """Smaller C shrinks the coefficients."""
    derived, state = training
    table = models.training_table(state, derived, k=2).cache()
    norms = [
        float(np.linalg.norm(models.train_logistic(table, (c,)).model.stages[0].coefficients.toArray()))
        for c in (0.001, 1.0)
    ]
    assert norms[0] < norms[1]


def test_boosted_trees_and_importance(training):
    derived, state = training
    table = models.training_table(state, derived, k=2, balanced=False).cache()
    grid = {"maxDepth": (2,), "stepSize": (0.1, 0.3), "maxIter": (3,)}
    trained = models.train_boosted(table, grid, k=2)
    assert trained.cv_auc > 0.8 and set(trained.best_params) == set(grid)
    top = models.feature_importance(trained.model, state).collect()
    assert top[0]["feature"] in ("total_time_spent", "total_time_per_visit")
    assert len(top) <= 15


def test_attribution_sums_to_the_linear_score(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, -2.0)], "a double, b double")
    out = models.linear_attribution(df, {"a": 2.0, "b": -1.0}, {"a": 2.0})
    rows = out.collect()
    assert [r["contrib_a"] for r in rows] == [-2.0, 2.0]
    assert [r["contrib_b"] for r in rows] == [-2.0, 2.0]
    means = {r["feature"]: r["mean_abs"] for r in models.mean_absolute_contribution(out, ["a", "b"]).collect()}
    assert means == {"a": 2.0, "b": 2.0}


def test_model_metrics_are_tidy(spark):
    rows = [("m", "test", i % 2, i / 10) for i in range(10)]
    df = spark.createDataFrame(rows, "model string, split string, converted int, p_conversion double")
    got = {r["metric"]: r["value"] for r in models.model_metrics(df).collect()}
    assert got["n"] == 10 and got["recall_at_0_3"] == 0.8 and len(got) == 13
