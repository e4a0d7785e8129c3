import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.operators import bootstrap, classification, contingency, leakage, profile, ranking, splits

MICRO = [(1, 0.9, 1), (2, 0.8, 0), (3, 0.7, 1), (4, 0.6, 0), (5, 0.5, 1), (6, 0.1, 0)]
SCHEMA = "lead_id long, score double, converted int"


@pytest.fixture
def micro(spark):
    return spark.createDataFrame(MICRO, SCHEMA)


@pytest.fixture
def tied(spark):
    """A third of all rows share one score."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        y = int(rng.random() < 0.35)
        s = 0.4 if i % 3 == 0 else round(float(rng.random() * 0.7 + 0.3 * y), 2)
        rows.append((i, s, y))
    return spark.createDataFrame(rows, SCHEMA), rows


def test_micro_fixture(micro):
    row = ranking.ranking_metrics(micro, "score", "converted").first()
    assert row["roc_auc"] == 0.666667 and row["average_precision"] == 0.755556


@pytest.mark.parametrize("score,auc", [("converted", 1.0), ("1 - converted", 0.0), ("0.5", 0.5)])
def test_auc_bounds(micro, score, auc):
    df = micro.withColumn("score", F.expr(score).cast("double"))
    assert ranking.ranking_metrics(df, "score", "converted").first()["roc_auc"] == auc


def test_one_class_has_no_auc(micro):
    row = ranking.ranking_metrics(micro.where("converted = 1"), "score", "converted").first()
    assert row["roc_auc"] is None


def test_auc_equals_the_evaluator_and_brute_force(tied):
    df, rows = tied
    ours = ranking.ranking_metrics(df, "score", "converted").first()
    judge = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="converted", numBins=0
    )
    assert ours["roc_auc"] == pytest.approx(judge.evaluate(df), abs=1e-6)
    pos = np.array([s for _, s, y in rows if y])
    neg = np.array([s for _, s, y in rows if not y])
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert ours["roc_auc"] == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-6)


def test_gain_takes_the_ceiling(spark, tied):
    df, rows = tied
    small = spark.createDataFrame([(i, float(i), i % 2) for i in range(7)], SCHEMA)
    got = {r["fraction"]: (r["k"], r["gain"]) for r in ranking.gain_at_fraction(small, "score", "converted").collect()}
    assert got == {0.1: (1, 0.0), 0.2: (2, 0.333333), 0.3: (3, 0.333333)}
    full = ranking.gain_at_fraction(df, "score", "converted", (1.0,)).first()
    assert full["gain"] == 1.0 and full["k"] == len(rows)
    none = small.withColumn("converted", F.lit(0))
    assert ranking.gain_at_fraction(none, "score", "converted", (0.5,)).first()["gain"] == 0.0


def test_confusion_and_sweep(micro):
    row = classification.confusion_binary(micro, "score", "converted").first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 2, 0, 3)
    sweep = {
        r["threshold"]: r
        for r in classification.threshold_sweep(micro, "score", "converted", (0.5, 0.85, 0.95)).collect()
    }
    assert sweep[0.5]["precision"] == 0.6 and sweep[0.5]["recall"] == 1.0
    assert sweep[0.85]["predicted_positive_n"] == 1
    assert sweep[0.95]["precision"] == 0.0


def test_calibration_matches_numpy(tied):
    df, rows = tied
    p, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    edges = np.percentile(p, np.linspace(0, 1, 11) * 100)
    place = np.searchsorted(edges[1:-1], p)
    got = {r["bin"]: r for r in classification.calibration(df, "score", "converted").collect()}
    assert set(got) == set(place)
    for b in got:
        assert got[b]["n"] == (place == b).sum()
        assert got[b]["bin_mean_pred"] == pytest.approx(p[place == b].mean(), abs=1e-6)
        assert got[b]["bin_frac_pos"] == pytest.approx(y[place == b].mean(), abs=1e-6)


CROSSTAB = {
    "disengaged": (2103, 704),
    "neutral": (1328, 485),
    "objection": (671, 762),
    "positive_engagement": (1577, 1610),
}


@pytest.fixture
def published(spark):
    rows = [(a, y, n) for a, counts in CROSSTAB.items() for y, n in enumerate(counts)]
    df = spark.createDataFrame(rows, "attitude string, converted int, n int")
    many = df.select("attitude", "converted", F.explode(F.sequence(F.lit(1), "n")))
    return many.select("attitude", "converted", F.monotonically_increasing_id().alias("lead_id"))


def test_association_matches_published_values(published):
    row = contingency.association(published, "attitude", "converted").first()
    assert row["chi_square"] == pytest.approx(643.6826, abs=1e-4)
    assert row["cramers_v"] == 0.263335
    assert row["mutual_information"] == 0.035347


def test_crosstab_matches_published_values(published):
    row = contingency.crosstab_pct(published, "attitude").where("attitude = 'objection'").first()
    assert (row["converted_0"], row["converted_1_pct"]) == (671, 53.18)


def test_cv_auc_is_near_the_published_one(published):
    row = leakage.cv_category_auc(published, "attitude").first()
    assert row["n_folds"] == 5 and row["auc"] == pytest.approx(0.6351, abs=0.006)


def test_degenerate_association(spark):
    one = spark.createDataFrame([("a", 1), ("a", 0)], "x string, y int")
    assert contingency.association(one, "x", "y").first()["cramers_v"] == 0.0
    row = contingency.association(one.where("y > 5"), "x", "y").first()
    assert (row["n"], row["cramers_v"], row["chi_square"], row["mutual_information"]) == (0, 0, 0, 0)


def test_suspects(spark):
    rows = [(1, "won"), (1, "won"), (0, "lost"), (0, None), (1, None), (0, None)]
    df = spark.createDataFrame(rows, "converted int, tags string")
    row = leakage.suspect_auc(df, ("tags", "not_there")).collect()
    assert len(row) == 1 and row[0]["n_missing"] == 3 and row[0]["n_unique"] == 3
    assert row[0]["auc"] == pytest.approx(0.8889, abs=1e-4)


def test_flags(published, spark):
    suspects = spark.createDataFrame([("tags", 0.95), ("x", 0.6)], "column string, auc double")
    got = {
        r["rule"]: r["level"]
        for r in leakage.leakage_flags(
            leakage.cv_category_auc(published, "attitude"),
            contingency.association(published, "attitude", "converted"),
            contingency.crosstab_pct(published, "attitude"),
            suspects,
        ).collect()
    }
    assert got == {"attitude_auc": "healthy", "cramers_v": "in_band", "suspect_column": "drop"}


CONFUSION = [
    ("positive_engagement", "positive_engagement", 319),
    ("objection", "positive_engagement", 24),
    ("objection", "objection", 119),
    ("neutral", "positive_engagement", 37),
    ("neutral", "neutral", 132),
    ("neutral", "disengaged", 12),
    ("disengaged", "neutral", 27),
    ("disengaged", "disengaged", 254),
]


@pytest.fixture
def labelled(spark):
    df = spark.createDataFrame(CONFUSION, "t string, g string, n int")
    return df.select("t", "g", F.explode(F.sequence(F.lit(1), "n"))).select(
        "t", "g", F.monotonically_increasing_id().alias("lead_id"), F.lit("en").alias("language")
    )


def test_class_report_matches_published_values(labelled):
    row = classification.overall_report(labelled, "t", "g").first()
    assert (row["n"], row["accuracy"]) == (924, 0.891775)
    assert (row["f1_macro"], row["f1_weighted"]) == (0.881576, 0.890226)
    per = {r["label"]: r for r in classification.class_report(labelled, "t", "g").collect()}
    assert per["neutral"]["f1"] == pytest.approx(0.7764705882)
    assert per["objection"]["support"] == 143


def test_label_never_predicted_counts_as_zero(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "b")], "t string, g string")
    per = {r["label"]: r["f1"] for r in classification.class_report(df, "t", "g").collect()}
    assert per["a"] == 0.0 and per["b"] == pytest.approx(2 / 3)


def test_error_breakdown_matches_published_values(labelled):
    got = {(r["kind"], r["key"]): r["n"] for r in classification.error_breakdown(labelled, "t", "g").collect()}
    assert got[("by_pair", "neutral__to__positive_engagement")] == 37
    assert got[("by_true_class", "neutral")] == 49 and got[("by_language", "en")] == 100


def test_sample_errors(labelled):
    got = classification.sample_errors(labelled, "t", "g", 2).groupBy("t", "g").count().collect()
    assert len(got) == 4 and all(r["count"] == 2 for r in got)


def test_bootstrap_f1_interval(labelled):
    row = bootstrap.bootstrap_f1(labelled, "t", "g", draws=400).first()
    assert row["lower"] == pytest.approx(0.8598, abs=0.006)
    assert row["upper"] == pytest.approx(0.9010, abs=0.006)


def test_bootstrap_interval_against_row_resampling(tied):
    df, rows = tied
    got = {r["metric"]: r for r in bootstrap.bootstrap_ci(df, "score", "converted", draws=400).collect()}
    rng = np.random.default_rng(0)
    s, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    aucs = []
    for _ in range(400):
        i = rng.integers(0, len(rows), len(rows))
        pos, neg = s[i][y[i] == 1], s[i][y[i] == 0]
        wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
        aucs.append(wins / (len(pos) * len(neg)))
    lower, upper = np.percentile(aucs, [2.5, 97.5])
    assert got["roc_auc"]["lower"] == pytest.approx(lower, abs=0.012)
    assert got["roc_auc"]["upper"] == pytest.approx(upper, abs=0.012)
    assert got["roc_auc"]["n_draws"] == 400
    again = bootstrap.bootstrap_ci(df.repartition(3), "score", "converted", draws=400).collect()
    assert {r["metric"]: r for r in again} == got


def test_paired_bootstrap(tied):
    df, _ = tied
    both = df.withColumn("worse", F.rand(1))
    row = bootstrap.paired_bootstrap(both, "worse", "score", "converted", draws=200).first()
    assert row["significant"] and row["lower"] > 0
    same = df.withColumn("other", F.col("score"))
    row = bootstrap.paired_bootstrap(same, "other", "score", "converted", draws=50).first()
    assert not row["significant"] and row["mean"] == 0.0


def test_splits_are_exact_and_independent(spark):
    df = spark.range(1000).select(
        F.col("id").alias("lead_id"),
        (F.col("id") % 5 < 2).cast("int").alias("converted"),
        F.lit("a").alias("attitude"),
        F.lit("b").alias("language"),
    )
    got = splits.split_60_20_20(df)
    n = {(r["converted"], r["split"]): r["count"] for r in got.groupBy("converted", "split").count().collect()}
    assert n == {
        (1, "train"): 240, (1, "val"): 80, (1, "test"): 80,
        (0, "train"): 360, (0, "val"): 120, (0, "test"): 120,
    }
    test = splits.split_80_10_10(df).where("split = 'test'")
    assert test.count() == 100
    assert 5 < splits.clean_ids(test, got).count() < 40
    overlap = {r["part"]: r["n"] for r in splits.split_overlap(test, got).collect()}
    assert overlap["total"] == 100 and sum(overlap.values()) == 200


def test_folds_are_balanced(spark):
    df = spark.range(503).select(F.col("id").alias("lead_id"), (F.col("id") % 2).alias("y"))
    sizes = [r["count"] for r in splits.kfold(df, ["y"], 5).groupBy("y", "fold").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1


def test_subsample_keeps_every_stratum(spark):
    df = spark.range(1000).select(
        F.col("id").alias("lead_id"), F.when(F.col("id") < 2, "rare").otherwise("hot").alias("s")
    )
    n = {r["s"]: r["count"] for r in splits.stratified_subsample(df, ["s"], 100).groupBy("s").count().collect()}
    assert n == {"rare": 1, "hot": 100}
    with pytest.raises(ValueError):
        splits.stratified_split(df, ["s"], {"a": 0.5, "b": 0.4})


def test_profile_tables(leads_of, spark):
    df = leads_of(
        {"lead_id": "a", "converted": 1, "city": "Select", "activity_score": None},
        {"lead_id": "b", "city": None, "search": "Yes"},
        {"lead_id": "c"},
    )
    audit = {r["column"]: r for r in profile.placeholder_audit(df).collect()}
    assert (audit["city"]["n_select"], audit["city"]["n_null"]) == (1, 1)
    assert audit["city"]["pct_combined"] == pytest.approx(66.666667)
    flags = {r["column"]: r["decision"] for r in profile.flag_variance(df).collect()}
    assert flags["magazine"] == "drop (dead)" and flags["search"].startswith("merge")
    both = profile.co_missingness(df).first()
    assert (both["n_all_null"], both["n_any_null"], both["overlap"]) == (0, 1, 0.0)
    weights = profile.class_weights(df).first()
    assert (weights["scale_pos_weight"], weights["weight_pos"]) == (2.0, 1.5)
    none = profile.class_weights(df.where("converted = 0")).first()
    assert none["scale_pos_weight"] == 1.0
    assert profile.missing_rates(df, ["city", "tags"], 1).first()["column"] == "city"


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (1.0,), (0.999,)], "p double")
    got = {r["bin"]: r["n"] for r in profile.histogram(df, "p", 10).collect()}
    assert got[0] == 2 and got[9] == 2 and sum(got.values()) == 4 and len(got) == 10


def test_id_sets(spark):
    a = spark.range(5).withColumnRenamed("id", "k")
    b = spark.range(3, 7).withColumnRenamed("id", "k")
    row = profile.id_set_difference(a, b, "k").first()
    assert (row["n_both"], row["n_only_left"], row["n_only_right"], row["same"]) == (2, 3, 2, False)
    assert profile.id_set_difference(a, a, "k").first()["same"]


def test_constants_are_consistent():
    assert math.isclose(sum(C.LANGUAGE_MIX.values()), 1.0)
    assert math.isclose(C.WEIGHT_CONVERSION + C.WEIGHT_SENTIMENT, 1.0)
    assert len(C.RAW_COLUMNS) == 37 and len(C.REQUIRED_RAW) == 26 and len(C.DERIVED_ORDER) == 25
