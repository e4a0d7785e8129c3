"""Boosted trees: both ways of training, Spark ML's trees, storage, explanations."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.linalg import Vectors

from leadgrade.operators import attribution, boosting, logistic, models, ranking

SCHEMA = "lead_id int, label double, features vector, weight double, fold int"


def rows_of(n, seed, odd=False):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x = [float(rng.normal()), float(rng.integers(0, 5)), float(rng.integers(0, 2)), 0.0, float(rng.random() < 0.02)]
        odds = 1.5 * x[0] * (1 if x[2] else -1) + 0.8 * (x[1] > 2) + 2 * x[4] - 0.3
        y = float(rng.random() < 1 / (1 + math.exp(-odds)))
        out.append((i, y, Vectors.dense(x), 1.7 if y else 1.0, i % 3))
    return out


@pytest.fixture(scope="module")
def table(spark):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    kinds = (IntegerType(), DoubleType(), VectorUDT(), DoubleType(), IntegerType())
    names = ("lead_id", "label", "features", "weight", "fold")
    schema = StructType([StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return lambda n, seed=1: spark.createDataFrame(rows_of(n, seed), schema).repartition(4).cache()


def same(a, b):
    return len(a) == len(b) and all(
        all(np.array_equal(x, y) for x, y in zip(s, t, strict=True)) for s, t in zip(a, b, strict=True)
    )


def test_passes_over_blocks_give_the_trees_of_one_task(table, monkeypatch):
    data = table(1500)
    bins = boosting.find_bins(data, 5)
    specs = [boosting.Spec(9, 0, 0.1, 5, 0), boosting.Spec(9, 0, 0.1, 5), boosting.Spec(31, 2, 0.3, 3, 1)]
    whole = boosting.train(boosting.blocks(data, bins), specs, bins)
    monkeypatch.setattr(boosting, "KEEP", 2)
    monkeypatch.setattr("leadgrade.plans.partials.MERGE", 2)
    stored = boosting.blocks(data.repartition(7), bins, rows=100)
    parts = boosting.train(stored, specs, bins, task_bytes=0)
    for (base, trees), (other_base, other) in zip(whole, parts, strict=True):
        assert base == other_base and same(trees, other)
    assert all(max((t.left < 0).sum() for t in trees) <= s.leaves for s, (_, trees) in zip(specs, whole, strict=True))
    assert max((t.left < 0).sum() for t in whole[2][1]) == 4  # depth 2
    assert all(t.cover[t.left < 0].min() >= boosting.MIN_ROWS for _, trees in whole for t in trees)


def test_best_cut_against_every_cut():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 6, (4, 300)).astype(np.uint8)
    bins = boosting.Bins([np.arange(5.0)] * 4)
    stats = boosting.gradients(rng.normal(size=300), (rng.random(300) < 0.4).astype(float), np.ones(300))
    places = codes.astype(np.int64) + bins.starts[:-1, None]
    sums = boosting.histogram(places, np.zeros(300, np.int64), stats, 1, int(bins.starts[-1]))
    found = boosting.best_cuts(sums, bins.starts, 20)
    best = (-np.inf, None)
    for f, b in itertools.product(range(4), range(5)):
        left = codes[f] <= b
        if min(left.sum(), (~left).sum()) >= 20:
            score = lambda m: stats[0, m].sum() ** 2 / stats[1, m].sum()
            gain = (score(left) + score(~left) - score(np.ones(300, bool))) / boosting.STEP
            best = max(best, (gain, (f, b)), key=lambda g: g[0])
    assert found.gain[0] == pytest.approx(best[0]) and (found.feature[0], found.bin[0]) == best[1]


def test_sums_of_unusual_bins_give_the_whole_histogram():
    rng = np.random.default_rng(5)
    hot = np.eye(150, dtype=np.uint8)[rng.integers(0, 150, 20_000)].T
    codes = np.concatenate([rng.integers(0, 9, (3, 20_000)).astype(np.uint8), hot, np.zeros((1, 20_000), np.uint8)])
    starts = boosting.Bins([np.arange(8.0)] * 3 + [np.zeros(1)] * 150 + [np.zeros(0)]).starts
    stats = boosting.gradients(rng.normal(size=20_000), (rng.random(20_000) < 0.4).astype(float), np.ones(20_000))
    rows = np.flatnonzero(rng.random(20_000) < 0.7)
    slot = rng.integers(0, 5, len(rows))
    own = boosting.unusual(codes, starts)
    assert own.places.shape[0] <= 4  # three numbers and one hot feature a row
    found = boosting.leaf_sums(own, starts, rows, slot, stats[:, rows], 6)
    places = codes[:, rows].astype(np.int64) + starts[:-1, None]
    assert np.array_equal(found, boosting.histogram(places, slot, stats[:, rows], 6, int(starts[-1])))
    none = boosting.leaf_sums(own, starts, rows[:0], slot[:0], stats[:, :0], 2)
    assert none.shape == (2, 3, starts[-1]) and not none.any()


def test_passes_sum_the_smaller_child_alone(table, monkeypatch):
    data = table(1500)
    bins = boosting.find_bins(data, 5)
    stored, specs = boosting.blocks(data, bins), [boosting.Spec(9, 0, 0.1, 3)]
    whole = boosting.train(stored, specs, bins)
    seen, sums_of = [], boosting._sums_of

    def counted(state, specs, starts, growing):
        seen.append(sum(len(wanted) for _, wanted in growing.values()))
        return sums_of(state, specs, starts, growing)

    monkeypatch.setattr(boosting, "_sums_of", counted)
    monkeypatch.setattr(boosting, "MERGE_BYTES", 0)
    parts = boosting.train(stored, specs, bins, task_bytes=0)
    assert same(whole[0][1], parts[0][1])
    # The root, and one child of each split at most.
    assert sum(seen) <= sum(1 + (t.left >= 0).sum() for t in parts[0][1])


def test_auc_like_spark_ml_on_the_same_cell(table):
    train, test = table(6000, 1), table(6000, 2)
    cell = {"maxDepth": (4,), "stepSize": (0.1,), "maxIter": (40,)}
    ours = models.train_boosted(train, cell).model
    theirs = GBTClassifier(
        weightCol="weight", maxDepth=4, stepSize=0.1, maxIter=40, maxBins=255, minInstancesPerNode=20
    ).fit(train)
    auc = [
        ranking.ranking_metrics(models.score(m, test, ["label"]), "p_conversion", "label").first()["roc_auc"]
        for m in (ours, theirs)
    ]
    assert auc[0] > 0.75 and auc[0] > auc[1] - 0.005
    gains = ours.stages[0].featureImportances.toArray()
    assert gains.sum() == pytest.approx(1) and gains[0] + gains[2] > 0.8 and gains[3] == 0


def test_the_search_reads_short_cells_off_long_ones(table):
    data = table(900)
    grid = {"maxLeaves": (4, 8), "stepSize": (0.1,), "maxIter": (3, 6)}
    trained = models.train_boosted(data, grid, k=3)
    assert set(trained.best_params) == set(grid) and 0.6 < trained.cv_auc < 1
    size, start, trees = trained.model.stages[0].parts()
    assert size == 5 and len(trees) == trained.best_params["maxIter"]
    alone = models.train_boosted(data, {k: (v,) for k, v in trained.best_params.items()}, k=3)
    assert alone.model.stages[0].getOrDefault("trees") == trained.model.stages[0].getOrDefault("trees")


def test_stored_trees_score_alike(table, tmp_path):
    data = table(400)
    model = models.train_boosted(data, {"maxLeaves": (6,), "maxIter": (4,)}).model
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    rows = [sorted(models.score(m, data, ["lead_id"]).collect()) for m in (model, again)]
    assert rows[0] == rows[1] and len(rows[0]) == 400


def test_tables_without_a_choice(table, spark):
    data = table(30)
    one = models.train_boosted(data, {"maxIter": (2,)}).model  # too few rows for any cut
    p = {round(r["p_conversion"], 12) for r in models.score(one, data, ["lead_id"]).collect()}
    assert len(p) == 1
    single = models.train_boosted(data.where("label = 1"), {"maxIter": (2,)}).model
    assert models.score(single, data, ["lead_id"]).count() == 30
    with pytest.raises(ValueError, match="no rows"):
        models.train_boosted(data.limit(0), {"maxIter": (2,)})


# Explanations


def expected(tree, row, known, node=0):
    """Mean score when only the features of ``known`` are known."""
    left, right = tree["left"][node], tree["right"][node]
    if left < 0:
        return tree["value"][node]
    f = tree["feature"][node]
    if f in known:
        return expected(tree, row, known, left if row[f] <= tree["threshold"][node] else right)
    parts = [tree["cover"][c] / tree["cover"][node] * expected(tree, row, known, c) for c in (left, right)]
    return sum(parts)


def test_contributions_against_all_subsets(table):
    data = table(700)
    model = models.train_boosted(data, {"maxLeaves": (12,), "maxIter": (3,)}).model.stages[0]
    size, start, trees = model.parts()
    rows = np.array([r["features"].toArray() for r in data.limit(12).collect()])
    found = attribution.contributions(rows, trees)
    for i, row in enumerate(rows):
        for f in range(size):
            others = [x for x in range(size) if x != f]
            share = 0.0
            for k in range(size):
                weight = math.factorial(k) * math.factorial(size - 1 - k) / math.factorial(size)
                for s in itertools.combinations(others, k):
                    share += weight * sum(expected(t, row, {*s, f}) - expected(t, row, set(s)) for t in trees)
            assert found[i, f] == pytest.approx(share, abs=1e-12)


def test_contributions_add_up_to_the_margin(table):
    data = table(700)
    model = models.train_boosted(data, {"maxLeaves": (31,), "maxIter": (30,)}).model.stages[0]
    explained = attribution.explain(model, data, ["lead_id"])
    rows = explained.collect()
    assert len(rows) == 700
    assert max(abs(r["base"] + sum(r["contributions"]) - r["margin"]) for r in rows) < 1e-9
    mean = {r["position"]: r["mean_abs"] for r in attribution.mean_absolute(explained).collect()}
    assert mean[3] == 0 and max(mean, key=mean.get) in (0, 2)
    assert mean[0] == pytest.approx(np.mean([abs(r["contributions"][0]) for r in rows]))


# Logistic regression


def test_coefficients_like_spark_ml(table):
    data = table(800)
    trained = models.train_logistic(data, (0.01, 1.0), k=3)
    c, n = trained.best_params["C"], data.count()
    theirs = LogisticRegression(
        weightCol="weight", standardization=False, maxIter=500, tol=1e-12, regParam=1.0 / (c * n)
    ).fit(data)
    ours = trained.model.stages[0]
    assert np.abs(ours.coefficients.toArray() - theirs.coefficients.toArray()).max() < 1e-6
    assert ours.intercept == pytest.approx(theirs.intercept, abs=1e-6)


def test_folds_are_left_out(table, spark):
    data = table(600)
    stored = logistic.rows_of(data)
    held, whole = logistic.train(stored, [logistic.Spec(0.01, 1), logistic.Spec(0.01)], 5)
    part = LogisticRegression(
        weightCol="weight", standardization=False, maxIter=500, tol=1e-12, regParam=0.01
    ).fit(data.where("fold <> 1"))
    assert np.abs(held[:-1] - part.coefficients.toArray()).max() < 1e-6
    assert np.abs(held - whole).max() > 1e-4
    margins = logistic.held_out_margins(stored, [logistic.Spec(0.01, 1)], [held])
    assert margins.count() == data.where("fold = 1").count()


def test_a_separable_table_ends(spark, table):
    data = table(200).where("label = 1 or features is not null")
    separable = data.select("lead_id", (data.lead_id % 2).cast("double").alias("label"), "features", "weight", "fold")
    trained = models.train_logistic(separable.where("label = 1"), (1.0,))
    assert trained.model.stages[0].intercept > 5


def test_sums_of_leaves_read_no_filling(monkeypatch):
    rng = np.random.default_rng(15)
    codes = np.stack([rng.integers(0, 40, 3000) * (rng.random(3000) < share) for share in (0.9, 0.5, 0.2, 0.1, 0.05)]).astype(np.uint8)
    starts = np.concatenate([[0], np.cumsum([40] * 5)])
    order, of = boosting.turns(codes, starts)
    codes = codes[:, order]
    places = starts[:-1, None] + codes
    counts = (of.lines < starts[-1]).sum(axis=1)
    assert (np.diff(counts) <= 0).all() and of.ends == [(counts > t).sum() for t in range(of.lines.shape[1])]
    stats = boosting.gradients(rng.normal(size=3000), rng.integers(0, 2, 3000), rng.random(3000))
    picked = rng.integers(0, 5, 3000)
    leaves = [np.flatnonzero(picked == i) for i in range(3)] + [np.arange(700, 1900), np.arange(3000), np.arange(0)]
    want = [boosting.histogram(places[:, r], np.zeros(len(r), np.int64), stats[:, r], 1, int(starts[-1]))[0] for r in leaves]
    read, real = [], np.bincount
    for few, block in ((0, 256), (650, 1 << 14), (10**6, 64)):
        monkeypatch.setattr(boosting, "FEW", few)
        monkeypatch.setattr(boosting, "BLOCK", block)
        found = boosting.sums_of_leaves(of, starts, leaves, stats)
        assert all(np.array_equal(a, b) for a, b in zip(found, want, strict=True))
    monkeypatch.setattr(boosting, "FEW", 0)
    monkeypatch.setattr(np, "bincount", lambda x, *a, **b: read.append(len(x)) or real(x, *a, **b))
    boosting.sums_of_leaves(of, starts, [np.arange(3000)], stats)
    assert sum(read) == 3 * counts.sum() < 0.7 * 3 * of.lines.size
