"""Bootstrap draws: portable, partition-free, and summed exactly over blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrade.operators import bootstrap as B


def rows(n=600, seed=4):
    rng = np.random.default_rng(seed)
    return [
        (float(np.round(rng.normal(), 1)), float(np.round(rng.random(), 2)), int(rng.random() < 0.4)) for _ in range(n)
    ]


@pytest.fixture
def table(spark):
    return spark.createDataFrame([*rows(), (0.5, 0.25, 1)], "a double, b double, y int")


def cells(data, columns):
    found = {}
    for r in data:
        key = tuple(r[i] for i in columns)
        found.setdefault(key, [0, 0])[0 if r[-1] else 1] += 1
    return found


def test_draws_have_the_right_distribution():
    keys = np.arange(400, dtype=np.int64) * 7919 - 50
    for count in (1, 3, 40, 1500):
        drawn = B.poisson(keys, np.full(400, count), 0, 500, 42)
        assert drawn.mean() == pytest.approx(count, rel=0.01)
        assert drawn.var() == pytest.approx(count, rel=0.03)
    one, other = (B.poisson(keys, np.ones(400, int), kind, 500, 42) for kind in (0, 1))
    assert abs(np.corrcoef(one.ravel(), other.ravel())[0, 1]) < 0.01
    shifted = np.corrcoef(one[:, 1:].ravel(), one[:, :-1].ravel())[0, 1]
    assert abs(shifted) < 0.01 and abs(np.corrcoef(one)[0, 1:].mean()) < 0.01
    assert not B.poisson(keys, np.zeros(400, int), 0, 5, 42).any()


def test_draws_follow_the_key_alone():
    keys = np.array([5, -9, 1 << 40])
    counts = np.array([1, 2, 3])
    whole = B.poisson(keys, counts, 1, 50, 7)
    assert (whole[::-1] == B.poisson(keys[::-1], counts[::-1], 1, 50, 7)).all()
    assert (whole[1:2] == B.poisson(keys[1:2], counts[1:2], 1, 50, 7)).all()


def brute_auc(keys, score, pos, neg, draws, seed):
    p, n = (B.poisson(keys, c, kind, draws, seed) for kind, c in ((0, pos), (1, neg)))
    above = (score[:, None] > score).astype(float) + 0.5 * (score[:, None] == score)
    wins = np.einsum("ir,ij,jr->r", p, above, n)
    return wins / (p.sum(0) * n.sum(0))


@pytest.mark.parametrize("block", [4, 2048])
def test_sums_over_blocks_against_all_pairs(spark, table, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK", block)
    draws, seed = 30, 42
    keyed = table.groupBy("a", "b").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    ).withColumn("key", F.xxhash64("a", "b"))
    found = keyed.collect()
    keys, pos, neg = (np.array([r[c] for r in found], np.int64) for c in ("key", "pos", "neg"))
    for side, other in (("a", "b"), ("b", "a")):
        blocks = B._blocks(keyed.repartition(5), side, (other,))
        parts = B._parts(blocks, draws, seed, False)
        got = [r["x"] for r in B._auc(parts, "x").orderBy("replicate").collect()]
        want = brute_auc(keys, np.array([r[side] for r in found]), pos, neg, draws, seed)
        assert got == pytest.approx(want.tolist(), abs=1e-12)


def test_intervals_are_the_same_under_any_partitioning(spark, table, monkeypatch):
    first = [r for r in B.bootstrap_ci(table, "a", "y", draws=60).collect()]
    pair = B.paired_bootstrap(table, "a", "b", "y", draws=60).collect()
    monkeypatch.setattr(B, "BLOCK", 5)
    assert B.bootstrap_ci(table.repartition(7), "a", "y", draws=60).collect() == first
    assert B.paired_bootstrap(table.repartition(3), "a", "b", "y", draws=60).collect() == pair


def test_average_precision_against_steps(spark, table):
    draws, seed = 20, 42
    found = cells([(r[0], r[2]) for r in [*rows(), (0.5, 0.25, 1)]], (0,))
    keys = {r["a"]: r["k"] for r in table.select("a", F.xxhash64("a").alias("k")).distinct().collect()}
    scores = sorted((k[0] for k in found), reverse=True)
    p, n = (
        B.poisson(np.array([keys[s] for s in scores]), np.array([found[s,][i] for s in scores]), i, draws, seed)
        for i in (0, 1)
    )
    tp, called = p.cumsum(0), (p + n).cumsum(0)
    want = (p * tp / np.maximum(called, 1)).sum(0) / p.sum(0)
    got = {r["metric"]: r for r in B.bootstrap_ci(table, "a", "y", draws=draws).collect()}["average_precision"]
    assert got["mean"] == pytest.approx(want.mean(), abs=1e-6)
    assert got["lower"] == pytest.approx(np.percentile(want, 2.5), abs=1e-6)


def test_rows_without_score_or_class(spark, table):
    odd = spark.createDataFrame([(None, 0.1, 1), (float("nan"), 0.2, 0), (0.3, 0.3, None)], table.schema)
    both = table.unionByName(odd)
    assert B.bootstrap_ci(both, "a", "y", draws=20).collect() == B.bootstrap_ci(table, "a", "y", draws=20).collect()
    one = B.bootstrap_ci(table.where("y = 1"), "a", "y", draws=20).collect()
    assert {r["n_draws"] for r in one} == {0}
    empty = B.bootstrap_ci(table.limit(0), "a", "y", draws=20).collect()
    assert len(empty) == 2 and {r["n_draws"] for r in empty} == {0}
