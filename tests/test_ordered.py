"""The ordering helpers against brute force, with one key holding a third of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrade.functions.hashing import hash_uniform
from leadgrade.plans import ordered


def skewed(spark, n=3000, seed=1):
    """A third of the rows share one score; ids are strings."""
    rng = np.random.default_rng(seed)
    score = np.where(np.arange(n) % 3 == 0, 0.5, np.round(rng.random(n), 3))
    y = (rng.random(n) < 0.4).astype(int)
    rows = [(f"id{i:05d}", float(s), int(v), f"g{i % 2}") for i, (s, v) in enumerate(zip(score, y))]
    return spark.createDataFrame(rows, "lead_id string, score double, y int, g string"), rows


def test_running_totals(spark):
    df, rows = skewed(spark)
    counts = df.groupBy("score").agg(F.count("*").alias("n"), F.sum("y").alias("p"))
    got = {
        r["score"]: (r["cum_n"], r["cum_p"], r["total_n"])
        for r in ordered.running_totals(counts, "score", ["n", "p"]).collect()
    }
    for s in {r[1] for r in rows}:
        above = [r for r in rows if r[1] >= s]
        assert got[s] == (len(above), sum(r[2] for r in above), len(rows))


def test_running_totals_by_group(spark):
    df, rows = skewed(spark)
    counts = df.groupBy("g", "score").agg(F.count("*").alias("n"))
    out = ordered.running_totals(counts, "score", ["n"], ["g"], descending=False)
    for r in out.collect():
        below = [x for x in rows if x[3] == r["g"] and x[1] <= r["score"]]
        assert r["cum_n"] == len(below)


def test_any_number_of_groups(spark):
    counts = spark.range(2000).select(
        (F.col("id") % 1000).alias("g"), F.col("id").cast("double").alias("score"), F.lit(1).alias("n")
    )
    out = ordered.running_totals(counts, "score", ["n"], ["g"])
    assert out.where("total_n = 2 and cum_n in (1, 2)").count() == 2000


def test_null_stratum_is_split_like_any_other(spark):
    rows = [(f"id{i:04d}", None if i % 2 else "a") for i in range(400)]
    df = spark.createDataFrame(rows, "lead_id string, s string")
    out = ordered.cut_by_quota(df, ["s"], "lead_id", [F.floor(F.col("n_stratum") * 0.6)], "t")
    got = {(r["s"], r["part"]): r["count"] for r in out.groupBy("s", "part").count().collect()}
    assert got == {(None, 0): 120, (None, 1): 80, ("a", 0): 120, ("a", 1): 80}


def test_empty_input(spark):
    df, _ = skewed(spark, 10)
    none = df.where("score > 5")
    assert ordered.quantiles(none, "score", {"m": 0.5}).first()["n"] is None
    counts = none.groupBy("score").agg(F.count("*").alias("n"))
    assert ordered.running_totals(counts, "score", ["n"]).count() == 0


def test_quantiles(spark):
    df, rows = skewed(spark)
    with_gaps = df.withColumn(
        "score", F.when(F.col("lead_id") == "id00001", float("nan")).otherwise(F.col("score"))
    )
    values = np.array([r[1] for r in rows if r[0] != "id00001"])
    probs = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.95, "e": 1.0}
    got = ordered.quantiles(with_gaps, "score", probs).first()
    assert got["n"] == len(values)
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.percentile(values, p * 100))


def test_running_rows_on_ties(spark):
    df, rows = skewed(spark)
    out = ordered.running_rows(df, "score", "lead_id", {"rank": F.lit(1), "pos": F.col("y")})
    got = {r["lead_id"]: (r["rank"], r["pos"]) for r in out.collect()}
    draw = {
        r["lead_id"]: r["u"]
        for r in df.select("lead_id", hash_uniform(F.col("lead_id"), "tie").alias("u")).collect()
    }
    order = sorted(rows, key=lambda r: (-r[1], draw[r[0]], r[0]))
    pos = 0
    for i, r in enumerate(order, 1):
        pos += r[2]
        assert got[r[0]] == (i, pos)


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 1.0])
def test_cut_by_quota_is_exact(spark, share):
    rows = [(f"id{i:05d}", "hot" if i % 3 else f"s{i % 7}") for i in range(2000)]
    df = spark.createDataFrame(rows, "lead_id string, s string")
    quota = F.floor(F.lit(share) * F.col("n_stratum") + 0.5)
    out = ordered.cut_by_quota(df, ["s"], "lead_id", [quota], "t").collect()
    assert len(out) == len(rows)
    for s in {r[1] for r in rows}:
        mine = [r for r in out if r["s"] == s]
        assert sum(r["part"] == 0 for r in mine) == int(share * len(mine) + 0.5)


def test_cut_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).select(F.col("id").alias("lead_id"), (F.col("id") % 3).alias("s"))
    quotas = [F.floor(F.col("n_stratum") * 0.6), F.floor(F.col("n_stratum") * 0.8)]
    a = ordered.cut_by_quota(df.repartition(1), ["s"], "lead_id", quotas, 7)
    b = ordered.cut_by_quota(df.repartition(13), ["s"], "lead_id", quotas, 7)
    assert sorted(a.collect()) == sorted(b.collect())
