import pytest
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions import scoring
from leadgrade.operators import priority


def scored(spark, *rows):
    data = [(f"l{i}", p, a) for i, (p, a) in enumerate(rows)]
    return spark.createDataFrame(data, "lead_id string, p_conversion double, predicted_attitude string")


def values(df):
    return [r["priority"] for r in df.orderBy("lead_id").collect()]


def test_boundaries_for_every_label(spark):
    rows = [(p, a) for p in (0.0, 1.0) for a in C.ATTITUDES]
    got = values(priority.checked_priority(scored(spark, *rows)))
    want = [0.6 * p + 0.4 * C.ATTITUDE_SCORES[a] for p, a in rows]
    assert got == pytest.approx(want)


def test_default_and_override(spark):
    assert values(priority.checked_priority(scored(spark, (0.5, "objection")))) == pytest.approx([0.56])
    rows = scored(spark, (0.8, "positive_engagement"))
    assert values(priority.checked_priority(rows, 0.3, 0.7)) == pytest.approx([0.94])


def test_custom_scores(spark):
    scores = {**C.ATTITUDE_SCORES, "objection": 0.4}
    rows = scored(spark, (0.5, "objection"))
    assert values(priority.checked_priority(rows, scores=scores)) == pytest.approx([0.46])


@pytest.mark.parametrize("pair", [(0.5, 0.4), (1.2, -0.2), (0.6, None), (None, 0.4)])
def test_bad_weights(pair):
    with pytest.raises(ValueError):
        scoring.resolve_weights(*pair)


@pytest.mark.parametrize("p", [-0.01, 1.01, float("nan"), float("inf"), None])
def test_bad_probability_fails_the_query(spark, p):
    with pytest.raises(Exception, match="out_of_range for lead l0"):
        priority.checked_priority(scored(spark, (p, "neutral"))).collect()


@pytest.mark.parametrize("label", ["very_positive", None])
def test_unknown_label_fails_the_query(spark, label):
    with pytest.raises(Exception, match="unknown_attitude"):
        priority.checked_priority(scored(spark, (0.5, label))).collect()


def test_quarantine_keeps_every_row(spark):
    rows = scored(spark, (0.5, "neutral"), (2.0, "neutral"), (0.5, "x"))
    got = [r["reject_reason"] for r in priority.quarantine(rows).orderBy("lead_id").collect()]
    assert got == [None, "p_conversion_out_of_range", "unknown_attitude"]


def ranked(spark, n=30):
    return spark.range(n).select(
        F.col("id").alias("lead_id"),
        (F.col("id") / float(n)).alias("priority"),
        (F.col("id") % 2).cast("int").alias("converted"),
    )


def test_top_list(spark):
    rows = ranked(spark)
    assert [r["lead_id"] for r in priority.top_leads(rows).collect()] == list(range(29, 19, -1))
    assert priority.top_leads(rows, 0).count() == 0
    assert priority.top_leads(rows, 30, 0.9).count() == 3
    assert priority.top_leads(rows, 30, 0.999999).count() == 0


@pytest.mark.parametrize("n,floor,most", [(-1, 0.0, None), (11, 0.0, 10), (5, -0.1, None), (5, 1.1, None)])
def test_top_arguments(spark, n, floor, most):
    with pytest.raises(ValueError):
        priority.top_leads(ranked(spark), n, floor, most)


def test_a_list_of_any_length_and_the_total_of_an_empty_one(spark):
    assert priority.top_leads(ranked(spark, 2000), 1500).count() == 1500
    row = priority.top_list(ranked(spark), 0).collect()
    assert [(r["total_available"], r["lead_id"]) for r in row] == [(30, None)]
    assert priority.top_list(ranked(spark), 3).where("total_available = 30").count() == 3


def test_ties_in_the_top_list_go_by_id(spark):
    rows = ranked(spark).withColumn("priority", F.lit(0.5))
    assert [r["lead_id"] for r in priority.top_leads(rows, 3).collect()] == [0, 1, 2]


def test_capture(spark):
    got = priority.top_n_capture(ranked(spark), (10, 25, 50)).orderBy("n").collect()
    assert [(r["n"], r["actual_n"], r["captured"]) for r in got] == [
        (10, 10, 5),
        (25, 25, 13),
        (50, 30, 15),
    ]
    assert got[0]["lift"] == pytest.approx(1.0)


def test_overlap(spark):
    leads = spark.range(100).withColumnRenamed("id", "lead_id")
    good = spark.range(90).withColumnRenamed("id", "lead_id")
    bad = spark.range(80, 120).withColumnRenamed("id", "lead_id")
    twice = good.unionByName(good)
    assert priority.join_overlap(leads, twice).first()["overlap"] == 1.0
    priority.require_overlap(leads, good)
    with pytest.raises(ValueError, match="0.5"):
        priority.require_overlap(leads, bad)
