import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.operators import contingency, segments

ACTIVITIES = ("SMS Sent", "Email Opened", "Email Bounced", "Odd", None)


def leads(spark, n=2000):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.4)
        time = float(rng.integers(0, 900) + 500 * y)
        rows.append(
            (
                f"l{i:05d}",
                y,
                time,
                None if i % 9 == 0 else float(rng.integers(0, 12)),
                float(rng.random() * 4),
                ACTIVITIES[(i + y) % 5],
            )
        )
    return spark.createDataFrame(
        rows,
        "lead_id string, converted int, total_time_spent double, total_visits double, "
        "page_views_per_visit double, last_activity string",
    )


def test_engagement_formula(spark):
    df = leads(spark, 300)
    got = {r["lead_id"]: r["engagement"] for r in segments.engagement_score(df, 0.0).collect()}
    rows = df.collect()

    def norm(name):
        v = np.array([r[name] or 0.0 for r in rows])
        return np.clip(v / np.quantile(v, 0.95), 0, 1)

    parts = (
        0.5 * norm("total_time_spent")
        + 0.1 * norm("total_visits")
        + 0.05 * norm("page_views_per_visit")
    )
    for r, p in zip(rows, parts, strict=True):
        bonus = C.ACTIVITY_BONUS.get(r["last_activity"], 0.0)
        assert got[r["lead_id"]] == pytest.approx(p + 0.35 * bonus)


def test_all_zero_column_scores_zero(spark):
    df = leads(spark, 20).withColumn("total_visits", F.lit(0.0))
    assert segments.engagement_score(df, 0.0).where(F.isnan("engagement")).count() == 0


def test_segments(spark):
    df = leads(spark)
    one = segments.assign_segments(df).select("lead_id", "attitude", "converted")
    two = segments.assign_segments(df.repartition(7)).select("lead_id", "attitude", "converted")
    assert sorted(one.collect()) == sorted(two.collect())
    share = {r["attitude"]: r["n"] / 2000 for r in one.groupBy("attitude").agg(F.count("*").alias("n")).collect()}
    assert set(share) == set(C.ATTITUDES) and min(share.values()) > 0.05
    engaged = share["positive_engagement"] + share["objection"]
    assert engaged == pytest.approx(0.5, abs=0.001)
    table = contingency.crosstab_pct(one, "attitude")
    assert table.where("converted_0 = 0 OR converted_1 = 0").count() == 0


def test_segments_ignore_the_outcome(spark):
    df = leads(spark, 200)
    flipped = df.withColumn("converted", 1 - F.col("converted"))
    pick = ("lead_id", "attitude")
    a = segments.assign_segments(df).select(*pick).collect()
    b = segments.assign_segments(flipped).select(*pick).collect()
    assert sorted(a) == sorted(b)


def test_time_buckets(spark):
    values = (None, float("nan"), 0.0, 59.9, 60.0, 299.0, 300.0, 899.0, 900.0)
    df = spark.createDataFrame([(v,) for v in values], "total_time_spent double")
    got = [r["time_bucket"] for r in segments.with_time_bucket(df).collect()]
    assert got == ["unknown"] * 2 + ["very_low"] * 2 + ["low"] * 2 + ["medium"] * 2 + ["high"]


def test_neutral_context(leads_of):
    df = leads_of({"specialization": " select ", "occupation": "", "last_activity": None})
    c = segments.neutral_context(df).first()["context"].asDict()
    assert c["lead_source"] == "Google" and c["time_bucket"] == "medium"
    assert {c["specialization"], c["occupation"], c["last_activity"]} == {C.NOT_GIVEN}


def test_language_mix(spark):
    df = spark.range(5000).withColumnRenamed("id", "lead_id")
    got = segments.assign_language(df, {"tr": 5, "en": 2, "mix": 3})
    share = {r["language"]: r["count"] / 5000 for r in got.groupBy("language").count().collect()}
    for name, want in C.LANGUAGE_MIX.items():
        assert share[name] == pytest.approx(want, abs=0.03)
    with pytest.raises(ValueError):
        segments.assign_language(df, {"tr": -1.0, "en": 2.0})
