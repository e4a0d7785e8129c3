"""Missing labels, levels, groups and files that differ: defined results, nothing lost."""

import pytest
from pyspark.sql import functions as F

from leadgrade.functions.text import parsed_attitude
from leadgrade.operators import bootstrap, contingency, leakage, profile, ranking
from leadgrade.sources import readers, sinks

GAPS = [(1, 0.95, None), (2, 0.9, 1), (3, 0.8, 0), (4, 0.7, 1), (5, 0.6, 0), (6, 0.5, None)]


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(GAPS, "lead_id long, score double, converted int")


def test_unlabelled_rows_do_not_count_in_metrics(gaps):
    labelled = gaps.where("converted is not null")
    for rows in (gaps, labelled):
        got = ranking.ranking_metrics(rows, "score", "converted").first()
        assert (got["n"], got["n_positive"], got["roc_auc"]) == (4, 2, 0.75)
    assert ranking.pr_points(gaps, "score", "converted").count() == 4
    assert ranking.roc_points(gaps, "score", "converted").count() == 4


def test_a_level_without_labelled_rows(spark):
    rows = [(i, "a" if i % 2 else "b", i % 3 % 2) for i in range(30)] + [(99, "c", None), (100, None, 1)]
    df = spark.createDataFrame(rows, "lead_id long, tags string, converted int")
    got = leakage.suspect_auc(df, ["tags"]).first()
    assert got["n_unique"] == 4 and got["n_missing"] == 1 and 0 <= got["auc"] <= 1
    folds = leakage.cv_category_auc(df.withColumn("tags", F.lit(None).cast("string")), "tags").first()
    assert folds["n_folds"] == 5 and folds["auc"] == 0.5


def test_null_groups(spark):
    rows = [("a", 0.1, 1), ("a", 0.3, 0), (None, 0.5, 1)]
    df = spark.createDataFrame(rows, "predicted_attitude string, priority double, converted int")
    got = {r["predicted_attitude"]: r for r in profile.segment_stats(df).collect()}
    assert got[None]["n"] == 1 and got[None]["priority_median"] == 0.5 and got["a"]["n"] == 2
    many = spark.range(900).select(
        (F.col("id") % 300).cast("string").alias("g"), F.col("id").cast("double").alias("priority")
    )
    assert profile.five_numbers(many, "priority", "g").count() == 300
    pairs = spark.createDataFrame([("a", "x"), (None, "x"), ("a", None)], "r string, c string")
    assert {(r["r"], r["c"]): r["n"] for r in contingency.crosstab_margins(pairs, "r", "c").collect()} == {
        ("a", "x"): 1, ("All", "x"): 1, ("a", "All"): 1, ("All", "All"): 1
    }


def test_unknown_and_null_labels_are_wrong_answers(spark):
    rows = [("neutral", "neutral")] * 40 + [("objection", "objection")] * 40
    odd = [("neutral", "very_positive")] * 20 + [("objection", None)] * 20
    df = spark.createDataFrame(rows + odd, "t string, g string")
    got = bootstrap.bootstrap_f1(df, "t", "g", draws=200).first()
    assert got["lower"] < 0.8 < got["upper"]


def test_files_with_another_column_order(spark, tmp_path):
    for name, text in (
        ("a.csv", "Prospect ID,City,Country\nx,Mumbai,India\n"),
        ("b.csv", "Country,Prospect ID,City\nIndia,y,Pune\n"),
    ):
        (tmp_path / name).write_text(text)
    got = {r["lead_id"]: (r["city"], r["country"]) for r in readers.read_leads_csv(spark, str(tmp_path)).collect()}
    assert got == {"x": ("Mumbai", "India"), "y": ("Pune", "India")}
    (tmp_path / "c.csv").write_text("Prospect ID,City\nz,Goa\n")
    with pytest.raises(ValueError, match="differ"):
        readers.read_leads_csv(spark, str(tmp_path))


def test_large_lead_numbers_stay_exact(spark):
    df = spark.createDataFrame([("9007199254740993",), ("12.0",)], "lead_number string")
    assert [r[0] for r in readers.typed_leads(df).collect()] == [9007199254740993, 12]


def test_an_attitude_that_is_no_string(spark):
    text = '{"attitude": 5, "x": {"attitude": "objection"}}'
    df = spark.createDataFrame([(text,), ('{"attitude": "neutral"}',)], "c string")
    assert [r[0] for r in df.select(parsed_attitude(F.col("c"))).collect()] == ["objection", "neutral"]


def test_repeats_are_chosen_by_a_stated_order(spark):
    rows = [("a", 1, "old"), ("a", 2, "new"), ("a", 2, "newer"), ("b", 1, "only")]
    df = spark.createDataFrame(rows, "lead_id string, t int, text string")
    for parts in (1, 4):
        got = sinks.one_each(df.repartition(parts), "t").collect()
        assert {r["lead_id"]: r["text"] for r in got} == {"a": "newer", "b": "only"}


def test_empty_notes_stay_out_of_the_report(spark):
    notes = spark.createDataFrame(
        [(i, "t" if i < 8 else "", "neutral" if i % 2 else "objection") for i in range(10)],
        "lead_id long, text string, attitude string",
    )
    leads = spark.range(10).select(F.col("id").alias("lead_id"), (F.col("id") % 3 % 2).cast("int").alias("converted"))
    got = leakage.leakage_report(notes, leads.withColumn("tags", F.lit("x"))).collect()
    assert [r["value"] for r in got if (r["section"], r["metric"]) == ("balance", "n")] == [8.0]
    assert any(r["section"] == "flag" for r in got)
