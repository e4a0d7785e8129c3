"""Top lists out of the stored ranking, and distinct counts out of kept sketches."""

import pytest
from pyspark.sql import functions as F

from leadgrade.operators import priority, sketches
from leadgrade.sources import ranked


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    table = spark.range(4000).select(
        F.col("id").alias("lead_id"),
        F.when(F.col("id") % 50 == 7, F.lit(None)).otherwise(F.round(F.rand(3), 2)).alias("priority"),
    )
    path = str(tmp_path_factory.mktemp("ranked"))
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many files as partitions
    table = table.cache()
    ranked.write_ranked(table, path)
    spark.conf.set("spark.sql.adaptive.enabled", kept)
    return table, path


@pytest.mark.parametrize("n, floor", [(0, 0.0), (1, 0.0), (10, 0.5), (700, 0.0), (900, 0.9), (100_000, 0.0), (100_000, 0.31), (5, 1.0)])
def test_lists_agree_with_the_whole_table(spark, stored, n, floor):
    table, path = stored
    got = ranked.top_leads(spark, path, n, floor)
    want = priority.top_leads(table, n, floor).collect()
    assert [tuple(r)[:2] for r in got.collect()] == [tuple(r) for r in want]
    assert {r["total_available"] for r in got.collect()} <= {4000}
    assert ranked.count_above(spark, path, 0.31) == table.where("priority >= 0.31").count()


def test_few_files_are_read(spark, stored):
    _, path = stored
    files = len(ranked.files_for(spark, path, 10**9))
    assert files >= 8
    assert len(ranked.files_for(spark, path, 10)) <= 2  # the next file may hold ties
    assert len(ranked.files_for(spark, path, 10, 0.4)) <= 2
    assert len(ranked.files_for(spark, path, 600)) <= 4
    assert len(ranked.files_for(spark, path, 10**9, 0.9)) <= 3
    assert ranked.total(spark, path) == 4000


def test_equal_priorities_over_all_files(spark, tmp_path):
    table = spark.range(300).select(F.col("id").alias("lead_id"), F.lit(0.5).alias("priority")).repartition(6)
    ranked.write_ranked(table, str(tmp_path))
    got = ranked.top_leads(spark, str(tmp_path), 4, 0.5).collect()
    assert [r["lead_id"] for r in got] == [0, 1, 2, 3]
    ranked.write_ranked(table.limit(0), str(tmp_path / "none"))
    assert ranked.top_leads(spark, str(tmp_path / "none"), 4).collect() == []
    with pytest.raises(ValueError, match="min_priority"):
        ranked.top_leads(spark, str(tmp_path), 4, 2.0)


def test_sketches_of_loads_unite(spark):
    rows = spark.range(30_000).select(
        (F.col("id") % 3).alias("load"),
        (F.col("id") % 9000).alias("a"),
        F.when(F.col("id") % 2 == 0, F.lit("x")).alias("b"),
        F.lit(None).cast("string").alias("c"),
    )
    kept = sketches.distinct_sketches(rows, ["a", "b", "c"], "load")
    assert kept.count() == 9
    got = {r["column"]: r for r in sketches.distinct_counts(kept).collect()}
    assert abs(got["a"]["n_estimate"] - 9000) < 180
    assert got["b"]["n_estimate"] == 1 and got["b"]["n_null"] == 15_000
    assert got["c"]["n_estimate"] == 0 and got["c"]["n_null"] == 30_000
