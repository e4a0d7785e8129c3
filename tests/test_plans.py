"""Plan shapes: no one-task windows, bounded nested-loop joins, pruned scans."""

import re

import pytest

import __spark_entry__ as entry
from leadgrade.registry import all_queries

EAGER = {
    "trained_splits",
    "tree_contributions",
    "contributions_add_up",
    "model_bundle",
    "model_bundle_sizes",
    "scored_leads",
    "classified_notes",
    "train_lr",
    "train_gbt",
    "feature_importance",
    "score_leads",
    "classify_notes",
    "read_leads_csv",
    "score_json_records",
    "sink_dual",
    "report_roundtrip",
    "resume_predictions",
    "state_roundtrip",
    "stream_score",
    "stream_latest_note",
    "stream_resume",
    "bootstrap_ci",
    "paired_bootstrap",
}
LAZY = sorted(set(all_queries.QUERIES) - EAGER)


def lines_of(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def depth(line):
    return len(re.match(r"[\s:|+\-]*", line).group())


def children_until_exchange(lines, i):
    """Lines below operator i, down to the first exchange."""
    out = []
    for line in lines[i + 1 :]:
        if depth(line) <= depth(lines[i]):
            break
        out.append(line)
        if "Exchange" in line:
            break
    return out


@pytest.mark.parametrize("name", LAZY)
def test_plan_shape(spark, sf_dir, name):
    """No window in one task; cross joins only attach one aggregated row."""
    lines = lines_of(entry.queries()[name](spark, sf_dir))
    check_windows(lines)
    check_nested_loops(lines)


def check_windows(lines):
    for i, line in enumerate(lines):
        if re.search(r"[+:]- \*?(\(\d+\) )?Window(GroupLimit)? ", line):
            below = children_until_exchange(lines, i)
            assert not any("SinglePartition" in x for x in below), line
    assert not any("CartesianProduct" in x for x in lines)


def check_nested_loops(lines):
    for i, line in enumerate(lines):
        if "BroadcastNestedLoopJoin" not in line:
            continue
        right = [
            j
            for j in range(i + 1, len(lines))
            if "BroadcastExchange IdentityBroadcastMode" in lines[j] and depth(lines[j]) > depth(line)
        ]
        assert right, line
        below = lines[right[0] + 1 : right[0] + 8]
        one_row = any(
            "HashAggregate(keys=[], " in x or "SortAggregate(key=[], " in x for x in below
        )
        assert one_row, "\n".join([line, *below])


def test_scans_read_only_needed_columns(spark, sf_dir):
    text = "\n".join(lines_of(entry.queries()["class_balance"](spark, sf_dir)))
    assert "o_totalprice" not in text and "l_orderkey" not in text
    assert "c_acctbal" not in text


def test_ordering_reuses_its_exchanges(spark, sf_dir):
    df = entry.queries()["roc_auc"](spark, sf_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    # Two sketches would mean two sets of edges that need not agree.
    assert final.count("partial_percentile_approx") == 1


@pytest.mark.parametrize("name", ["rank_by_score", "clip_thresholds", "priority_quartiles", "model_metrics", "cv_category_auc"])
def test_one_set_of_edges_per_ordering(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("partial_percentile_approx") == 1


def test_every_query_with_sql_has_matching_columns():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 95


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 10


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def one_table(spark, tmp_path_factory):
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("rows") / "t")
    spark.range(2000).select(
        F.col("id").alias("lead_id"),
        (F.pmod(F.hash("id"), F.lit(100)) / 100).alias("p"),
        (F.col("id") % 2).cast("int").alias("converted"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_an_ordering_reads_its_table_once(one_table):
    from leadgrade.operators import ranking
    from leadgrade.plans import ordered

    auc = final_plan(ranking.ranking_metrics(one_table, "p", "converted"))
    assert auc.count("FileScan") == 1
    median = final_plan(ordered.quantiles(one_table, "p", {"m": 0.5}))
    assert median.count("FileScan") == 3  # sketch, bucket counts, wanted buckets
    assert median.count("partial_percentile_approx") == 1
    rank = final_plan(ranking.rank_rows(one_table, "p"))
    assert rank.count("FileScan") == 2
    gain = final_plan(ranking.gain_at_fraction(one_table, "p", "converted"))
    assert gain.count("FileScan") == 3


def test_a_split_never_shuffles_the_table(one_table):
    from leadgrade.operators import splits

    plan = final_plan(splits.split_60_20_20(one_table))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
