import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.operators import priority
from leadgrade.plans import workflows
from leadgrade.sources.schema import RAW_LEAD_SCHEMA
from tests.conftest import raw_row


@pytest.fixture(scope="module")
def leads(spark):
    rng = np.random.default_rng(6)
    names = RAW_LEAD_SCHEMA.fieldNames()
    rows = []
    for i in range(400):
        time = float(rng.integers(0, 2000))
        row = raw_row(
            lead_id=f"l{i:04d}",
            converted=int(time / 2000 + rng.normal(0, 0.25) > 0.55),
            total_time_spent=time,
            last_activity=("SMS Sent", "Email Opened", "Unsubscribed")[i % 3],
        )
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, RAW_LEAD_SCHEMA)


@pytest.fixture(scope="module")
def notes(spark, leads):
    label = F.get(F.array(*[F.lit(a) for a in C.ATTITUDES]), F.pmod(F.hash("lead_id"), F.lit(4)))
    return leads.select(
        "lead_id",
        label.alias("attitude"),
        F.lit("en").alias("language"),
        F.concat(F.lit("a note that shows "), label).alias("text"),
    )


def by_text(batch):
    label = F.regexp_extract("text", "shows (.*)$", 1)
    return batch.select(
        "lead_id",
        "language",
        "true_attitude",
        label.alias("predicted_attitude"),
        F.lit("by-text").alias("model_name"),
        F.lit(1).alias("prompt_tokens"),
        F.lit(1).alias("completion_tokens"),
        F.lit(0.1).alias("latency_ms"),
    )


def test_from_raw_leads_to_a_ranked_list(spark, leads, notes, tmp_path):
    root = str(tmp_path)
    stored = workflows.split_leads(leads, f"{root}/split")
    assert {r["split"]: r["count"] for r in stored.groupBy("split").count().collect()} == pytest.approx(
        {"train": 240, "val": 80, "test": 80}, abs=1
    )
    state = workflows.fit_features(stored, f"{root}/state")
    assert state.n_rows == stored.where("split = 'train'").count()
    report = workflows.train_and_report(
        stored,
        state,
        f"{root}/models",
        lr_grid=(0.1, 1.0),
        tree_grid={"maxDepth": (2,), "stepSize": (0.1,), "maxIter": (5,)},
        draws=50,
        k=2,
    )
    rows = {(r["model"], r["section"], r["key"], r["metric"]): r["value"] for r in report.collect()}
    for kind in ("logistic_regression", "boosted_trees"):
        assert rows[(kind, "ranking", "test", "roc_auc")] > 0.75
        assert rows[(kind, "ranking", "test", "n")] == pytest.approx(80, abs=1)
        assert rows[(kind, "interval", "roc_auc", "lower")] <= rows[(kind, "ranking", "test", "roc_auc")]
        assert (kind, "calibration", "0", "bin_mean_pred") in rows
        assert rows[(kind, "gain", "0.3", "k")] == 24
    assert rows[("logistic_regression", "best_params", "search", "C")] in (0.1, 1.0)
    assert ("both", "trees_minus_logistic", "auc_difference", "lower") in rows

    predictions = workflows.evaluate_notes(notes, by_text, f"{root}/pred", batch_rows=15)
    assert predictions.count() == predictions.select("lead_id").distinct().count()
    assert 30 <= predictions.count() <= 50
    again = workflows.evaluate_notes(notes, by_text, f"{root}/pred")
    assert again.count() == predictions.count()
    fewer = workflows.evaluate_notes(notes, by_text, f"{root}/pred", limit=5, force_refresh=True)
    assert fewer.count() == 5

    full = by_text(notes.withColumnRenamed("attitude", "true_attitude"))
    ranked = workflows.rank_leads(
        leads, full, state, f"{root}/models/boosted_trees", f"{root}/ranked"
    )
    assert ranked.count() == 400
    top = priority.top_leads(ranked, 20, 0.5).collect()
    assert len(top) == 20 and top[0]["model_kind"] == "boosted_trees"
    assert [r["priority"] for r in top] == sorted((r["priority"] for r in top), reverse=True)
    with pytest.raises(ValueError, match="predictions join a lead"):
        workflows.rank_leads(
            leads.limit(10), full, state, f"{root}/models/boosted_trees", f"{root}/no"
        )


def test_leakage_report(spark, leads, notes, tmp_path):
    report = workflows.write_leakage_report(spark, notes, leads, str(tmp_path / "r"))
    rows = {(r["section"], r["key"], r["metric"]): r["value"] for r in report.collect()}
    assert rows[("balance", "all", "n")] == 400
    assert sum(v for (s, _, m), v in rows.items() if s == "attitude" and m == "n") == 400
    assert 0 <= rows[("association", "all", "cramers_v")] <= 1
    assert ("suspect", "tags", "auc") in rows
