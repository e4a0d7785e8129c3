"""The registered queries and the pipeline over whole tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from leadgrade.llm import queries

COLUMNS = {
    "op1_": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_": ["doc_id", "item_id", "containment"],
    "op3_": ["doc_id", "n_tokens"],
    "op4_": ["query_id", "rank", "vec_id", "score"],
    "op5_": ["page_id", "url", "text", "n_chars"],
    "op6_": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_": ["doc_id", "class_id", "class_size"],
    "op8_": ["doc_id", "held_out", "score", "predicted"],
    "op9_": ["doc_id", "start_word", "end_word", "class_id"],
    "op10_": ["doc_id", "text", "n_lines", "n_dropped"],
    "op11_": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op12_": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op13_": [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    ],
}


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(n.split("_")[0] + "_" for n in names) == sorted(COLUMNS)
    assert "pipeline" in entry.queries() and set(queries.ORACLES) <= set(queries.QUERIES)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "near_dedup", "decontamination", "source_mixing"
    ]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        counts.append(docs.count())
        if name != "source_mixing":
            assert docs.columns == names
    assert counts[1] >= 0.97 * counts[0] and counts[2] == counts[1] and counts[3] < counts[2]
    assert counts[4] < counts[3] and {"size", "source_size", "target", "taken"} <= set(docs.columns)


@pytest.mark.parametrize("name", ["op2_decontamination", "op6_source_mixing", "op8_line_quality", "op11_hard_negatives",
                                  "op12_centroid_clusters", "op13_quality_rules"])
def test_columns(spark, sf_dir, name):
    found = queries.QUERIES[name](spark, sf_dir).columns
    assert set(COLUMNS[name.split("_")[0] + "_"]) <= set(found)
