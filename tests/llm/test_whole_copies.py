"""Copies of texts without words."""

from leadgrade.llm import near_dup


TEXTS = "doc_id long, text string"


def test_one_copy_of_a_wordless_text_is_kept(spark):
    docs = [(i, "=====") for i in range(5)] + [(i, "...") for i in range(5, 8)] + [(8, None), (9, None), (10, "a word")]
    kept = near_dup.keep_one(spark.createDataFrame(docs, TEXTS)).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 5, 8, 9, 10]
