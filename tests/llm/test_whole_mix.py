"""Budgets among texts of small weight."""

from leadgrade.llm import mixing


TEXTS = "doc_id long, text string"


def test_texts_of_small_weight_stop_at_their_budget(spark):
    docs = [(i, "1234567890 " * (1 + i % 7), "ab"[i % 2]) for i in range(2000)]
    out = mixing.mix(spark.createDataFrame(docs, TEXTS + ", source string"), (1.9, 1.1))
    sums = {r["source"]: r for r in out.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()}
    for r in sums.values():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 0.5
