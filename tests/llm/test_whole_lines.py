"""Clean lines with digits."""

import corpus_pipeline


TEXTS = "doc_id long, text string"


def test_rows_of_numbers_stay_in_the_pipeline(spark):
    texts = [f"{i} {i * 7} {i * 13}\nTable {i}\n第{i}段落のきれいな文\nAll rights are reserved\nSeen on page {i} of this site today" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), TEXTS)
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_recurring_lines(spark, docs, "").collect()}
    assert got == {i: "\n".join(t.split("\n")[:3]) for i, t in enumerate(texts)}
