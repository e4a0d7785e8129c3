"""The shortest items."""

import numpy as np

from leadgrade.llm import decontaminate


TEXTS = "doc_id long, text string"


def test_five_word_items_are_always_found(spark):
    rng = np.random.default_rng(1)
    words = lambda n: [f"v{k}" for k in rng.integers(0, 10**6, n)]
    items = [(i, " ".join(words(5))) for i in range(600)]
    docs = [(i, " ".join([*words(60), text, *words(60)])) for i, text in items]
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, TEXTS), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(i, i) for i in range(600)]
