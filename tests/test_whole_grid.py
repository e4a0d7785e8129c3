"""The tree queries search the whole grid."""

import pytest

from leadgrade.operators import models
from leadgrade.registry import model_queries


@pytest.mark.parametrize("query", ["train_gbt", "feature_importance"])
def test_tree_queries_search_the_whole_grid(spark, monkeypatch, query):
    seen = {}

    class Stop(Exception):
        pass

    def best(estimator, grid, table, k, parallelism):
        seen.update(cells=[{p.name: v for p, v in cell.items()} for cell in grid], k=k)
        raise Stop

    monkeypatch.setattr(model_queries, "prepared", lambda *_, **__: (None, None, None))
    monkeypatch.setattr(models, "_best", best)
    with pytest.raises(Stop):
        getattr(model_queries, query)(None, None)
    assert len(seen["cells"]) == 12 and seen["k"] == 5
    assert {c["maxIter"] for c in seen["cells"]} == {100, 300}
