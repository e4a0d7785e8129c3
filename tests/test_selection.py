"""Quantiles of many columns in wide passes, and numbering by ranges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrade.plans import selection
from tests.test_plans import check_windows, lines_of


@pytest.mark.parametrize("half", [0.02, 0.0, 1.0])
def test_wide_quantiles_against_numpy(spark, half):
    rng = np.random.default_rng(8)
    rows = [
        (float(rng.normal()), float(rng.integers(0, 4)), None if i % 3 else float(i), 5, None)
        for i in range(3001)
    ] + [(float("nan"), None, 1e300, 5, None), (float("inf"), 2.0, -1e300, 5, None)]
    table = spark.createDataFrame(rows, "a double, b double, c double, d int, e double").repartition(5)
    wanted = {"a": (0.0, 0.5, 0.95, 1.0), "b": (0.5, 0.95), "c": (0.25,), "d": (0.5,), "e": (0.5,)}
    got = {(r["column"], r["prob"]): r for r in selection.wide_quantiles(table, wanted, half).collect()}
    assert len(got) == 9
    for i, (column, probs) in enumerate(wanted.items()):
        values = np.array([r[i] for r in rows if r[i] is not None and r[i] == r[i]], float)
        for p in probs:
            r = got[column, p]
            assert r["n"] == len(values) and r["n_null"] == sum(x[i] is None for x in rows)
            if not len(values):
                assert r["quantile"] is None
                continue
            ordered = np.sort(values)
            assert r["lo"] == ordered[int(np.floor(p * (len(values) - 1)))]
            assert r["hi"] == ordered[int(np.ceil(p * (len(values) - 1)))]
            if np.isfinite(r["hi"]):
                assert r["quantile"] == pytest.approx(np.quantile(values, p))


def test_empty_table(spark):
    table = spark.createDataFrame([], "a double")
    (r,) = selection.wide_quantiles(table, {"a": (0.5,)}).collect()
    assert r["n"] == 0 and r["quantile"] is None


def test_values_are_numbered_in_order(spark):
    rows = [("x", f"v{i:04d}") for i in range(500)] + [("y", "b"), ("y", "a"), ("z", "")]
    table = spark.createDataFrame(rows, "column string, value string").repartition(7)
    numbered = selection.numbered(table, "column", "value")
    got = {(r["column"], r["value"]): r["slot"] for r in numbered.collect()}
    assert all(got["x", f"v{i:04d}"] == i for i in range(500))
    assert got["y", "a"] == 0 and got["y", "b"] == 1 and got["z", ""] == 0
    check_windows(lines_of(numbered))
    windows = [x for x in lines_of(numbered) if "Window [" in x]
    assert windows and all("_b" in x for x in windows)


def test_maps_and_salted_joins_give_the_same_slots(spark, leads_of, monkeypatch):
    from leadgrade.operators import features
    from leadgrade.operators.derive import derive_features

    rows = [{"lead_id": f"l{i}", "lead_source": f"s{i % 3}", "city": "Mumbai" if i % 2 else f"c{i}"} for i in range(120)]
    derived = derive_features(leads_of(*rows), ["lead_id"])
    state = features.fit(derived)
    new = derive_features(leads_of(*rows, {"lead_id": "new", "lead_source": "unseen"}), ["lead_id"])
    by_map = state.transform(new, ["lead_id"])
    assert "SortMergeJoin" not in str(lines_of(by_map)) and str(lines_of(by_map)).count("BroadcastHashJoin") == 0
    monkeypatch.setattr(features, "MAP_BYTES", -1)
    by_join = state.transform(new, ["lead_id"])
    assert sorted(map(str, by_map.collect())) == sorted(map(str, by_join.collect()))
    assert by_map.where("lead_id = 'new'").first()["lead_source_slot"] is None
    assert by_map.where(F.col("city_slot").isNull()).count() == 0
