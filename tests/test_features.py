import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.operators import features
from leadgrade.operators.derive import derive_features
from leadgrade.sources import state_store


def many(leads_of, n=120):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        absent = i % 3 == 0
        rows.append(
            {
                "lead_id": f"{i:04d}",
                "converted": int(i % 5 < 2),
                "total_visits": None if i % 10 == 0 else float(rng.integers(0, 30)),
                "total_time_spent": float(rng.integers(0, 2000)),
                "page_views_per_visit": None if i % 10 == 0 else float(rng.random() * 5),
                "activity_score": None if absent else float(10 + i % 7),
                "profile_score": None if absent else float(12 + i % 5),
                "activity_index": None if absent else "02.Medium",
                "lead_source": "Google" if i % 2 else ("Rare" if i == 50 else "Chat"),
                "specialization": "Select" if i % 4 == 0 else "Finance",
            }
        )
    return derive_features(leads_of(*rows), ["lead_id", "converted"]), rows


@pytest.fixture
def fitted(leads_of):
    derived, rows = many(leads_of)
    return derived, features.fit(derived), rows


def test_params_match_numpy(fitted):
    _, state, rows = fitted
    for p in state.numeric:
        if p.column not in C.CLIPPED_NUMERIC:
            continue
        raw = np.array([np.nan if r[p.column] is None else r[p.column] for r in rows])
        clip = np.nanpercentile(raw, 95)
        clipped = np.minimum(raw, clip)
        filled = np.where(np.isnan(clipped), np.nanmedian(clipped), clipped)
        assert p.clip == pytest.approx(clip)
        assert p.impute == pytest.approx(np.nanmedian(clipped))
        assert p.mean == pytest.approx(filled.mean())
        assert p.std == pytest.approx(filled.std())
        assert p.has_indicator == bool(np.isnan(raw).any())


def test_median_of_two_clipped_values(leads_of):
    rows = [{"lead_id": "a", "total_visits": 1.0}, {"lead_id": "b", "total_visits": 9.0}]
    state = features.fit(derive_features(leads_of(*rows)))
    p = next(p for p in state.numeric if p.column == "total_visits")
    clip = np.percentile([1.0, 9.0], 95)
    assert p.impute == pytest.approx(np.median(np.minimum([1.0, 9.0], clip)))


def test_no_missing_cells_after_transform(fitted):
    derived, state, _ = fitted
    flat = state.transform(derived, ["lead_id"])
    bad = features.missing_cells(flat, list(state.numeric_columns()))
    assert bad.where("n_null + n_nan + n_inf > 0").count() == 0


def test_indicator_only_where_nulls_were_seen(fitted):
    _, state, _ = fitted
    names = [p.column for p in state.indicators()]
    assert names == ["total_visits", "page_views_per_visit", "activity_score", "profile_score"]


def test_rare_values_share_a_slot_and_unseen_encode_to_zero(fitted, leads_of):
    _, state, _ = fitted
    slots = {
        (r["column"], r["value"]): r["slot_name"] for r in state.slots.collect()
    }
    assert slots[("lead_source", "Google")] == "lead_source_Google"
    assert slots[("lead_source", "Rare")] == "lead_source_infrequent"
    new = derive_features(leads_of({"lead_id": "x", "lead_source": "Never Seen"}), ["lead_id"])
    assert state.transform(new, ["lead_id"]).first()["lead_source_slot"] is None
    array = state.vectors(new, ["lead_id"]).select(vector_to_array("features")).first()[0]
    names = [r["name"] for r in state.catalog().orderBy("block", "major", "slot").collect()]
    hot = {n: v for n, v in zip(names, array, strict=True) if n.startswith("lead_source_")}
    assert set(hot.values()) == {0.0}


def test_vector_matches_catalog_and_flat_columns(fitted):
    derived, state, _ = fitted
    names = [r["name"] for r in state.catalog().orderBy("block", "major", "slot").collect()]
    vectors = state.vectors(derived, ["lead_id"])
    row = vectors.orderBy("lead_id").select(vector_to_array("features").alias("v")).first()
    flat = state.transform(derived, ["lead_id"]).orderBy("lead_id").first().asDict()
    assert len(row["v"]) == len(names)
    for name, value in zip(names, row["v"], strict=True):
        if name in flat:
            assert value == pytest.approx(float(flat[name]))


def test_row_order_does_not_matter(fitted):
    derived, state, _ = fitted
    again = features.fit(derived.orderBy(F.rand(5)))
    assert again.numeric == pytest.approx(state.numeric) or all(
        a.clip == b.clip and a.impute == b.impute
        for a, b in zip(again.numeric, state.numeric, strict=True)
    )
    key = ("column", "value", "slot_name")
    one = {tuple(r[k] for k in key) for r in state.slots.collect()}
    two = {tuple(r[k] for k in key) for r in again.slots.collect()}
    assert one == two


def test_large_category_table_joins_without_broadcast(fitted):
    derived, state, _ = fitted
    state.slots_small = False
    assert state.transform(derived, ["lead_id"]).count() == derived.count()


def test_sketched_state_is_close(fitted):
    derived, state, _ = fitted
    rough = features.fit(derived, exact=False)
    for a, b in zip(rough.numeric, state.numeric, strict=True):
        assert a.has_indicator == b.has_indicator
        assert a.impute == pytest.approx(b.impute, rel=0.1, abs=0.6)
        if b.clip is not None:
            assert a.clip == pytest.approx(b.clip, rel=0.15)


def test_state_round_trip_and_version_check(fitted, spark, tmp_path):
    derived, state, _ = fitted
    path = str(tmp_path / "state")
    state_store.save_state(state, path)
    loaded = state_store.load_state(spark, path)
    assert loaded.numeric == state.numeric
    a = state.transform(derived, ["lead_id"]).orderBy("lead_id").collect()
    b = loaded.transform(derived, ["lead_id"]).orderBy("lead_id").collect()
    assert a == b
    meta = spark.createDataFrame([("feature_state", 99, 1, [])], state_store._META)
    meta.write.mode("overwrite").json(f"{path}/meta")
    with pytest.raises(ValueError, match="newer"):
        state_store.load_state(spark, path)


def test_safe_names():
    names = ["specialization_Banking, Investment", 'a[b]{c}":d', "plain"]
    assert features.safe_names(names) == [
        "specialization_Banking_ Investment",
        "a_b__c___d",
        "plain",
    ]
