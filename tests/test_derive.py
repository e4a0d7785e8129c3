import pytest

from leadgrade import constants as C
from leadgrade.operators.derive import derive_features
from leadgrade.sources.schema import MissingColumnsError


def column(df, name):
    return [r[name] for r in df.orderBy("lead_id").select(name).collect()]


def derived(leads_of, *changes):
    rows = [{"lead_id": f"{i:03d}", **c} for i, c in enumerate(changes)]
    return derive_features(leads_of(*rows), ["lead_id"])


def test_columns_and_order(leads_of):
    out = derive_features(leads_of({}))
    assert tuple(out.columns) == C.DERIVED_ORDER
    assert len(out.columns) == 25


def test_ids_outcomes_and_dead_flags_are_gone(leads_of):
    out = derive_features(leads_of({}))
    gone = {*C.ID_COLUMNS, *C.POST_OUTCOME_COLUMNS, *C.DEAD_FLAGS, *C.CHANNEL_FLAGS}
    assert not gone & set(out.columns)


def test_missing_columns_are_named(leads_of):
    with pytest.raises(MissingColumnsError, match="lead_source.*city|city.*lead_source"):
        derive_features(leads_of({}).drop("lead_source", "city"))


def test_select_becomes_null_in_every_categorical(leads_of):
    out = derived(leads_of, {"specialization": "Select", "lead_origin": "Select"})
    row = out.first()
    assert row["specialization"] is None and row["heard_about"] is None
    assert row["lead_origin"] is None and row["city"] == "Mumbai"


def test_country_flag(leads_of):
    values = ("India", "United States", None, " India\t", "india")
    out = derived(leads_of, *[{"country": c} for c in values])
    assert column(out, "country_is_india") == [1, 0, 0, 1, 0]


def test_activity_flags(leads_of):
    names = (
        "SMS Sent",
        "Had a Phone Conversation",
        "Email Opened",
        "Email Bounced",
        "Unsubscribed",
        "Page Visited on Website",
        None,
        " SMS Sent",
    )
    out = derived(leads_of, *[{"last_activity": a} for a in names])
    assert column(out, "is_high_intent_activity") == [1, 1, 0, 0, 0, 0, 0, 0]
    assert column(out, "is_negative_activity") == [0, 0, 0, 1, 1, 0, 0, 0]


def test_time_per_visit(leads_of):
    visits = (None, 0.0, 10.0, 0.5, -2.0)
    out = derived(leads_of, *[{"total_visits": v} for v in visits])
    assert column(out, "total_time_per_visit") == [500.0, 500.0, 50.0, 1000.0, 500.0]


def test_null_time_stays_null(leads_of):
    out = derived(leads_of, {"total_time_spent": None})
    assert column(out, "total_time_per_visit") == [None]


def test_channel_count(leads_of):
    out = derived(
        leads_of,
        {
            "newspaper_article": "Yes",
            "newspaper": " YES",
            "search": "yes\n",
            "education_forums": "No",
            "digital_advertisement": None,
        },
    )
    assert column(out, "channel_diversity_count") == [3]


def test_yes_no(leads_of):
    out = derived(leads_of, *[{"do_not_email": v} for v in ("Yes", "no", None, "1")])
    assert column(out, "do_not_email") == [1, 0, 0, 0]
