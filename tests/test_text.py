import json

from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions import prompts, text
from leadgrade.operators import notes, segments

GOOD = '{"attitude": "objection"}'
CASES = [
    (GOOD, "objection"),
    ('  {"attitude": " Neutral "}\n', "neutral"),
    ('```json\n{"attitude": "positive_engagement"}\n```', "positive_engagement"),
    ('```\n{"attitude": "neutral"}\n```', "neutral"),
    ('The lead worries about price, so {"attitude": "objection"}', "objection"),
    ('{"attitude": "neutral"}\n{"attitude": "disengaged"}', "disengaged"),
    ('{"attitude": broken} {"attitude": "disengaged"}', "disengaged"),
    ('{"note": "{\\"attitude\\": \\"neutral\\"}", "attitude": "objection"}', "objection"),
    ('{"reason": "price", "attitude": "objection"}', "objection"),
    ("The lead seems fine.", None),
    ('{"attitude": "very_positive"}', None),
    ('{"attitude": 5}', None),
    ('["objection"]', None),
    ("", None),
    (None, None),
]


def test_parse_replies(spark):
    df = spark.createDataFrame(
        [(i, c) for i, (c, _) in enumerate(CASES)], "lead_id int, content string"
    )
    got = notes.parse_replies(df).orderBy("lead_id").collect()
    for row, (content, label) in zip(got, CASES, strict=True):
        assert row["predicted_attitude"] == label, content
        assert row["status"] == ("ok" if label else "malformed")
        assert row["sentiment_score"] == (C.ATTITUDE_SCORES[label] if label else None)


def body(content, reasoning=None, **usage):
    message = {"role": "assistant", "content": content, "reasoning": reasoning}
    out = {"choices": [{"index": 0, "message": message, "finish_reason": "stop"}]}
    return json.dumps({**out, "usage": usage} if usage else out)


def test_reply_content(spark):
    rows = [
        (0, body(GOOD, "thought", prompt_tokens=7, completion_tokens=3, total_tokens=10)),
        (1, body(None, f"thinking {GOOD}")),
        (2, body(" \n", "thinking")),
        (3, body(None)),
        (4, json.dumps({"choices": []})),
        (5, "no json"),
    ]
    df = spark.createDataFrame(rows, "lead_id int, body string")
    got = notes.extract_replies(df).orderBy("lead_id").collect()
    assert [r["content"] for r in got] == [GOOD, f"thinking {GOOD}", "thinking", None, None, None]
    assert [r["prompt_tokens"] for r in got] == [7, 0, 0, 0, 0, 0]
    assert got[0]["total_tokens"] == 10


def test_fallback(spark):
    rows = [
        ("ok", "objection"),
        ("config_error", None),
        ("openrouter_rate_limit", None),
        ("openrouter_unavailable", "objection"),
        ("permanent", None),
        ("malformed", None),
    ]
    df = spark.createDataFrame(rows, "status string, predicted_attitude string")
    got = {r["status"]: r for r in notes.with_fallback(df).collect()}
    assert got["ok"]["attitude"] == "objection" and not got["ok"]["sentiment_unavailable"]
    for status in C.TRANSIENT_STATUSES:
        assert got[status]["attitude"] == "neutral"
        assert got[status]["sentiment_score"] == 0.40
        assert got[status]["fallback_reason"] == status
    for status in C.HARD_STATUSES:
        assert got[status]["attitude"] is None and got[status]["fallback_reason"] is None


def test_slug(spark):
    names = ["vendor/Model-3.3-70b:free", "plain", "a/b/c:x:y", "v/--X_y--"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in df.select(text.model_slug(F.col("name"))).collect()]
    assert got == ["model-3-3-70b", "plain", "b-c", "x-y"]


def test_token_totals(spark):
    df = spark.createDataFrame([(5, 2), (5, None), (None, 2)], "p int, c int")
    got = [r[0] for r in df.select(text.token_total(F.col("p"), F.col("c"))).collect()]
    assert got == [7, 5, None]


def test_length_gate(spark):
    df = spark.createDataFrame([("",), (None,), ("x",), ("x" * 4000,), ("x" * 4001,)], "text string")
    got = notes.note_length_gate(df).collect()
    assert [r["reject_reason"] for r in got] == ["too_short", "too_short", None, None, "too_long"]
    assert len(got[4]["text"]) == 4001


def test_classify_prompt(spark):
    df = spark.createDataFrame([("hello",)], "text string")
    messages = df.select(prompts.classify_messages(F.col("text"))).first()[0]
    assert [m["role"] for m in messages] == ["system"] + ["user", "assistant"] * 8 + ["user"]
    assert messages[-1]["content"] == "hello"
    labels = [json.loads(m["content"])["attitude"] for m in messages[2:-1:2]]
    assert sorted(set(labels)) == sorted(C.ATTITUDES) and len(labels) == 8


def test_write_prompt_hides_the_outcome_and_fills_once(spark, leads_of):
    leads = leads_of({"lead_source": "{occupation}", "tags": "SECRET-TAG", "city": "Select"})
    rows = segments.neutral_context(leads)
    message = prompts.write_messages(F.lit("objection"), F.lit("en"), F.col("context"))
    system, user = rows.select(message).first()[0]
    assert system["role"] == "system" and user["role"] == "user"
    assert "{occupation}" in user["content"] and user["content"].count("Unemployed") == 1
    assert "SECRET-TAG" not in user["content"] and "Write the note entirely" in user["content"]
    assert "converted" not in user["content"].lower()


def test_hook_sees_whole_texts(spark):
    long = "word " * 20_000
    df = spark.createDataFrame([("a", long), ("b", "short")], "lead_id string, text string")
    got = notes.classify_with(df, lambda s: s.str.len().map(str)).collect()
    assert {r[0]: r[1] for r in got} == {"a": str(len(long)), "b": "5"}


def test_latest_note(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "k string, t int, text string"
    )
    got = notes.latest_note(df, "k", F.col("t"), "t", "text").collect()
    assert {r["k"]: r["text"] for r in got} == {"a": "z", "b": "q"}


def test_note_classifier_learns(spark):
    words = {"positive_engagement": "demo", "objection": "price", "neutral": "info", "disengaged": "silent"}
    rows = [
        (f"{a}{i}", a, f"the lead said {w} number {i}") for a, w in words.items() for i in range(15)
    ]
    df = spark.createDataFrame(rows, "lead_id string, attitude string, text string")
    model = notes.train_note_classifier(df, features=1 << 8)
    got = notes.classify_notes(model, df.select("lead_id", "text")).collect()
    right = sum(r["lead_id"].startswith(r["predicted_attitude"]) for r in got)
    assert right >= 55
