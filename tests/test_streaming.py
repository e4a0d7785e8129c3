import json

from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.operators import features, models
from leadgrade.operators.derive import derive_features
from leadgrade.sources.readers import read_predictions
from leadgrade.sources.schema import NOTE_SCHEMA
from leadgrade.streaming import jobs
from tests.conftest import raw_row

HEADERS = {alias: name for name, alias in C.RAW_COLUMNS.items()}


def line(lead_id, note="asked for a demo", drop=(), **extra):
    lead = {HEADERS[k]: v for k, v in raw_row(lead_id=lead_id).items() if k not in drop}
    return json.dumps({"lead": lead, "interaction_text": note, **extra})


def flat_scorer(leads):
    return leads.withColumn("p_conversion", F.lit(0.5))


def test_score_stream(spark, tmp_path):
    source, target, state = (tmp_path / n for n in ("in", "out", "state"))
    source.mkdir()
    (source / "a.json").write_text(
        "\n".join(
            [
                line("ok", attitude="objection"),
                line("limited", status="openrouter_rate_limit"),
                line("empty", note="", attitude="neutral"),
                line("cut", drop=("city",), attitude="neutral"),
                line("hard", status="permanent"),
            ]
        )
    )

    def run():
        q = jobs.score_stream(spark, str(source), str(target), str(state), flat_scorer)
        q.awaitTermination()
        return {r["lead_id"]: r for r in spark.read.parquet(str(target)).collect()}

    got = run()
    assert set(got) == {"ok", "limited", "hard"}
    refused = {r["lead_id"]: r for r in spark.read.parquet(f"{target}-rejects").collect()}
    assert {k: r["reject_reason"] for k, r in refused.items()} == {
        "empty": "bad_note_length",
        "cut": "missing_lead_columns",
    }
    assert json.loads(refused["empty"]["request"])["attitude"] == "neutral"
    assert got["ok"]["priority"] == 0.56 and got["ok"]["reject_reason"] is None
    assert got["limited"]["attitude"] == "neutral" and got["limited"]["priority"] == 0.46
    assert got["limited"]["fallback_reason"] == "openrouter_rate_limit"
    assert got["hard"]["reject_reason"] == "unknown_attitude" and got["hard"]["priority"] is None
    (source / "b.json").write_text(line("late", attitude="neutral"))
    assert set(run()) == {"ok", "limited", "hard", "late"}
    assert spark.read.parquet(str(target)).count() == 4


def test_score_stream_with_a_trained_model(spark, tmp_path, leads_of):
    rows = [
        {"lead_id": f"l{i:03d}", "converted": i % 2, "total_time_spent": 100.0 + 900 * (i % 2)}
        for i in range(60)
    ]
    derived = derive_features(leads_of(*rows), ["lead_id", "converted"])
    state = features.fit(derived)
    trained = models.train_logistic(models.training_table(state, derived, k=2), (1.0,))
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(line("x", attitude="objection"))
    q = jobs.score_stream(
        spark,
        str(source),
        str(tmp_path / "out"),
        str(tmp_path / "state"),
        jobs.model_scorer(state, trained.model),
    )
    q.awaitTermination()
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert row["lead_id"] == "x" and 0.0 < row["p_conversion"] < 1.0


def test_latest_note_survives_late_rows(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "k string, ts timestamp, n long, text string"
    for rows in (
        [("a", "2024-01-01 00:01:00", 1, "old"), ("b", "2024-01-01 00:01:00", 2, "only")],
        [("a", "2024-01-02 00:00:00", 3, "new"), ("a", "2024-01-02 00:00:00", 4, "tie wins")],
        [("a", "2023-01-01 00:00:00", 5, "late")],
    ):
        df = spark.createDataFrame(rows, "k string, ts string, n long, text string")
        df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        jobs.keep_latest(events, "k", "ts", "n", ["text"], target, state).awaitTermination()
    got = jobs.read_latest(spark, target, "k", "ts", "n").collect()
    assert {r["k"]: r["text"] for r in got} == {"a": "tie wins", "b": "only"}


def test_latest_note_by_window_drops_state_after_the_delay(spark, tmp_path):
    schema = "k string, ts timestamp, n long, text string"
    files = [
        [("a", "2024-01-01 00:01:00", 1, "old"), ("a", "2024-01-01 00:05:00", 2, "new")],
        [("a", "2024-01-01 03:00:00", 3, "next")],
        [("a", "2024-01-01 00:06:00", 4, "far too late"), ("a", "2024-01-01 06:00:00", 5, "end")],
    ]
    for i, rows in enumerate(files):
        df = spark.createDataFrame(rows, "k string, ts string, n long, text string")
        typed = df.withColumn("ts", F.col("ts").cast("timestamp"))
        typed.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = jobs.note_windows(events, "k", "ts", "n", "30 minutes", "1 hour", "text")
        q = (
            out.writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("ts").collect()
    assert [r["text"] for r in got] == ["new", "next"]


def test_repeats_within_the_delay_are_dropped(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:02:00")]
    df = spark.createDataFrame(rows, "k string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema("k string, ts timestamp").parquet(str(tmp_path / "in"))
    q = (
        jobs.unique_notes(events, "ts", "10 minutes", ["k"])
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_resume_classifies_each_lead_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    seen = spark.sparkContext.accumulator(0)

    def classify(batch):
        def label(texts):
            seen.add(len(texts))
            return texts.map(lambda _: "neutral")

        from leadgrade.operators.notes import classify_with

        labels = classify_with(batch, label)
        return batch.select("lead_id", "language", F.col("attitude").alias("true_attitude")).join(
            labels, "lead_id"
        ).withColumns(
            {
                "model_name": F.lit("m"),
                "prompt_tokens": F.lit(1),
                "completion_tokens": F.lit(1),
                "latency_ms": F.lit(1.0),
            }
        )

    def feed(*ids):
        rows = [(i, "neutral", "en", f"note {i}") for i in ids]
        spark.createDataFrame(rows, NOTE_SCHEMA).write.mode("append").parquet(source)

    def run(state):
        jobs.resume_stream(spark, source, target, str(tmp_path / state), classify).awaitTermination()

    feed("a", "b", "b")
    run("s1")
    feed("b", "c")
    run("s1")
    run("s2")
    got = [r["lead_id"] for r in read_predictions(spark, target).collect()]
    assert sorted(got) == ["a", "b", "c"]
    assert seen.value == 3
