"""Streams: score arriving leads, keep the latest note, classify each note once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.operators.derive import derive_features
from leadgrade.operators.features import FeatureState
from leadgrade.operators.models import score
from leadgrade.operators.notes import with_fallback
from leadgrade.operators.priority import quarantine, with_priority
from leadgrade.sources.readers import absent_keys, lead_records
from leadgrade.sources.schema import NOTE_SCHEMA
from leadgrade.sources.sinks import append_predictions, one_each, pending_predictions

Scorer = Callable[[DataFrame], DataFrame]


def model_scorer(state: FeatureState, model: PipelineModel) -> Scorer:
    """Raw leads -> the same rows plus ``p_conversion``.

    The features are computed in the row itself, so a stream needs no self-join.
    """

    def run(leads: DataFrame) -> DataFrame:
        carried = [c for c in leads.columns]
        derived = derive_features(
            leads.withColumn("_row", F.struct(*carried)), keep=["_row"]
        )
        return score(model, state.vectors(derived, ["_row"]), ["_row"]).select(
            "_row.*", "p_conversion"
        )

    return run


def parse_requests(lines: DataFrame) -> DataFrame:
    """JSON requests -> lead columns, ``label``, ``status`` and ``reject_reason``."""
    payload = F.get_json_object("value", "$.lead")
    missing = F.size(absent_keys(payload)) > 0
    text = F.get_json_object("value", "$.interaction_text")
    length = F.coalesce(F.length(text), F.lit(0))
    return lines.select(
        lead_records(payload).alias("_lead"),
        F.get_json_object("value", "$.attitude").alias("predicted_attitude"),
        F.coalesce(F.get_json_object("value", "$.status"), F.lit("ok")).alias("status"),
        F.when(missing, "missing_lead_columns")
        .when(~length.between(C.NOTE_MIN_CHARS, C.NOTE_MAX_CHARS), "bad_note_length")
        .alias("reject_reason"),
        F.col("value").alias("request"),
    ).select("_lead.*", "predicted_attitude", "status", "reject_reason", "request")


def rejected_requests(parsed: DataFrame) -> DataFrame:
    """(lead_id, reject_reason, request) of the rows that failed the checks."""
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        "lead_id", "reject_reason", "request"
    )


def scored_requests(parsed: DataFrame, scorer: Scorer) -> DataFrame:
    """Score the rows that passed the checks, with the attitude fallback."""
    good = with_fallback(parsed.where(F.col("reject_reason").isNull()).drop("request"))
    priced = with_priority(scorer(good), label="attitude")
    checked = quarantine(priced, label="attitude")
    return checked.select(
        "lead_id",
        r6("p_conversion").alias("p_conversion"),
        "attitude",
        "sentiment_score",
        "sentiment_unavailable",
        "fallback_reason",
        r6("priority").alias("priority"),
        "reject_reason",
    )


def score_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    scorer: Scorer,
    rejects: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Request files (one JSON object per line) -> scored leads in ``target``, and the
    requests that failed the checks, with reason and whole text, in ``rejects`` (default:
    ``<target>-rejects``).

    A batch writes to a folder named after it, so a replayed batch overwrites itself.
    """
    rejects = rejects or f"{target.rstrip('/')}-rejects"
    lines = spark.readStream.format("text").load(source)

    def run(batch: DataFrame, number: int) -> None:
        parsed = parse_requests(batch)
        scored = scored_requests(parsed, scorer)
        scored.write.mode("overwrite").parquet(f"{target}/batch={number}")
        refused = rejected_requests(parsed)
        refused.write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latest_note_stream(
    events: DataFrame,
    key: str,
    time: str,
    tie: str,
    *columns: str,
    delay: str | None = None,
    width: str = "1 day",
) -> DataFrame:
    """Newest row per key of an event stream (update output).

    Without ``delay`` one row per key is kept as state for ever. With it, one row per key
    and time window is kept until the newest event seen is ``delay`` past the window; rows
    that come later than that are dropped. The newest of a key is then the newest of its
    windows, which ``read_latest`` takes from what is stored.
    """
    row = F.struct(*columns)
    newest = F.max_by(row, F.struct(time, tie)).alias("_row")
    if delay is None:
        return events.groupBy(key).agg(newest).select(key, "_row.*")
    late = events.withWatermark(time, delay)
    return late.groupBy(F.window(time, width), key).agg(newest).select(key, "_row.*")


def keep_latest(
    events: DataFrame,
    key: str,
    time: str,
    tie: str,
    columns: list[str],
    target: str,
    checkpoint: str,
    once: bool = True,
    delay: str | None = None,
    width: str = "1 day",
) -> StreamingQuery:
    """Store the newest row of every key that a micro-batch changed.

    A batch writes only its changed keys, into a folder named after the batch, so a
    replayed batch overwrites itself and nothing else is rewritten. ``delay`` and ``width``
    bound the state, see ``latest_note_stream``; what is stored stays.
    """
    newest = latest_note_stream(
        events, key, time, tie, time, tie, *columns, delay=delay, width=width
    )

    def run(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = (
        newest.writeStream.outputMode("update")
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_latest(
    spark: SparkSession, target: str, key: str, time: str, tie: str
) -> DataFrame:
    """The current newest row per key out of the stored changes."""
    changes = spark.read.parquet(target).drop("batch")
    row = F.struct(*[c for c in changes.columns if c != key])
    newest = F.max_by(row, F.struct(time, tie)).alias("_row")
    return changes.groupBy(key).agg(newest).select(key, "_row.*")


def compact_latest(
    spark: SparkSession, target: str, compacted: str, key: str, time: str, tie: str
) -> DataFrame:
    """The stored changes as one row per key, in a table of its own that ``read_latest`` reads
    like the changes; the changes can then be archived."""
    newest = read_latest(spark, target, key, time, tie)
    newest.withColumn("batch", F.lit(-1)).write.mode("overwrite").partitionBy("batch").parquet(compacted)
    return spark.read.parquet(compacted)


def note_windows(
    events: DataFrame, key: str, time: str, tie: str, delay: str, width: str, *columns: str
) -> DataFrame:
    """Newest row per key and time window; state older than ``delay`` is dropped."""
    row = F.struct(time, tie, *columns)
    newest = F.max_by(row, F.struct(time, tie)).alias("_row")
    return (
        events.withWatermark(time, delay)
        .groupBy(F.window(time, width), key)
        .agg(newest)
        .select(key, F.col("window.start").alias("window_start"), "_row.*")
    )


def unique_notes(events: DataFrame, time: str, delay: str, keys: list[str]) -> DataFrame:
    """Drop repeats that arrive within the late-data bound."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def resume_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    classify: Callable[[DataFrame], DataFrame],
    once: bool = True,
) -> StreamingQuery:
    """Note files -> predictions, never classifying a lead twice.

    Each micro-batch drops the leads the target already holds before the costly
    classifier runs, so a replayed batch adds nothing.
    """

    def run(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        todo = pending_predictions(session, one_each(batch), target)
        append_predictions(session, classify(todo), target)

    notes = spark.readStream.schema(NOTE_SCHEMA).parquet(source)
    writer = notes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
