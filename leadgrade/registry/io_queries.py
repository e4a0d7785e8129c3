"""Sources, sinks, saved state, resume and streams, run over the given tables.

Each query writes what it needs below the shared work folder and reads it back, so
the SQL twin checks the round trip.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.operators import features, profile
from leadgrade.plans.sizing import work_dir
from leadgrade.registry import views as V
from leadgrade.registry.core import register
from leadgrade.registry.feature_queries import DERIVED, STATE, derived_leads
from leadgrade.registry.views import with_ctes
from leadgrade.sources import readers, sinks, state_store
from leadgrade.sources.schema import (
    NOTE_SCHEMA,
    PREDICTION_SCHEMA,
    missing_columns,
    require_columns,
)
from leadgrade.streaming import jobs

_HEADERS = {alias: name for name, alias in C.RAW_COLUMNS.items()}
RAW_ORDER = tuple(C.RAW_COLUMNS.values())
_RAW_SQL = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c == "lead_id" else c for c in RAW_ORDER
)


@register("read_leads_csv", with_ctes(*V.LEADS) + f"SELECT {_RAW_SQL} FROM leads")
def read_leads_csv(spark, sf):
    """Leads written as a CRM export (header names, 'NA' for missing), read back."""
    path = work_dir(spark, "leads-csv")
    leads = V.raw_leads(spark, sf)
    text = leads.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(_HEADERS[c]) for c in RAW_ORDER]
    )
    # Two exports whose columns stand in another order.
    even = F.col(_HEADERS["lead_id"]).cast("long") % 2 == 0
    sinks.csv_writer(text.where(even)).csv(path)
    turned = text.where(~even).select(*[f"`{c}`" for c in reversed(text.columns)])
    sinks.csv_writer(turned).mode("append").csv(path)
    return readers.read_leads_csv(spark, path).select(*RAW_ORDER)


def request_lines(spark, sf):
    """JSON scoring requests, one per lead, some without a required key."""
    leads = V.raw_leads(spark, sf)
    payload = F.struct(
        *[F.col(c).alias(_HEADERS[c]) for c in RAW_ORDER if c not in ("converted", "lead_id")],
        F.col("lead_id").cast("string").alias("Prospect ID"),
        F.lit("x").alias("Not A Lead Column"),
    )
    body = F.struct(
        payload.alias("lead"),
        F.when(F.col("lead_id") % 13 == 0, "").otherwise("Asked for a demo.").alias(
            "interaction_text"
        ),
        F.when(F.col("lead_id") % 4 == 1, "objection")
        .otherwise("positive_engagement")
        .alias("attitude"),
        F.when(F.col("lead_id") % 5 == 2, "openrouter_rate_limit").otherwise("ok").alias("status"),
    )
    # Null values keep their key; a few requests lack City altogether.
    text = F.to_json(body, {"ignoreNullFields": "false"})
    broken = F.regexp_replace(text, '"City":("[^"]*"|null),', "")
    return leads.select(F.when(F.col("lead_id") % 17 == 0, broken).otherwise(text).alias("value"))


@register(
    "score_json_records",
    with_ctes(*V.LEADS)
    + """SELECT CAST(lead_id AS VARCHAR) AS lead_id, lead_source, total_visits, country,
      CASE WHEN lead_id % 17 = 0 THEN NULL ELSE city END AS city,
      CASE WHEN lead_id % 17 = 0 THEN 'City' ELSE '' END AS missing FROM leads""",
)
def score_json_records(spark, sf):
    path = work_dir(spark, "requests")
    request_lines(spark, sf).write.text(path)
    return readers.read_lead_json(spark, path).select(
        "lead_id",
        "lead_source",
        "total_visits",
        "country",
        "city",
        F.array_join("missing_keys", ",").alias("missing"),
    )


@register(
    "sink_dual",
    with_ctes(*V.PREDICTIONS)
    + """SELECT f.fmt, language, count(*) AS n, CAST(sum(lead_id) AS BIGINT) AS id_sum
      FROM predictions, (VALUES ('csv'), ('parquet')) f(fmt) GROUP BY ALL""",
)
def sink_dual(spark, sf):
    path = work_dir(spark, "dual")
    sinks.write_both(V.predictions(spark, sf).select("lead_id", "language"), path)
    both = {
        "parquet": spark.read.parquet(f"{path}.parquet"),
        "csv": spark.read.schema("lead_id bigint, language string")
        .option("header", True)
        .csv(f"{path}.csv"),
    }
    tagged = [df.withColumn("fmt", F.lit(fmt)) for fmt, df in both.items()]
    return (
        tagged[0]
        .unionByName(tagged[1])
        .groupBy("fmt", "language")
        .agg(F.count("*").alias("n"), F.sum("lead_id").alias("id_sum"))
    )


@register(
    "report_roundtrip",
    with_ctes(V.LEADS_SQL)
    + """SELECT lead_source, count(*) AS n, round(avg(CAST(converted AS DOUBLE)) * 100, 1) AS converted_pct
      FROM leads GROUP BY lead_source""",
)
def report_roundtrip(spark, sf):
    path = work_dir(spark, "report")
    report = profile.positive_rate_by(
        V.raw_leads(spark, sf, ["lead_source", "converted"]), "lead_source"
    )
    sinks.write_report(report, path)
    return readers.read_report(spark, path, report.schema)


def _predictions(spark, sf):
    return V.predictions(spark, sf).withColumn("lead_id", F.col("lead_id").cast("string"))


@register(
    "resume_pending",
    with_ctes(*V.PREDICTIONS)
    + """SELECT lead_id, language FROM predictions
      WHERE lead_id NOT IN (SELECT doc_id FROM labels)""",
)
def resume_pending(spark, sf):
    done = V.table(spark, sf, "labels").select(F.col("doc_id").alias("lead_id"))
    return sinks.pending(V.predictions(spark, sf).select("lead_id", "language"), done)


@register(
    "resume_predictions",
    with_ctes(*V.PREDICTIONS)
    + """SELECT CAST(lead_id AS VARCHAR) AS lead_id, true_attitude, predicted_attitude, 1 AS copies FROM predictions""",
)
def resume_predictions(spark, sf):
    """Labelled leads first, then everything: the second run adds only the rest."""
    path = work_dir(spark, "predictions")
    rows = _predictions(spark, sf)
    done = V.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("lead_id"))
    sinks.append_predictions(spark, rows, path, force_refresh=True)
    sinks.append_predictions(spark, rows.join(done, "lead_id", "left_semi"), path, force_refresh=True)
    sinks.append_predictions(spark, rows, path)
    sinks.append_predictions(spark, rows, path)
    stored = readers.read_predictions(spark, path)
    return stored.groupBy("lead_id", "true_attitude", "predicted_attitude").agg(
        F.count("*").cast("int").alias("copies")
    )


@register(
    "state_roundtrip",
    with_ctes(*STATE)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(mean_{c}, 6) AS mean, round(std_{c}, 6) AS std FROM moments"
        for c in features.NUMERIC
    ),
)
def state_roundtrip(spark, sf):
    path = work_dir(spark, "state")
    state_store.save_state(features.fit(derived_leads(spark, sf)), path)
    loaded = state_store.load_state(spark, path)
    return features.params_frame(loaded).select(
        "column", r6("mean").alias("mean"), r6("std").alias("std")
    )


@register(
    "schema_guard",
    with_ctes(*V.LEADS)
    + """SELECT 'leads' AS source, 'city,country' AS missing, count(*) AS n FROM leads
    UNION ALL SELECT 'whole leads', '', count(*) FROM leads""",
)
def schema_guard(spark, sf):
    """The checks pass on whole tables and name what is absent on a cut one."""
    leads = V.raw_leads(spark, sf)
    require_columns(V.predictions(spark, sf), PREDICTION_SCHEMA.fieldNames()[:-1], "predictions")
    out = None
    for name, table in (("leads", leads.drop("city", "country")), ("whole leads", leads)):
        absent = ",".join(sorted(missing_columns(table, C.REQUIRED_RAW)))
        rows = table.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("source"), F.lit(absent).alias("missing"), "n"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


# --- streams, each run to the end of its input ---


def _formula(leads):
    """The fixed formula as a scorer for raw leads."""
    return leads.withColumn("p_conversion", V.formula_score(leads.columns))


@register(
    "stream_score",
    with_ctes(*V.SCORED)
    + f"""SELECT CAST(lead_id AS VARCHAR) AS lead_id, p_conversion, predicted_attitude AS attitude,
      unavailable AS sentiment_unavailable,
      round(CAST(0.6 AS DOUBLE) * p_conversion + CAST(0.4 AS DOUBLE) * {V.SCORE_CASE}, 6) AS priority,
      CAST(NULL AS VARCHAR) AS reject_reason
      FROM (SELECT *, lead_id % 5 = 2 AS unavailable, CASE WHEN lead_id % 5 = 2 THEN 'neutral'
          WHEN lead_id % 4 = 1 THEN 'objection' ELSE 'positive_engagement' END AS predicted_attitude
        FROM scored WHERE lead_id % 17 <> 0 AND lead_id % 13 <> 0)
      UNION ALL SELECT CAST(lead_id AS VARCHAR), NULL, NULL, NULL, NULL, CASE WHEN lead_id % 17 = 0
        THEN 'missing_lead_columns' ELSE 'bad_note_length' END
      FROM scored WHERE lead_id % 17 = 0 OR lead_id % 13 = 0""",
)
def stream_score(spark, sf):
    """Request files as a stream; broken requests are set aside, not scored."""
    source, target = work_dir(spark, "stream-in"), work_dir(spark, "stream-out")
    request_lines(spark, sf).write.text(source)
    query = jobs.score_stream(spark, source, target, work_dir(spark, "stream-state"), _formula)
    query.awaitTermination()
    columns = ("lead_id", "p_conversion", "attitude", "sentiment_unavailable", "priority", "reject_reason")
    refused = spark.read.parquet(f"{target}-rejects").select("lead_id", "reject_reason")
    return spark.read.parquet(target).select(*columns).unionByName(refused, allowMissingColumns=True)


def event_stream(spark, sf):
    schema = V.table(spark, sf, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )


@register(
    "stream_latest_note",
    """SELECT user_id, event_id, event_type, round(value, 6) AS value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
      WHERE r = 1""",
)
def stream_latest_note(spark, sf):
    """Newest event per user, kept up to date by a stream whose state is bounded in time."""
    target = work_dir(spark, "latest")
    query = jobs.keep_latest(
        event_stream(spark, sf),
        "user_id",
        "ts",
        "event_id",
        ["event_type", "value"],
        target,
        work_dir(spark, "latest-state"),
        delay="7 days",
    )
    query.awaitTermination()
    newest = jobs.read_latest(spark, target, "user_id", "ts", "event_id")
    return newest.select("user_id", "event_id", "event_type", r6("value").alias("value"))


@register(
    "stream_resume",
    """SELECT CAST(doc_id AS VARCHAR) AS lead_id, CASE WHEN length(text) < 1000 THEN 'neutral'
      ELSE 'objection' END AS predicted_attitude, 1 AS copies FROM documents""",
)
def stream_resume(spark, sf):
    """Notes streamed twice; every lead is classified and stored once."""
    source, target = work_dir(spark, "notes-in"), work_dir(spark, "notes-out")
    rows = V.notes(spark, sf, ("lead_id", "attitude", "language", "text"))
    rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in NOTE_SCHEMA]
    ).write.parquet(source)

    def classify(batch):
        label = F.when(F.length("text") < 1000, "neutral").otherwise("objection")
        return batch.select(
            "lead_id",
            "language",
            F.col("attitude").alias("true_attitude"),
            label.alias("predicted_attitude"),
            F.lit("by-length").alias("model_name"),
            F.lit(0).alias("prompt_tokens"),
            F.lit(0).alias("completion_tokens"),
            F.lit(0.0).alias("latency_ms"),
        )

    for run in ("first", "second"):
        query = jobs.resume_stream(
            spark, source, target, work_dir(spark, f"notes-state-{run}"), classify
        )
        query.awaitTermination()
    return (
        readers.read_predictions(spark, target)
        .groupBy("lead_id", "predicted_attitude")
        .agg(F.count("*").cast("int").alias("copies"))
    )
