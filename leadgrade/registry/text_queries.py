"""Notes, replies, prompts, fallback, slugs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrade.functions import prompts
from leadgrade.functions.text import model_slug
from leadgrade.operators import notes, segments, splits
from leadgrade.registry import views as V
from leadgrade.registry.core import register
from leadgrade.registry.feature_queries import CONTEXT, CONTEXT_SQL, LANGUAGE_SQL
from leadgrade.registry.views import with_ctes


def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@register(
    "note_length_gate",
    with_ctes(V.NOTES_SQL)
    + """SELECT lead_id, length(text) AS n_chars, md5(text) AS text_md5,
      CASE WHEN length(text) < 1 THEN 'too_short' WHEN length(text) > 4000 THEN 'too_long' END AS reject_reason
      FROM notes""",
)
def note_length_gate(spark, sf):
    gated = notes.note_length_gate(V.notes(spark, sf, ("lead_id", "text")))
    return gated.select(
        "lead_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.md5("text").alias("text_md5"),
        "reject_reason",
    )


# Replies in all the shapes a model answers in, around the whole note text.


def reply_bodies(spark, sf):
    rows = V.notes(spark, sf, ("lead_id", "attitude", "text"))
    answer = F.concat(F.lit('{"attitude": "'), F.col("attitude"), F.lit('"}'))
    first = F.lit('{"attitude": "neutral"}')
    kind = F.col("lead_id") % 8
    content = (
        F.when(kind == 0, answer)
        .when(kind == 1, F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
        .when(kind == 3, F.concat(first, F.lit("\n"), answer))
        .when(kind == 4, F.col("text"))
        .when(kind == 5, F.lit('{"attitude": "very_positive"}'))
        .when(kind == 6, F.concat(F.lit('{"attitude": " '), F.upper("attitude"), F.lit(' "}')))
        .when(kind == 7, F.lit("   "))
    )
    reasoning = F.when(kind == 2, F.concat(F.col("text"), F.lit("\n"), answer))
    message = F.struct(content.alias("content"), reasoning.alias("reasoning"))
    usage = F.struct(
        F.length("text").alias("prompt_tokens"), F.lit(12).alias("completion_tokens")
    )
    body = F.struct(
        F.array(F.struct(message.alias("message"))).alias("choices"),
        F.when(F.col("lead_id") % 3 != 0, usage).alias("usage"),
    )
    return rows.select("lead_id", F.to_json(body).alias("body"))


REPLIES_SQL = """
replies AS (
  SELECT lead_id, CASE lead_id % 8 WHEN 0 THEN answer WHEN 1 THEN '```json' || chr(10) || answer || chr(10) || '```'
      WHEN 2 THEN text || chr(10) || answer WHEN 3 THEN '{"attitude": "neutral"}' || chr(10) || answer
      WHEN 4 THEN text WHEN 5 THEN '{"attitude": "very_positive"}'
      WHEN 6 THEN '{"attitude": " ' || upper(attitude) || ' "}' END AS content,
    CASE WHEN lead_id % 3 <> 0 THEN length(text) ELSE 0 END AS prompt_tokens,
    CASE WHEN lead_id % 3 <> 0 THEN 12 ELSE 0 END AS completion_tokens
  FROM (SELECT *, '{"attitude": "' || attitude || '"}' AS answer FROM notes)),
cleaned AS (
  SELECT *, trim(regexp_replace(trim(content, E' \\t\\n\\r'), '^\\s*```(?:json)?\\s*|\\s*```\\s*$', '', 'gi'), E' \\t\\n\\r') AS c
  FROM replies),
labelled AS (
  SELECT lead_id, content, lower(trim(CASE
    WHEN json_valid(c) AND json_type(CASE WHEN json_valid(c) THEN c END, '$.attitude') = 'VARCHAR'
      THEN json_extract_string(CASE WHEN json_valid(c) THEN c END, '$.attitude')
    ELSE regexp_extract_all(content, '\\{\\s*"attitude"\\s*:\\s*"([a-z_ ]+)"\\s*\\}', 1, 'i')[-1] END)) AS label
  FROM cleaned),
parsed AS (
  SELECT lead_id, CASE WHEN label IN ('positive_engagement', 'objection', 'neutral', 'disengaged')
    THEN label END AS predicted_attitude FROM labelled)"""


@register(
    "extract_reply_content",
    with_ctes(V.NOTES_SQL, REPLIES_SQL)
    + """SELECT lead_id, md5(content) AS content_md5, CAST(prompt_tokens AS INTEGER) AS prompt_tokens,
      completion_tokens, 0 AS total_tokens FROM replies""",
)
def extract_reply_content(spark, sf):
    out = notes.extract_replies(reply_bodies(spark, sf))
    return out.select(
        "lead_id",
        F.md5("content").alias("content_md5"),
        "prompt_tokens",
        "completion_tokens",
        "total_tokens",
    )


@register(
    "parse_replies",
    with_ctes(V.NOTES_SQL, REPLIES_SQL)
    + f"""SELECT lead_id, predicted_attitude,
      CASE WHEN predicted_attitude IS NULL THEN 'malformed' ELSE 'ok' END AS status,
      {V.SCORE_CASE} AS sentiment_score FROM parsed""",
)
def parse_replies(spark, sf):
    out = notes.parse_replies(notes.extract_replies(reply_bodies(spark, sf)))
    return out.select("lead_id", "predicted_attitude", "status", "sentiment_score")


_STATUSES = ("ok", "openrouter_rate_limit", "openrouter_unavailable", "config_error", "permanent")
_STATUS_SQL = "CASE lead_id % 5 " + " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate(_STATUSES)
) + " END"


@register(
    "sentiment_fallback",
    with_ctes(*V.PREDICTIONS)
    + f"""SELECT lead_id, attitude, sentiment_unavailable, fallback_reason,
      {V.SCORE_CASE.replace('predicted_attitude', 'attitude')} AS sentiment_score
      FROM (SELECT lead_id, CASE WHEN s IN ('config_error', 'openrouter_rate_limit', 'openrouter_unavailable')
          THEN 'neutral' WHEN s = 'permanent' THEN NULL ELSE predicted_attitude END AS attitude,
        s IN ('config_error', 'openrouter_rate_limit', 'openrouter_unavailable') AS sentiment_unavailable,
        CASE WHEN s NOT IN ('ok', 'permanent') THEN s END AS fallback_reason
        FROM (SELECT *, {_STATUS_SQL} AS s FROM predictions))""",
)
def sentiment_fallback(spark, sf):
    status = F.get(F.array(*[F.lit(s) for s in _STATUSES]), (F.col("lead_id") % 5).cast("int"))
    rows = V.predictions(spark, sf).withColumn("status", status)
    return notes.with_fallback(rows).select(
        "lead_id", "attitude", "sentiment_unavailable", "fallback_reason", "sentiment_score"
    )


@register(
    "model_slug",
    with_ctes(V.NOTES_SQL)
    + """SELECT lead_id, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM (
      SELECT lead_id, split_part(CASE WHEN instr(raw, '/') > 0
        THEN substr(raw, instr(raw, '/') + 1) ELSE raw END, ':', 1) AS name
      FROM (SELECT lead_id, language || '/Model ' || attitude || '_v' || CAST(n_chars AS VARCHAR) || '.0:free' AS raw
            FROM notes))""",
)
def slugs(spark, sf):
    raw = F.concat(
        "language", F.lit("/Model "), "attitude", F.lit("_v"), F.col("n_chars").cast("string"), F.lit(".0:free")
    )
    rows = V.notes(spark, sf, ("lead_id", "attitude", "language", "n_chars"))
    return rows.select("lead_id", model_slug(raw).alias("slug"))


_SHOTS = "".join(
    f"user:{note}|assistant:{prompts.label_reply(label)}|" for note, label in prompts.EXAMPLES
)


def _flat(messages):
    lines = F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return F.array_join(lines, "|")


@register(
    "prompt_messages",
    with_ctes(V.NOTES_SQL)
    + f"""SELECT lead_id, 18 AS n_messages, md5({sql_text('system:' + prompts.CLASSIFY_INSTRUCTION + '|' + _SHOTS + 'user:')}
      || text) AS prompt_md5, length(text) AS n_chars FROM notes""",
)
def prompt_messages(spark, sf):
    rows = V.notes(spark, sf, ("lead_id", "text"))
    messages = prompts.classify_messages(F.col("text"))
    return rows.select(
        "lead_id",
        F.size(messages).alias("n_messages"),
        F.md5(_flat(messages)).alias("prompt_md5"),
        F.length(F.element_at(messages, -1)["content"]).cast("bigint").alias("n_chars"),
    )


def _template_sql() -> str:
    tone = "CASE attitude " + " ".join(
        f"WHEN '{k}' THEN {sql_text(v)}" for k, v in prompts.TONE_HINTS.items()
    ) + " END"
    hint = "CASE language " + " ".join(
        f"WHEN '{k}' THEN {sql_text(v)}" for k, v in prompts.LANGUAGE_HINTS.items()
    ) + " END"
    parts = []
    for piece in prompts.WRITE_TEMPLATE.split("{"):
        name, _, rest = piece.rpartition("}")
        if name:
            parts.append({"tone_hint": tone, "language_instruction": hint}.get(name, name))
        parts.append(sql_text(rest))
    return " || ".join(parts)


@register(
    "note_prompts",
    with_ctes(
        *V.LEADS,
        V.NOTES_SQL,
        f"ctx AS ({CONTEXT_SQL})",
        f"drawn AS (SELECT lead_id, {LANGUAGE_SQL} AS language FROM leads)",
    )
    + f"""SELECT ctx.lead_id, drawn.language, md5({sql_text('system:' + prompts.WRITE_INSTRUCTION + '|user:')}
      || {_template_sql()}) AS prompt_md5
      FROM ctx JOIN drawn ON drawn.lead_id = ctx.lead_id
      JOIN (SELECT lead_id, attitude FROM notes) n ON n.lead_id = ctx.lead_id""",
)
def note_prompts(spark, sf):
    """Note-writing prompts from attitude, language draw and neutral context."""
    leads = V.raw_leads(spark, sf, ("lead_id", *CONTEXT, "total_time_spent"))
    attitudes = V.notes(spark, sf, ("lead_id", "attitude"))
    rows = segments.assign_language(segments.neutral_context(leads)).join(attitudes, "lead_id")
    messages = prompts.write_messages(F.col("attitude"), F.col("language"), F.col("context"))
    return rows.select("lead_id", "language", F.md5(_flat(messages)).alias("prompt_md5"))


@register("classify_notes")
def classify_notes(spark, sf):
    """Train on the train part of the notes, label the test part."""
    rows = V.notes(spark, sf, ("lead_id", "attitude", "language", "text"))
    parts = splits.split_80_10_10(rows)
    model = notes.train_note_classifier(parts.where(F.col("split") == "train"))
    test = parts.where(F.col("split") == "test").select("lead_id", "text")
    return notes.classify_notes(model, test)


@register(
    "classify_with_hook",
    with_ctes(V.NOTES_SQL)
    + """SELECT lead_id, CASE WHEN length(text) < 500 THEN 'disengaged' WHEN length(text) < 2000 THEN 'objection'
      ELSE 'positive_engagement' END AS predicted_attitude FROM notes""",
)
def classify_with_hook(spark, sf):
    """Any text -> label function, here a rule on the length of the whole text."""

    def by_length(texts):
        size = texts.str.len()
        label = size.map(
            lambda n: "disengaged" if n < 500 else "objection" if n < 2000 else "positive_engagement"
        )
        return label

    return notes.classify_with(V.notes(spark, sf, ("lead_id", "text")), by_length)


