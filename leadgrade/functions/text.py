"""Model replies: content choice, label parsing, fallback, slugs, token totals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import strip

# Patterns of a fenced reply and of the label object in prose.
FENCE_PATTERN = r"(?i)^\s*```(?:json)?\s*|\s*```\s*$"
LABEL_PATTERN = r'(?i)\{\s*"attitude"\s*:\s*"([a-z_ ]+)"\s*\}'

REPLY_SCHEMA = (
    "choices array<struct<message: struct<content: string, reasoning: string>>>, "
    "usage struct<prompt_tokens: int, completion_tokens: int, total_tokens: int>"
)
NOT_BLANK = r"\S"


def reply_struct(body: Column) -> Column:
    return F.from_json(body, REPLY_SCHEMA)


def reply_content(reply: Column) -> Column:
    """``content`` when it holds text, else ``reasoning`` when that does, else null."""
    message = F.get(reply["choices"], 0)["message"]
    content, reasoning = message["content"], message["reasoning"]
    return F.when(content.rlike(NOT_BLANK), content).when(
        reasoning.rlike(NOT_BLANK), reasoning
    )


def reply_tokens(reply: Column, name: str) -> Column:
    return F.coalesce(reply["usage"][name], F.lit(0))


def token_total(prompt: Column, completion: Column) -> Column:
    """prompt + completion; null when the prompt count is null."""
    return F.when(prompt.isNotNull(), prompt + F.coalesce(completion, F.lit(0)))


def raw_label(content: Column) -> Column:
    """Lower-cased label named by a reply, known or not; null when there is none.

    A reply that is one JSON object is read as JSON. It is parsed inside ``[ ]``
    because Spark's JSON reader stops after the first value, and so would accept
    an object followed by prose. Anything else falls back to the last label
    object found in the text.
    """
    cleaned = strip(F.regexp_replace(strip(content), FENCE_PATTERN, ""))
    wrapped = F.concat(F.lit("["), cleaned, F.lit("]"))
    parsed = F.from_json(wrapped, "array<struct<attitude: string>>")
    # The reader turns numbers into strings; only a JSON string is a label.
    kind = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json(wrapped), "$[0].attitude", "variant")
    )
    is_text = F.coalesce(kind == "STRING", F.lit(True))
    from_json = F.when(
        cleaned.startswith("{") & (F.size(parsed) == 1) & is_text,
        F.get(parsed, 0)["attitude"],
    )
    matches = F.regexp_extract_all(content, F.lit(LABEL_PATTERN), F.lit(1))
    from_text = F.when(F.size(matches) > 0, F.element_at(matches, -1))
    return F.lower(strip(F.coalesce(from_json, from_text)))


def parsed_attitude(content: Column) -> Column:
    """Known label of a reply, or null when the reply is malformed."""
    label = raw_label(content)
    return F.when(label.isin(*C.ATTITUDES), label)


def parse_status(content: Column) -> Column:
    return F.when(parsed_attitude(content).isNotNull(), "ok").otherwise("malformed")


def attitude_or_fallback(label: Column, status: Column) -> Column:
    """The label, or neutral after a transient failure; null after a hard one."""
    return F.when(status.isin(*C.TRANSIENT_STATUSES), C.FALLBACK_ATTITUDE).when(
        ~status.isin(*C.HARD_STATUSES), label
    )


def model_slug(name: Column) -> Column:
    """``vendor/Name-1.0:tag`` -> ``name-1-0``."""
    tail = F.regexp_replace(name, r"^[^/]*/", "")
    stem = F.lower(F.regexp_replace(tail, r"(?s):.*$", ""))
    dashed = F.regexp_replace(stem, r"[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, r"^-+|-+$", "")
