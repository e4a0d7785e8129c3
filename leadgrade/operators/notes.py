"""Interaction notes: length gate, latest note, replies, fallback, classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.functions.scoring import attitude_score
from leadgrade.functions.text import (
    attitude_or_fallback,
    parse_status,
    parsed_attitude,
    reply_content,
    reply_struct,
    reply_tokens,
)
from leadgrade.plans.sizing import release, written


def note_length_gate(
    notes: DataFrame,
    shortest: int = C.NOTE_MIN_CHARS,
    longest: int = C.NOTE_MAX_CHARS,
) -> DataFrame:
    """Tag each note with ``reject_reason``; null means it may be classified.

    Rejected notes stay in the table with their whole text, for a side output.
    """
    n = F.coalesce(F.length("text"), F.lit(0))
    return notes.withColumn(
        "reject_reason", F.when(n < shortest, "too_short").when(n > longest, "too_long")
    )


def latest_note(notes: DataFrame, key: str, order: Column, *columns: str) -> DataFrame:
    """Most recent row per key, as an aggregate.

    A window would sort a whole key in one task; the aggregate keeps one row per
    key in each task and merges those.
    """
    row = F.struct(*[c for c in columns])
    return notes.groupBy(key).agg(F.max_by(row, order).alias("_row")).select(
        key, "_row.*"
    )


def extract_replies(raw: DataFrame, body: str = "body") -> DataFrame:
    """Reply JSON -> ``content`` and the three token counts."""
    parsed = raw.withColumn("_reply", reply_struct(F.col(body)))
    return parsed.withColumns(
        {
            "content": reply_content(F.col("_reply")),
            **{
                name: reply_tokens(F.col("_reply"), name)
                for name in ("prompt_tokens", "completion_tokens", "total_tokens")
            },
        }
    ).drop("_reply")


def parse_replies(replies: DataFrame) -> DataFrame:
    """Add ``predicted_attitude`` (null when malformed), ``status`` and the score."""
    return replies.withColumns(
        {
            "predicted_attitude": parsed_attitude(F.col("content")),
            "status": parse_status(F.col("content")),
        }
    ).withColumn("sentiment_score", attitude_score(F.col("predicted_attitude")))


def with_fallback(
    df: DataFrame, label: str = "predicted_attitude", status: str = "status"
) -> DataFrame:
    """Neutral with a reason after a transient failure.

    Hard failures keep a null attitude: the caller must not score them.
    """
    transient = F.col(status).isin(*C.TRANSIENT_STATUSES)
    attitude = attitude_or_fallback(F.col(label), F.col(status))
    return df.withColumns(
        {
            "attitude": attitude,
            "sentiment_score": attitude_score(attitude),
            "sentiment_unavailable": F.coalesce(transient, F.lit(False)),
            "fallback_reason": F.when(transient, F.col(status)),
        }
    )


def classify_with(
    notes: DataFrame,
    predictor: Callable[[pd.Series], pd.Series],
    row_id: str = "lead_id",
) -> DataFrame:
    """Run any text -> label function over the notes, in Arrow batches."""
    schema = T.StructType(
        [notes.schema[row_id], T.StructField("predicted_attitude", T.StringType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            labels = predictor(batch["text"])
            yield pd.DataFrame(
                {row_id: batch[row_id], "predicted_attitude": list(labels)}
            )

    return notes.select(row_id, "text").mapInPandas(run, schema)


def train_note_classifier(
    notes: DataFrame, label: str = "attitude", features: int = 1 << 14
) -> PipelineModel:
    """Bag-of-words attitude model; hashing needs no vocabulary on the driver.

    Texts are tokenised and hashed once; the steps that learn read the stored vectors.
    """
    words = RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+")
    hashed = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features)
    text = PipelineModel([words, hashed])
    stored = written(text.transform(notes).select(label, "_tf"), "hashed-notes")
    index = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc").fit(stored)
    weights = IDF(inputCol="_tf", outputCol="_x").fit(stored)
    regression = LogisticRegression(
        featuresCol="_x", labelCol="_y", predictionCol="_p", regParam=0.01, maxIter=20
    ).fit(weights.transform(index.transform(stored)))
    release(stored)
    back = IndexToString(inputCol="_p", outputCol="predicted_attitude", labels=index.labels)
    return PipelineModel([words, hashed, weights, regression, back])


def classify_notes(model: PipelineModel, notes: DataFrame) -> DataFrame:
    return model.transform(notes).select(
        "lead_id",
        "predicted_attitude",
        r6(attitude_score(F.col("predicted_attitude"))).alias("sentiment_score"),
    )
