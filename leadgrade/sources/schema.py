"""Declared schemas and the checks made before any job starts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from leadgrade import constants as C

_DOUBLES = set(C.CLIPPED_NUMERIC)


def _raw_type(name: str) -> T.DataType:
    if name in _DOUBLES:
        return T.DoubleType()
    if name == "lead_number":
        return T.LongType()
    if name == "converted":
        return T.IntegerType()
    return T.StringType()


RAW_LEAD_SCHEMA = T.StructType(
    [T.StructField(alias, _raw_type(alias)) for alias in C.RAW_COLUMNS.values()]
)
RAW_HEADER_SCHEMA = T.StructType(
    [T.StructField(name, _raw_type(alias)) for name, alias in C.RAW_COLUMNS.items()]
)
NOTE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("lead_id", "attitude", "language", "text")
    ]
)
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("lead_id", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("true_attitude", T.StringType()),
        T.StructField("predicted_attitude", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("prompt_tokens", T.IntegerType()),
        T.StructField("completion_tokens", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("timestamp_utc", T.TimestampType()),
    ]
)


class MissingColumnsError(ValueError):
    """Raised with the names of all absent columns."""


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name not in df.columns]


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    """Plan-time check; names every missing column at once and starts no job."""
    missing = missing_columns(df, names)
    if missing:
        raise MissingColumnsError(f"{what}: missing columns {missing}")
