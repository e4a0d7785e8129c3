"""Readers for lead CSVs, notes, JSON records and JSON reports."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadgrade import constants as C
from leadgrade.functions.clean import nan_to_null
from leadgrade.sources.schema import (
    PREDICTION_SCHEMA,
    RAW_HEADER_SCHEMA,
    RAW_LEAD_SCHEMA,
    require_columns,
)


def missing_to_null(col: Column) -> Column:
    return F.when(~col.isin(*C.MISSING_TOKENS), col)


def typed_leads(df: DataFrame) -> DataFrame:
    """Strings as read from a CSV -> typed columns; a bad number raises on use."""
    out = []
    for field in RAW_LEAD_SCHEMA:
        if field.name not in df.columns:
            continue
        text = missing_to_null(F.col(field.name))
        if isinstance(field.dataType, T.StringType):
            typed = text
        elif isinstance(field.dataType, T.DoubleType):
            typed = nan_to_null(text.cast("double"))
        else:
            # Whole numbers directly, so that none is rounded; "1.0" by way of a double.
            typed = F.coalesce(text.try_cast(field.dataType), text.cast("double").cast(field.dataType))
        out.append(typed.alias(field.name))
    return df.select(*out)


def read_leads_csv(
    spark: SparkSession, path: str, line_breaks: bool = False
) -> DataFrame:
    """CRM export of one or more files with a header row each. Columns are matched by
    name, in any order, file by file; files with other columns than the rest are refused.

    Every cell is read as text, the known missing tokens become null, and only
    then are numbers cast, because the reader itself takes one null token. Cells
    may hold line breaks only with ``line_breaks=True``, which reads each file in
    one task; without it files are split, and a broken row fails the query.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", line_breaks)
        .option("escape", '"')
        .option("mode", "FAILFAST")
    )
    files = _files_by_header(spark, path)
    if len(files) < 2:
        return typed_leads(reader.csv(path).withColumnsRenamed(C.RAW_COLUMNS))
    first = sorted(next(iter(files)))
    if odd := [f[0] for names, f in files.items() if sorted(names) != first]:
        raise ValueError(f"{odd[0]}: its columns differ from those of the other files")
    parts = [reader.csv(found).select(*first) for found in files.values()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return typed_leads(out.withColumnsRenamed(C.RAW_COLUMNS))


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of ``path`` by the names in their first line; blank files are left out.

    One job reads the first split of each file as text; the driver gets one line a file.
    """
    lines = (
        spark.read.text(path)
        .where("_metadata.file_block_start = 0")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("at"),
            F.col("value").alias("line"),
        )
        .groupBy("file")
        .agg(F.min_by("line", "at").alias("line"))
    )
    found: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(lines.collect()):
        names = next(csv.reader([row["line"].lstrip("\ufeff")]), [])
        if names:
            found.setdefault(tuple(names), []).append(row["file"])
    return found


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Column subset of a parquet table."""
    df = spark.read.parquet(path)
    require_columns(df, columns, path)
    return df.select(*columns)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Stored predictions in their fixed column order."""
    return read_columns(spark, path, PREDICTION_SCHEMA.fieldNames())


def lead_records(payload: Column) -> Column:
    """JSON lead payload -> struct with engine column names.

    Unknown keys are dropped; a payload that is no JSON object gives null.
    """
    parsed = F.from_json(payload, RAW_HEADER_SCHEMA)
    return F.struct(
        *[parsed[name].alias(alias) for name, alias in C.RAW_COLUMNS.items()]
    )


def absent_keys(payload: Column) -> Column:
    """Required keys a JSON lead payload does not carry (null value counts as there)."""
    headers = {alias: name for name, alias in C.RAW_COLUMNS.items()}
    required = F.array(*[F.lit(headers[alias]) for alias in C.REQUIRED_RAW])
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    return F.array_except(required, keys)


def read_lead_json(spark: SparkSession, path: str, field: str = "lead") -> DataFrame:
    """JSON-lines requests ``{"lead": {...}, "interaction_text": ...}`` -> leads.

    Returns the lead columns, ``interaction_text`` and ``missing_keys``; rows with
    a non-empty ``missing_keys`` must be set aside by the caller.
    """
    lines = spark.read.text(path)
    payload = F.get_json_object("value", f"$.{field}")
    return lines.select(
        lead_records(payload).alias("_lead"),
        F.get_json_object("value", "$.interaction_text").alias("interaction_text"),
        absent_keys(payload).alias("missing_keys"),
    ).select("_lead.*", "interaction_text", "missing_keys")


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
