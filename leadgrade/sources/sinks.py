"""Sinks: parquet + CSV pair, report JSON, append without repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from leadgrade.sources import keyed
from leadgrade.sources.readers import read_predictions
from leadgrade.sources.schema import PREDICTION_SCHEMA, require_columns


def csv_writer(df: DataFrame) -> DataFrameWriter:
    """CSV that reads back as written: quotes doubled, outer blanks kept."""
    return (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_both(df: DataFrame, path: str) -> None:
    """``<path>.parquet`` and ``<path>.csv`` with the same rows.

    The CSV is written from the parquet, so the plan runs once and a source that
    is not deterministic still gives equal files.
    """
    parquet = f"{path}.parquet"
    df.write.mode("overwrite").parquet(parquet)
    stored = df.sparkSession.read.schema(df.schema).parquet(parquet)
    csv_writer(stored).csv(f"{path}.csv")


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def stored_predictions(spark: SparkSession, path: str) -> DataFrame:
    if keyed.path_exists(spark, path):
        return read_predictions(spark, path)
    return spark.createDataFrame([], PREDICTION_SCHEMA)


def pending(wanted: DataFrame, done: DataFrame, key: str = "lead_id") -> DataFrame:
    """Rows of ``wanted`` whose key is not in ``done`` yet."""
    return wanted.join(done.select(key), key, "left_anti")


def one_each(df: DataFrame, *newest: str, key: str = "lead_id") -> DataFrame:
    """One row per key: the last by ``newest``, then by the other columns in order."""
    rest = [c for c in df.columns if c not in (*newest, key)]
    row = F.max(F.struct(*newest, *rest)).alias("_row")
    return df.groupBy(key).agg(row).select(key, "_row.*").select(*df.columns)


def _typed(new: DataFrame, path: str) -> DataFrame:
    require_columns(new, [c for c in PREDICTION_SCHEMA.fieldNames() if c != "timestamp_utc"], path)
    stamped = new if "timestamp_utc" in new.columns else new.withColumn(
        "timestamp_utc", F.current_timestamp()
    )
    typed = stamped.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTION_SCHEMA]
    )
    return one_each(typed, "timestamp_utc")


def pending_predictions(spark: SparkSession, wanted: DataFrame, path: str) -> DataFrame:
    """Rows of ``wanted`` whose lead the table at ``path`` doesn't hold; only the files that
    may hold one are read."""
    return keyed.absent(spark, wanted, path, "lead_id")


def append_predictions(
    spark: SparkSession, new: DataFrame, path: str, force_refresh: bool = False
) -> int:
    """Append predictions of leads the table does not hold yet; returns how many stored
    folders had to be read for that.

    ``force_refresh`` replaces the table instead. One write is one checkpoint: a
    run that dies leaves the committed batches, and the next run resumes.
    """
    return keyed.append(spark, _typed(new, path), path, "lead_id", force_refresh)
