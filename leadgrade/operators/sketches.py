"""Distinct counts that are kept: one small sketch per load and column, united when asked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch, as a power of two: a standard error of about 0.8 percent.
LOG_REGISTERS = 14


def distinct_sketches(df: DataFrame, columns: Sequence[str], load: str) -> DataFrame:
    """(load, column, sketch, n_null): what a load adds to the distinct values of each column.

    Sketches of earlier loads stay as they are; a null is no value, and a column of nulls
    has an empty sketch.
    """
    rows = df.select(load, *[F.col(c).cast("string").alias(c) for c in columns])
    long = rows.unpivot([load], list(columns), "column", "value")
    return long.groupBy(F.col(load).alias("load"), "column").agg(
        F.hll_sketch_agg("value", F.lit(LOG_REGISTERS)).alias("sketch"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
    )


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """(column, n_estimate, n_null) over all loads; the rows of the loads aren't read again."""
    return sketches.groupBy("column").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_estimate"), F.sum("n_null").alias("n_null")
    )
