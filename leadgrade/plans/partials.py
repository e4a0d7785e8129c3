"""Arrays that every task sums over its rows, merged by key in steps of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Arrays of one key that a task merges.
MERGE = 32


def _sum(rows: pd.DataFrame, dtype: type) -> np.ndarray:
    total = np.frombuffer(rows["sums"].iloc[0], dtype).copy()
    for other in rows["sums"].iloc[1:]:
        total += np.frombuffer(other, dtype)
    return total


def merged(
    sums: DataFrame,
    keys: Sequence[str],
    finish: Callable[[np.ndarray], tuple],
    schema: str,
    dtype: type = np.float64,
    parts: int | None = None,
) -> DataFrame:
    """``finish`` of the sum of all arrays of a key: (keys, then the columns of ``schema``).

    ``sums``: keys (int) and ``sums`` (the bytes of an array), at most one row per key and
    task. ``parts``: the number of tasks. No task merges more than ``MERGE`` arrays of a key, so
    memory doesn't grow with the number of tasks.
    """
    parts = parts or sums.rdd.getNumPartitions()
    keys = list(keys)
    own = ", ".join(f"{k} int" for k in keys)
    sums = sums.withColumn("part", F.spark_partition_id())
    while parts > MERGE:
        parts = -(-parts // MERGE)

        def fewer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([(*key, _sum(rows, dtype).tobytes())], columns=[*keys, "part", "sums"])

        part = F.floor(F.col("part") / MERGE).cast("int")
        sums = sums.withColumn("part", part).groupBy(*keys, "part")
        sums = sums.applyInPandas(fewer, f"{own}, part int, sums binary")

    def last(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*key, *finish(_sum(rows, dtype)))])

    return sums.groupBy(*keys).applyInPandas(last, f"{own}, {schema}")
