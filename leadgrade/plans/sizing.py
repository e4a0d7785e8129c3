"""Durable scratch space, and join sides whose size Spark knows."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="run-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the cluster's shared folder.

    Only a local session without that setting gets a temporary folder; the session's
    settings are never changed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = _local_root()
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


class _Scope:
    def __init__(self):
        self.tables: list[DataFrame] = []
        self.kept: list[DataFrame] = []

    def keep(self, table: DataFrame) -> DataFrame:
        """A table from ``written`` that outlives the scope."""
        self.kept.append(table)
        return table


_SCOPES: list[_Scope] = []


@contextmanager
def scope() -> Iterator[_Scope]:
    """Tables that ``written`` stores inside are deleted at the end, but for the kept ones.

    What is kept has to be stored itself, not planned over tables of the scope. A kept
    table belongs to the scope around, if there is one.
    """
    own = _Scope()
    _SCOPES.append(own)
    try:
        yield own
    finally:
        _SCOPES.remove(own)
        held = [id(t) for t in own.kept]
        release(*[t for t in own.tables if id(t) not in held])
        if _SCOPES:
            _SCOPES[-1].tables += own.kept


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts lineage and
    survives the loss of an executor.

    The planner knows the bytes of a written table: as a join side it is broadcast
    below Spark's own threshold and shuffled above it.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch = path
    if _SCOPES:
        _SCOPES[-1].tables.append(table)
    return table


def release(*tables: DataFrame) -> None:
    """Delete what ``written`` stored for ``tables``, once nothing reads them any more.

    Call it after the table that took their place is written: a task that runs again then
    reads the newer one. Frames derived from a written table aren't touched.
    """
    for table in tables:
        path = table.__dict__.pop("_scratch", None)
        if path:
            spark = table.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
