"""Saved state: parameter tables plus a metadata row checked before use."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrade.operators.features import (
    NUMERIC,
    STATE_VERSION,
    FeatureState,
    NumericParam,
    params_frame,
)

MODEL_VERSION = 1
MODEL_KINDS = ("logistic_regression", "boosted_trees")
_META = "kind string, version int, n_rows long, feature_names array<string>"


def _check_version(version: int, known: int, path: str) -> None:
    if version > known:
        raise ValueError(f"{path}: version {version} is newer than {known}")


def save_state(state: FeatureState, path: str) -> None:
    spark = state.spark
    params_frame(state).write.mode("overwrite").parquet(f"{path}/numeric")
    state.slots.write.mode("overwrite").parquet(f"{path}/slots")
    meta = [("feature_state", state.version, state.n_rows, [])]
    spark.createDataFrame(meta, _META).write.mode("overwrite").json(f"{path}/meta")


def load_state(spark: SparkSession, path: str) -> FeatureState:
    meta = spark.read.schema(_META).json(f"{path}/meta").first()
    if meta["kind"] != "feature_state":
        raise ValueError(f"{path}: kind {meta['kind']!r} is no feature state")
    _check_version(meta["version"], STATE_VERSION, path)
    rows = {r["column"]: r for r in spark.read.parquet(f"{path}/numeric").collect()}
    numeric = [NumericParam(**rows[c].asDict()) for c in NUMERIC]
    slots = spark.read.parquet(f"{path}/slots")
    return FeatureState(numeric, slots, meta["n_rows"], meta["version"])


def save_model(
    spark: SparkSession, model: MLWritable, kind: str, names: list[str], path: str
) -> None:
    if kind not in MODEL_KINDS:
        raise ValueError(f"unknown model kind {kind!r}; expected one of {MODEL_KINDS}")
    model.write().overwrite().save(f"{path}/model")
    meta = [(kind, MODEL_VERSION, 0, names)]
    spark.createDataFrame(meta, _META).write.mode("overwrite").json(f"{path}/meta")


def model_meta(spark: SparkSession, path: str) -> dict:
    meta = spark.read.schema(_META).json(f"{path}/meta").first()
    _check_version(meta["version"], MODEL_VERSION, path)
    if meta["kind"] not in MODEL_KINDS:
        raise ValueError(f"{path}: unknown model kind {meta['kind']!r}")
    return meta.asDict()


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    model_meta(spark, path)
    return PipelineModel.load(f"{path}/model")


def with_versions(df: DataFrame, versions: dict[str, str | int | float]) -> DataFrame:
    """Attach version and weight columns to every scored row."""
    return df.withColumns({name: F.lit(value) for name, value in versions.items()})
