"""Conversion models: weights, cross-validated training, scoring, explanation."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.operators import attribution, boosting, logistic, ranking, splits
from leadgrade.operators.features import FeatureState
from leadgrade.plans.sizing import release

# The search grids.
LR_GRID = (0.01, 0.1, 1.0, 10.0)
GBT_GRID = {"maxLeaves": (15, 31, 63), "stepSize": (0.05, 0.1), "maxIter": (100, 300)}


@dataclass
class Trained:
    model: PipelineModel
    kind: str
    best_params: dict[str, float]
    cv_auc: float


def training_table(
    state: FeatureState,
    derived: DataFrame,
    label: str = "converted",
    k: int = 5,
    balanced: bool = True,
) -> DataFrame:
    """(lead_id, label, features, weight, fold) from derived rows with id and label.

    Balanced weights sum to n; otherwise positives weigh neg/pos. The counts come
    from one aggregate and join back as a single row. Folds are assigned before the
    vectors are built, so the wide rows are never shuffled.
    """
    labelled = derived.withColumn("label", F.col(label).cast("double"))
    folded = splits.kfold(labelled, ["label"], k)
    vectors = state.vectors(folded, ["lead_id", "label", "fold"])
    counts = derived.agg(
        F.count_if(F.col(label) == 1).alias("_pos"),
        F.count_if(F.col(label) == 0).alias("_neg"),
    )
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    positive = F.col("label") == 1
    if balanced:
        own = F.when(positive, pos).otherwise(neg)
        weight = (pos + neg) / F.nullif(own * 2, F.lit(0.0))
    else:
        weight = F.when(positive & (pos > 0), neg / F.nullif(pos, F.lit(0.0))).otherwise(1.0)
    weighted = vectors.crossJoin(F.broadcast(counts)).withColumn("weight", weight)
    return weighted.select("lead_id", "label", "features", "weight", "fold")


def _auc_by_model(margins: DataFrame, groups: Sequence[str]) -> dict[tuple, float]:
    """AUC of held-out margins; one number per model of the search reaches the driver."""
    found = ranking.ranking_metrics(margins, "margin", "label", groups).collect()
    return {tuple(r[g] for g in groups): r["roc_auc"] for r in found}


def _mean(values: Sequence[float | None]) -> float:
    """Mean over the folds whose AUC is defined, NaN without any."""
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else float("nan")


def _first_best(means: Sequence[float]) -> int:
    return max(range(len(means)), key=lambda i: (means[i] == means[i], means[i], -i))


def _best(estimator, grid, table: DataFrame, k: int, parallelism: int):
    """(model, index of the best cell, its mean AUC over the folds).

    The best cell is refitted on all rows. A single cell needs no search, and its
    AUC is NaN.
    """
    estimator = estimator.copy({estimator.parallelism: parallelism})
    if len(grid) == 1:
        return estimator.copy(grid[0]).fit(table), 0, float("nan")
    return estimator.search(grid, table, k)


def train_logistic(table: DataFrame, grid: Sequence[float] = LR_GRID, k: int = 5) -> Trained:
    """Balanced logistic regression; ``grid`` holds inverse penalties C.

    The loss here is a weighted mean, so a penalty C on a weighted sum becomes
    ``1 / (C * n)``. All cells and folds, and the fits on all rows, take their Newton
    steps in the same passes. A single cell has no folds, and its AUC is NaN.
    """
    spark, n = table.sparkSession, table.count()
    first = table.first()
    if first is None:
        raise ValueError("no rows to train on")
    size = len(first["features"])
    penalties = [1.0 / (c * n) for c in grid]
    folds = range(k) if len(grid) > 1 else ()
    specs = [logistic.Spec(p, f) for p in penalties for f in (*folds, -1)]
    stored = logistic.rows_of(table)
    found = logistic.train(stored, specs, size)
    best, auc = 0, float("nan")
    if folds:
        held = [i for i, s in enumerate(specs) if s.fold >= 0]
        margins = logistic.held_out_margins(stored, [specs[i] for i in held], [found[i] for i in held])
        by_model = _auc_by_model(margins, ["model"])
        means = [_mean([by_model.get((c * k + f,)) for f in folds]) for c in range(len(grid))]
        best = _first_best(means)
        auc = means[best]
    release(stored)
    beta = found[(best + 1) * (len(folds) + 1) - 1]
    model = _logistic_model(spark, beta[:-1], float(beta[-1]))
    return Trained(PipelineModel([model]), "logistic_regression", {"C": grid[best]}, auc)


def _logistic_model(spark: SparkSession, beta: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """Spark ML's own model, so that scoring, saving and streams stay inside the JVM."""
    vector = _py2java(spark.sparkContext, Vectors.dense(beta.tolist()))
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"logistic-{uuid.uuid4().hex[:12]}", vector, intercept
    )
    return LogisticRegressionModel(made)


class _TreeParams(Params):
    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a leaf's step that is taken", TypeConverters.toFloat)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "leaves of a tree", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree, 0: any", TypeConverters.toInt)
    minRows = Param(Params._dummy(), "minRows", "rows of a leaf, at least", TypeConverters.toInt)
    parallelism = Param(Params._dummy(), "parallelism", "models that small tables train at once", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(
            maxIter=100, stepSize=0.1, maxLeaves=31, maxDepth=0, minRows=boosting.MIN_ROWS, parallelism=32
        )

    def spec(self, fold: int = -1) -> boosting.Spec:
        value = self.getOrDefault
        return boosting.Spec(
            value(self.maxLeaves), value(self.maxDepth), value(self.stepSize), value(self.maxIter), fold
        )


class BoostedTrees(Estimator, _TreeParams):
    """Trees over (label, features, weight, fold); see ``boosting``."""

    def _train(self, table: DataFrame, specs: Sequence[boosting.Spec]):
        first = table.first()
        if first is None:
            raise ValueError("no rows to train on")
        bins = boosting.find_bins(table, len(first["features"]))
        stored = boosting.blocks(table, bins)
        tasks = self.getOrDefault(self.parallelism)
        return bins, stored, boosting.train(stored, specs, bins, self.getOrDefault(self.minRows), tasks=tasks)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        bins, stored, trained = self._train(dataset, [self.spec()])
        release(stored)
        return BoostedTreesModel.of(bins, *trained[0])

    def search(self, grid, table: DataFrame, k: int) -> tuple[BoostedTreesModel, int, float]:
        """(model, index of the best cell of ``grid``, its mean AUC over the folds).

        Cells that differ in the number of trees alone share their trees: the smaller one is
        read off the first trees of the larger. The fits on all rows run beside the folds.
        """
        cells = [self.copy(cell).spec() for cell in grid]
        most: dict[tuple, int] = {}
        for c in cells:
            shape = (c.leaves, c.depth, c.rate)
            most[shape] = max(most.get(shape, 0), c.trees)
        shapes = list(most)
        specs = [boosting.Spec(*s, most[s], fold) for s in shapes for fold in (*range(k), -1)]
        bins, stored, trained = self._train(table, specs)
        held = [i for i, s in enumerate(specs) if s.fold >= 0]
        stops = sorted({c.trees for c in cells})
        margins = boosting.held_out_margins(
            stored, [specs[i] for i in held], [trained[i] for i in held], bins, stops
        )
        by_model = _auc_by_model(margins, ["model", "trees"])
        means = [
            _mean([by_model.get((shapes.index(c[:3]) * k + f, c.trees)) for f in range(k)]) for c in cells
        ]
        release(stored)
        best = _first_best(means)
        start, trees = trained[shapes.index(cells[best][:3]) * (k + 1) + k]
        return BoostedTreesModel.of(bins, start, trees[: cells[best].trees]), best, means[best]


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Trees with plain thresholds: a row goes left where its value is at most the threshold."""

    trees = Param(Params._dummy(), "trees", "start margin and nodes of all trees, as JSON", TypeConverters.toString)

    @classmethod
    def of(cls, bins: boosting.Bins, start: float, trees: Sequence[boosting.Tree]) -> BoostedTreesModel:
        model = cls()
        nodes = []
        for t in trees:
            cuts = [bins.cuts[f][b] if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin, strict=True)]
            nodes.append(
                {
                    "feature": t.feature.tolist(),
                    "threshold": [float(x) for x in cuts],
                    **{c: getattr(t, c).tolist() for c in ("left", "right", "value", "gain", "cover")},
                }
            )
        text = json.dumps({"features": len(bins.cuts), "start": start, "trees": nodes})
        return model._set(trees=text)

    def parts(self) -> tuple[int, float, list[dict[str, np.ndarray]]]:
        """(number of features, start margin, arrays of every tree)."""
        stored = json.loads(self.getOrDefault(self.trees))
        return stored["features"], stored["start"], [
            {c: np.array(v) for c, v in t.items()} for t in stored["trees"]
        ]

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - as on Spark ML's own models
        """Gain of every feature, as a share of all gain."""
        size, _, trees = self.parts()
        gain = np.zeros(size)
        for t in trees:
            inner = t["left"] >= 0
            np.add.at(gain, t["feature"][inner], t["gain"][inner])
        return Vectors.dense((gain / gain.sum() if gain.sum() > 0 else gain).tolist())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size, start, trees = self.parts()
        sent = dataset.sparkSession.sparkContext.broadcast((size, start, trees))

        @F.arrow_udf("double")
        def margin(x: pa.Array) -> pa.Array:
            size, start, trees = sent.value
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), size)
            return pa.array(attribution.margins(rows, start, trees))

        found = margin(vector_to_array("features"))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        return dataset.withColumn("_margin", found).withColumn("_p", p).withColumns(
            {
                "probability": array_to_vector(F.array(F.lit(1.0) - F.col("_p"), F.col("_p"))),
                "prediction": (F.col("_p") > 0.5).cast("double"),
            }
        ).drop("_margin", "_p")


def train_boosted(
    table: DataFrame,
    grid: Mapping[str, Sequence[float]] = GBT_GRID,
    k: int = 5,
    parallelism: int = 32,
) -> Trained:
    """Boosted trees over the grid."""
    base = BoostedTrees()
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(base.getParam(name), list(values))
    params = builder.build()
    model, best, auc = _best(base, params, table, k, parallelism)
    chosen = {p.name: v for p, v in params[best].items()}
    return Trained(PipelineModel([model]), "boosted_trees", chosen, auc)


def score(model: PipelineModel, vectors: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus the probability of the positive class."""
    p = vector_to_array("probability")[1]
    return model.transform(vectors).select(*keep, p.alias("p_conversion"))


def feature_names(state: FeatureState) -> DataFrame:
    """(position, feature) of every vector element, numbered without collecting names."""
    catalog = state.catalog().groupBy("block", "major", "slot", "name").count()
    # Widths of the groups (block, major): a handful of rows, whatever the slots.
    widths = catalog.groupBy("block", "major").agg(F.count("*").alias("width"))
    order = Window.orderBy("block", "major").rowsBetween(Window.unboundedPreceding, -1)
    starts = widths.withColumn("start", F.coalesce(F.sum("width").over(order), F.lit(0)))
    first = F.when(F.col("block") == 1, F.col("slot")).otherwise(0)
    position = F.col("start") + first
    return catalog.join(F.broadcast(starts), ["block", "major"]).select(
        position.cast("int").alias("position"), F.col("name").alias("feature")
    )


def feature_importance(
    model: PipelineModel, state: FeatureState, top: int = 15
) -> DataFrame:
    """Gain per feature name, largest first (one number per feature, not per row)."""
    gains = model.stages[-1].featureImportances.toArray()
    rows = state.spark.createDataFrame(
        [(i, float(g)) for i, g in enumerate(gains)], "position int, gain double"
    )
    table = rows.join(feature_names(state), "position").select("feature", "gain")
    return table.orderBy(F.desc("gain"), "feature").limit(top)


def named_contributions(explained: DataFrame, state: FeatureState) -> DataFrame:
    """(feature, mean_abs, n): mean absolute contribution by name."""
    found = attribution.mean_absolute(explained).join(feature_names(state), "position")
    return found.select("feature", r6("mean_abs").alias("mean_abs"), "n")


def linear_attribution(
    df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float] | None = None
) -> DataFrame:
    """Add ``contrib_<feature>`` = coefficient * (value - mean) per row."""
    means = means or {}
    return df.withColumns(
        {
            f"contrib_{c}": F.lit(float(b)) * (F.col(c) - F.lit(float(means.get(c, 0.0))))
            for c, b in coefficients.items()
        }
    )


def mean_absolute_contribution(df: DataFrame, features: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(c).alias("feature"), r6(F.avg(F.abs(f"contrib_{c}"))).alias("mean_abs")
        )
        for c in features
    ]
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def model_metrics(
    scored: DataFrame,
    label: str = "converted",
    thresholds: Sequence[float] = C.DECISION_THRESHOLDS,
) -> DataFrame:
    """(model, split, metric, value) rows from (model, split, label, p_conversion)."""
    groups = ["model", "split"]
    counts = ranking.score_counts(scored, "p_conversion", label, groups)
    curve = ranking.cumulative(counts, groups)
    hits = []
    for t in thresholds:
        above = F.col("score") >= t
        called = F.sum(F.when(above, F.col("pos") + F.col("neg")).otherwise(0))
        right = F.sum(F.when(above, F.col("pos")).otherwise(0))
        zero = F.lit(0.0)
        name = str(t).replace(".", "_")
        hits += [
            (f"precision_at_{name}", F.coalesce(right / F.nullif(called, F.lit(0)), zero)),
            (
                f"recall_at_{name}",
                F.coalesce(right / F.nullif(F.sum("pos"), F.lit(0)), zero),
            ),
        ]
    table = curve.groupBy(*groups).agg(
        F.max(F.col("total_pos") + F.col("total_neg")).cast("double").alias("n"),
        r6(ranking.roc_auc_expr()).alias("roc_auc"),
        r6(ranking.average_precision_expr()).alias("average_precision"),
        *[r6(col).alias(name) for name, col in hits],
    )
    values = [c for c in table.columns if c not in groups]
    return table.unpivot(groups, values, "metric", "value")
