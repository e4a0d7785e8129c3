"""Penalised logistic regressions of all cells and folds at once, by Newton steps.

One pass over the stored rows gives, for every model, the gradient and the curvature matrix
at its present coefficients: a few square matrices of the number of features, summed by
the tasks. The steps are solved on the driver, where only these matrices arrive. The loss
is the weighted mean of the log losses plus half the penalty times the squared
coefficients; the intercept isn't penalised.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.plans.partials import merged
from leadgrade.plans.sizing import written

MAX_STEPS, TOLERANCE = 50, 1e-11


class Spec(NamedTuple):
    """One model: its penalty, and the fold that it doesn't see (-1: none)."""

    penalty: float
    fold: int = -1


_ROWS = "x array<double>, label double, weight double, fold int"


def rows_of(table: DataFrame) -> DataFrame:
    """(label, features, weight, fold) with plain arrays, stored: every step reads it. A small
    table is dealt out, so that all slots share the steps."""
    slots = table.sparkSession.sparkContext.defaultParallelism
    spread = table if table.rdd.getNumPartitions() >= slots else table.repartition(slots)
    return written(
        spread.select(
            vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"),
            F.col("weight").cast("double").alias("weight"), F.col("fold").cast("int").alias("fold"),
        ), "rows",
    )


def _opened(batch: pa.RecordBatch):
    x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    x = np.column_stack([x, np.ones(batch.num_rows)])
    return x, *(batch[c].to_numpy(zero_copy_only=False) for c in ("label", "weight", "fold"))


def _sums(specs: Sequence[Spec], weights: dict[int, np.ndarray]):
    """Per partition and model: weight, loss, gradient and curvature at ``weights``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x, y, w, fold = _opened(batch)
            for m, beta in weights.items():
                seen = fold != specs[m].fold
                own, label, share = x[seen], y[seen], w[seen]
                margin = own @ beta
                p = 1.0 / (1.0 + np.exp(-margin))
                loss = np.logaddexp(0.0, margin) - label * margin
                gradient = own.T @ (share * (p - label))
                curvature = (own * (share * p * (1 - p))[:, None]).T @ own
                part = np.concatenate([[share.sum(), (share * loss).sum()], gradient, curvature.ravel()])
                total[m] = total[m] + part if m in total else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            names=["model", "sums"],
        )

    return run


class _Newton:
    """One model between steps."""

    def __init__(self, penalty: float, size: int):
        self.penalty, self.beta, self.best = np.full(size, penalty), np.zeros(size), None
        self.penalty[-1] = 0.0
        self.loss, self.done = np.inf, False

    def take(self, sums: np.ndarray) -> None:
        """Judge the present coefficients by their sums, and move on."""
        n, size = sums[0], len(self.beta)
        if n <= 0:
            self.done = True
            return
        loss = sums[1] / n + 0.5 * float(self.penalty @ self.beta**2)
        if loss > self.loss * (1 + 1e-12) + 1e-15 and np.abs(self.beta - self.best).max() > TOLERANCE:
            self.beta = (self.beta + self.best) / 2  # The step was too long.
            return
        gradient = sums[2 : 2 + size] / n + self.penalty * self.beta
        curvature = sums[2 + size :].reshape(size, size) / n + np.diag(self.penalty)
        self.loss, self.best = loss, self.beta
        step = np.linalg.lstsq(curvature, gradient, rcond=None)[0]
        self.done = np.abs(step).max() <= TOLERANCE * max(1.0, np.abs(self.beta).max())
        self.beta = self.beta - step


def train(stored: DataFrame, specs: Sequence[Spec], size: int) -> list[np.ndarray]:
    """Coefficients and then the intercept of every model over the stored ``rows_of``."""
    models = [_Newton(s.penalty, size + 1) for s in specs]
    parts = stored.rdd.getNumPartitions()
    for _ in range(MAX_STEPS):
        busy = {m: x.beta for m, x in enumerate(models) if not x.done}
        if not busy:
            break
        sums = stored.mapInArrow(_sums(specs, busy), "model int, sums binary")
        found = merged(sums, ("model",), lambda total: (total.tobytes(),), "sums binary", parts=parts)
        rows = found.collect()
        for r in rows:
            models[r["model"]].take(np.frombuffer(r["sums"]))
        if not rows:
            break
    return [x.beta for x in models]


def held_out_margins(stored: DataFrame, specs: Sequence[Spec], found: Sequence[np.ndarray]) -> DataFrame:
    """(model, label, margin) of the rows that a model didn't see."""
    specs, found = list(specs), list(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, _, fold = _opened(batch)
            for m, spec in enumerate(specs):
                rows = fold == spec.fold
                n = int(rows.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, m, np.int32)), pa.array(y[rows]), pa.array(x[rows] @ found[m])],
                    names=["model", "label", "margin"],
                )

    return stored.mapInArrow(run, "model int, label double, margin double")
