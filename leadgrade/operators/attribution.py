"""Scores of stored trees, and what each feature adds to the score of a row.

A feature's share is its Shapley value: the mean, over all orders in which the features
become known, of what knowing it changes. Where a feature isn't known, a row goes both
ways, by the rows that went there in training. A leaf's value depends on the features of
its path alone, and the mean over orders is an integral over the moment t at which
feature i becomes known: (o_i - z_i) times the product over the path's other features j of
z_j (1 - t) + o_j t, where o says that the row follows the path at j, and z is the share of
training rows that do. The product is a polynomial, so a few Gauss points give it exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tree = dict[str, np.ndarray]


def leaves(tree: Tree, rows: np.ndarray) -> np.ndarray:
    """The leaf that each row (rows, features) reaches."""
    node = np.zeros(len(rows), np.int64)
    at = np.flatnonzero(tree["left"][node] >= 0)
    while len(at):
        here = node[at]
        goes_left = rows[at, tree["feature"][here]] <= tree["threshold"][here]
        node[at] = np.where(goes_left, tree["left"][here], tree["right"][here])
        at = at[tree["left"][node[at]] >= 0]
    return node


def margins(rows: np.ndarray, start: float, trees: Sequence[Tree]) -> np.ndarray:
    out = np.full(len(rows), start)
    for tree in trees:
        out += tree["value"][leaves(tree, rows)]
    return out


class _Path(NamedTuple):
    """A leaf: for each feature of its path the range that leads there, (low, high], and the
    share of training rows that stay on the path at this feature's cuts."""

    value: float
    share: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    z: np.ndarray


def paths(tree: Tree) -> list[_Path]:
    found = []
    stack: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
    while stack:
        node, known = stack.pop()
        left, right = int(tree["left"][node]), int(tree["right"][node])
        if left < 0:
            names = sorted(known)
            columns = np.array([known[f] for f in names]).reshape(-1, 3).T
            share = float(tree["cover"][node] / tree["cover"][0])
            found.append(_Path(float(tree["value"][node]), share, np.array(names, np.int64), *columns))
            continue
        feature, cut = int(tree["feature"][node]), float(tree["threshold"][node])
        low, high, z = known.get(feature, (-np.inf, np.inf, 1.0))
        for child, a, b in ((left, low, min(high, cut)), (right, max(low, cut), high)):
            part = float(tree["cover"][child] / tree["cover"][node])
            stack.append((child, {**known, feature: (a, b, z * part)}))
    return found


def base_value(start: float, trees: Sequence[Tree]) -> float:
    """The mean score of the training rows, from the leaves' rows."""
    return start + sum(p.value * p.share for t in trees for p in paths(t))


#: Rows that are worked on at once, and features of a path up to which its cases are looked up in a table.
ROWS, MOST_BITS = 4096, 16


def contributions(rows: np.ndarray, trees: Sequence[Tree], known: Sequence[_Path] | None = None) -> np.ndarray:
    """(rows, features): what every feature adds to the score; base value plus a row's sum is
    its margin. ``known`` are the paths of all trees, for a caller that has several batches.

    What a path adds depends on which of its features a row follows it at, so it is worked out
    once for each such case that occurs, not for each row."""
    x = np.ascontiguousarray(rows.T)
    out = np.zeros(x.shape)
    for path in [p for t in trees for p in paths(t)] if known is None else known:
        d = len(path.features)
        if not d or not path.value:
            continue
        code = np.zeros(len(rows), np.int64)
        for i, (f, low, high) in enumerate(zip(path.features, path.low, path.high, strict=True)):
            code |= ((x[f] > low) & (x[f] <= high)).astype(np.int64) << i
        if d <= MOST_BITS:
            cases = np.flatnonzero(np.bincount(code, minlength=1 << d))
            place = np.empty(1 << d, np.int64)
            place[cases] = np.arange(len(cases))
            own = place[code]
        else:
            cases, own = np.unique(code, return_inverse=True)
        follows = (cases[:, None] >> np.arange(d)) & 1
        t, weight = np.polynomial.legendre.leggauss((d + 1) // 2)
        t, weight = (t + 1) / 2, weight / 2
        # (features, cases, points); all factors are above zero inside of (0, 1).
        factor = path.z[:, None, None] * (1 - t) + follows.T[:, :, None] * t
        product = factor.prod(axis=0) * weight
        gain = (product[None] / factor).sum(axis=2)
        added = path.value * ((follows - path.z).T * gain)
        for f, share in zip(path.features, added, strict=True):
            out[f] += share[own]
    return np.ascontiguousarray(out.T)


def explain(model, vectors: DataFrame, keep: Sequence[str] = ("lead_id",)) -> DataFrame:
    """``keep``, margin, base, contributions (array, one number per feature) for the rows of
    ``vectors`` under boosted trees. The trees are broadcast: their size is the model's."""
    size, start, trees = model.parts()
    sent = vectors.sparkSession.sparkContext.broadcast((start, base_value(start, trees), trees))
    names = [*keep, "margin", "base", "contributions"]
    source = vectors.select(*keep, vector_to_array("features").alias("_x"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, base, trees = sent.value
        known = [p for t in trees for p in paths(t)]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n = part.num_rows
                x = part["_x"].flatten().to_numpy(zero_copy_only=False).reshape(n, size)
                shares = contributions(x, trees, known)
                offsets = pa.array(np.arange(0, n * size + 1, size, dtype=np.int32))
                columns = [
                    *[part[c] for c in keep],
                    pa.array(margins(x, start, trees)),
                    pa.array(np.full(n, base)),
                    pa.ListArray.from_arrays(offsets, pa.array(shares.ravel())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(run, f"{kinds}, margin double, base double, contributions array<double>")


def mean_absolute(explained: DataFrame) -> DataFrame:
    """(position, mean_abs, n): mean absolute contribution by place of the feature."""
    rows = explained.select(F.posexplode("contributions").alias("position", "share"))
    return rows.groupBy("position").agg(F.avg(F.abs("share")).alias("mean_abs"), F.count("*").alias("n"))
