"""Centroid clustering whose distances are brought up to date, not computed anew.

Every vector keeps its exact inner product with every centroid. A new centroid differs
from the old one in some components; only those change the product, by the difference
times the vector's component. Squared distances follow as |v|^2 - 2 v.c + |c|^2, in whole
numbers throughout, so nothing depends on the order of additions or on partitions. The
table of products is written after each round and takes the place of the one before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.llm.vectors import matrix, whole
from leadgrade.plans.sizing import release, written

CENTROIDS, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64.0, "1"
_MOST = (1 << 63) - 1


def starts(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors of the ``k`` smallest sha256 of ``seed:<vec_id>``, in that order.

    ``k`` rows reach the driver. Rows without an id come last, equal ids go by their vector.
    """
    key = F.sha2(F.concat_ws(":", F.lit(seed), F.col("vec_id").cast("string")), 256)
    key = F.when(F.col("vec_id").isNotNull(), key)
    rows = kept.select("v", key.alias("key")).orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _updated(old: np.ndarray, new: np.ndarray):
    """Products and nearest centroid of every vector, when ``old`` centroids become ``new``.

    Products read from the rows belong to ``old``; rows without products start from zero
    vectors. Only components in which a centroid moved are touched.
    """
    step = new - old
    moved = [(c, np.flatnonzero(d)) for c, d in enumerate(step) if d.any()]
    size = (new * new).sum(axis=1)
    k, dim = new.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            v = matrix(batch["v"], n).reshape(n, dim)
            if "dots" in batch.schema.names:
                dots = matrix(batch["dots"], n).reshape(n, k).copy()
            else:
                dots = np.zeros((n, k), np.int64)
            columns = np.ascontiguousarray(v.T)
            for c, at in moved:
                dots[:, c] += step[c, at] @ columns[at]
            away = size - 2 * dots
            nearest = away.argmin(axis=1)
            distance = (v * v).sum(axis=1) + away[np.arange(n), nearest]
            offsets = pa.array(np.arange(0, n * k + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    batch["v"],
                    pa.ListArray.from_arrays(offsets, pa.array(dots.ravel())),
                    pa.array(nearest.astype(np.int32)),
                    pa.array(distance),
                ],
                names=["vec_id", "v", "dots", "cluster", "distance"],
            )

    return run


def _sums(k: int, dim: int):
    """Per partition: the number of vectors and the sum of every component, by cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            v, own = matrix(batch["v"], batch.num_rows), batch["cluster"].to_numpy()
            for c in np.unique(own):
                count[c] += (own == c).sum()
                total[c] += v[own == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(used.astype(np.int32)),
                "n": pa.array(count[used]),
                "total": pa.array(list(total[used]), pa.list_(pa.int64())),
            }
        )

    return run


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) per component of every non-empty cluster; empty ones stay.

    One row per cluster and component reaches the driver.
    """
    k, dim = centroids.shape
    parts = state.select("v", "cluster").mapInArrow(
        _sums(k, dim), "cluster int, n long, total array<long>"
    )
    whole_sum = F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
    sums = (
        parts.select("cluster", "n", F.posexplode("total").alias("at", "x"))
        .groupBy("cluster", "at")
        .agg(F.sum("n").alias("n"), whole_sum)
    )
    new = centroids.copy()
    for r in sums.collect():
        new[r["cluster"], r["at"]] = int(r["x"]) // r["n"]
    return new


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dim: int = DIM,
    scale: float = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every kept
    row of ``vectors`` (vec_id, embedding).

    Kept are vectors of exactly ``dim`` components, none null or non-finite; other rows give
    none. Components become floor(scale * x) and stop at 2^25. Equal distances go to the
    smaller centroid. Repeated rows count each; a row without id is clustered but starts
    no centroid while others are left. Fewer kept vectors than ``k`` give fewer centroids,
    none an empty table. Other columns play no part. The driver holds ``k * dim`` numbers.
    """
    id_type = dict(vectors.dtypes)["vec_id"]
    out = (
        f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, "
        "inertia long, centroid_sha256 string"
    )
    usable = vectors.where(F.size("embedding") == dim)
    state = written(whole(usable, scale, ("vec_id",)).drop("dim"), "vectors")
    spark, new = vectors.sparkSession, starts(state, k, seed)
    if not len(new):
        return spark.createDataFrame([], out)
    schema = f"vec_id {id_type}, v array<int>, dots array<long>, cluster int, distance long"
    old = np.zeros_like(new)
    for turn in range(rounds + 1):
        # The state at hand has the products with ``old``.
        last, state = state, written(state.mapInArrow(_updated(old, new), schema), "products")
        release(last)
        if turn < rounds:
            old, new = new, _moved(state, new)
    inertia = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    sums = {r["cluster"]: int(r["inertia"]) for r in state.groupBy("cluster").agg(inertia).collect()}
    total = min(sum(sums.values()), _MOST)
    about = [
        (c, min(s, _MOST), total, hashlib.sha256(",".join(map(str, new[c])).encode()).hexdigest())
        for c, s in sums.items()
    ]
    table = spark.createDataFrame(
        about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
