"""Bootstrap intervals from counted cells, with draws that any task can repeat.

A multinomial resample of n rows is close to drawing an independent Poisson count
for every cell of equal rows. A draw is a function of the cell's key, the replicate and the
seed: a few whole-number steps give a uniform, and the inverse distribution function gives
the count. So draws depend neither on partitions nor on other cells, whole matrices of cells
and replicates are drawn at once, and SQL can repeat them. Cells lie in blocks of fixed size,
ordered by score: a task turns a block into a few numbers per replicate, and running sums
over the blocks put them together. Nothing is binned; only equal scores count as tied.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrade import constants as C
from leadgrade.functions.clean import r6
from leadgrade.operators.classification import confusion_cells
from leadgrade.operators.ranking import score_counts
from leadgrade.plans.sizing import release, written

#: Cells of a block; all replicates of a block are drawn at once.
BLOCK = 2048
#: Counts up to here are drawn by the inverse distribution function.
TABLE = 1024
_MASK = np.uint64(0xFFFFFFFF)
# The usual 32-bit finaliser, and odd steps between replicates and kinds.
MIX = ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1))
STEP, KIND = 0x9E3779B1, 0x5BD1E995


def mixed(x: np.ndarray) -> np.ndarray:
    """Whole numbers below 2^32, each bit spread over all."""
    for shift, factor in MIX:
        x = ((x ^ (x >> np.uint64(shift))) * np.uint64(factor)) & _MASK
    return x


def uniforms(keys: np.ndarray, kind: int, draws: int, seed: int) -> np.ndarray:
    """(keys, draws) in (0, 1) from both halves of the 64-bit key, and the replicate."""
    keys = keys.astype(np.int64).view(np.uint64)[:, None]
    start = np.uint64(seed * STEP % (1 << 32))
    replicate = mixed((np.arange(draws, dtype=np.uint64) + start) & _MASK)
    low = (keys & _MASK) ^ np.uint64(kind * KIND)
    first = mixed(low ^ replicate)
    high = ((keys >> np.uint64(32)) + first) & _MASK
    second = mixed(high ^ ((replicate * np.uint64(STEP)) & _MASK))
    return (second.astype(np.float64) + 0.5) / 4294967296.0


@lru_cache(maxsize=4096)
def distribution(count: int) -> np.ndarray:
    """P(X <= k) of a Poisson number of mean ``count``, k from 0 to far above it."""
    last = count + int(12 * math.sqrt(count)) + 20
    return np.cumsum(
        [math.exp(k * math.log(count) - count - math.lgamma(k + 1)) for k in range(last + 1)]
    )


def poisson(keys: np.ndarray, counts: np.ndarray, kind: int, draws: int, seed: int) -> np.ndarray:
    """(cells, draws): a Poisson count of mean ``counts`` for every cell and replicate.

    Counts beyond ``TABLE`` come from a generator that the key seeds, one call a cell; there
    is at most one such cell in so many rows.
    """
    out = np.zeros((len(keys), draws))
    for count in np.unique(counts[counts > 0]):
        rows = np.flatnonzero(counts == count)
        if count <= TABLE:
            u = uniforms(keys[rows], kind, draws, seed)
            out[rows] = np.searchsorted(distribution(int(count)), u, side="right")
            continue
        for i in rows:
            key = np.array([int(keys[i]) & (2**64 - 1), seed * 2 + kind], np.uint64)
            out[i] = np.random.Generator(np.random.Philox(key=key)).poisson(count, draws)
    return out


_CELL = (("key", np.int64), ("score", np.float64), ("pos", np.int64), ("neg", np.int64))


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted cells (key, score, pos, neg) to blocks of at most ``BLOCK`` cells."""
    held, count = [], 0

    def block(parts: list) -> pa.RecordBatch:
        columns = [np.concatenate(x).astype(t) for x, (_, t) in zip(zip(*parts, strict=True), _CELL, strict=True)]
        values = [pa.array([c.tobytes()], pa.binary()) for c in columns]
        return pa.RecordBatch.from_arrays(values, names=[c for c, _ in _CELL])

    for batch in batches:
        columns = [batch[c].to_numpy(zero_copy_only=False) for c, _ in _CELL]
        while len(columns[0]):
            room = BLOCK - count
            held.append([c[:room] for c in columns])
            count += len(held[-1][0])
            columns = [c[room:] for c in columns]
            if count == BLOCK:
                yield block(held)
                held, count = [], 0
    if held:
        yield block(held)


def _blocks(cells: DataFrame, score: str, tie: Sequence[str] = ()) -> DataFrame:
    """Blocks of (key, score, pos, neg), best scores first, stored because all passes have
    to see the same blocks. Equal scores stand side by side, in the order of ``tie``."""
    order = [F.col(score).desc(), *tie]
    rows = cells.where(F.col(score).isNotNull() & ~F.isnan(score))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    columns = rows.select("key", F.col(score).cast("double").alias("score"), "pos", "neg")
    blocks = columns.mapInArrow(_to_blocks, "key binary, score binary, pos binary, neg binary")
    return written(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _drawn(r: dict, draws: int, seed: int):
    """(scores, positives, negatives) of a block: one row per score, best first."""
    key, score, pos, neg = (np.frombuffer(r[c], t) for c, t in _CELL)
    pos, neg = poisson(key, pos, 0, draws, seed), poisson(key, neg, 1, draws, seed)
    first = np.flatnonzero(np.concatenate([[True], score[1:] != score[:-1]]))
    if len(first) < len(score):
        pos, neg = np.add.reduceat(pos, first, axis=0), np.add.reduceat(neg, first, axis=0)
    return score[first], pos, neg


_SUMS = ("block", "score", "edge", "replicate", "pos", "neg", "area")


def _sum_blocks(draws: int, seed: int, distinct: bool):
    """Sums of every block by replicate, and the positives above each negative within it,
    ties half. Unless scores are distinct, the first and the last score of a block are parts
    of their own (``edge``): neighbours may hold them too."""

    def rows(r: dict, score: float, edge: bool, pos: np.ndarray, neg: np.ndarray) -> pa.RecordBatch:
        above = np.cumsum(pos, axis=0) - pos / 2
        n = pos.shape[1]
        columns = (
            np.full(n, r["block"]), np.full(n, score), np.full(n, edge), np.arange(n, dtype=np.int32),
            pos.sum(axis=0), neg.sum(axis=0), (neg * above).sum(axis=0),
        )
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(_SUMS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                score, pos, neg = _drawn(r, draws, seed)
                inner = slice(0, len(score)) if distinct else slice(1, len(score) - 1)
                if len(score[inner]):
                    yield rows(r, score[inner][0], False, pos[inner], neg[inner])
                for i in () if distinct else sorted({0, len(score) - 1}):
                    yield rows(r, score[i], True, pos[i : i + 1], neg[i : i + 1])

    return run


def _parts(blocks: DataFrame, draws: int, seed: int, distinct: bool) -> DataFrame:
    """(block, replicate, pos, neg, area, pos_above, neg_above) in order of the score."""
    kinds = "block long, score double, edge boolean, replicate int, pos double, neg double, area double"
    sums = blocks.mapInArrow(_sum_blocks(draws, seed, distinct), kinds)
    if not distinct:
        # A score that several blocks hold is one part; all its pairs are ties.
        sums = sums.groupBy("score", "edge", "replicate").agg(
            F.min("block").alias("block"), *[F.sum(c).alias(c) for c in ("pos", "neg", "area")]
        )
        half = F.col("pos") * F.col("neg") / 2
        sums = sums.withColumn("area", F.when(F.col("edge"), half).otherwise(F.col("area")))
    above = Window.partitionBy("replicate").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    return written(
        sums.withColumns(
            {f"{c}_above": F.coalesce(F.sum(c).over(above), F.lit(0.0)) for c in ("pos", "neg")}
        ).drop("score", "edge"),
        "parts",
    )


def _auc(parts: DataFrame, name: str) -> DataFrame:
    """(replicate, <name>): null where a replicate drew a single class."""
    pairs = F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0.0))
    wins = F.sum(F.col("area") + F.col("neg") * F.col("pos_above"))
    return parts.groupBy("replicate").agg((wins / pairs).alias(name))


def _average_precision(blocks: DataFrame, parts: DataFrame, draws: int, seed: int) -> DataFrame:
    """(replicate, average_precision), from the same draws once more."""
    before = parts.groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("replicate", "pos_above", "neg_above"))).alias("before")
    )
    before = before.select("block", "before.pos_above", "before.neg_above")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(draws)
        for batch in batches:
            for r in batch.to_pylist():
                _, pos, neg = _drawn(r, draws, seed)
                above = np.cumsum(pos, axis=0) + np.array(r["pos_above"])
                called = above + np.cumsum(neg, axis=0) + np.array(r["neg_above"])
                total += (pos * above / np.maximum(called, 1)).sum(axis=0)
        ids = pa.array(np.arange(draws, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([ids, pa.array(total)], names=["replicate", "part"])

    found = blocks.join(before, "block").mapInArrow(run, "replicate int, part double")
    sums = found.groupBy("replicate").agg(F.sum("part").alias("part"))
    classes = parts.groupBy("replicate").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    value = F.when(F.col("n") > 0, F.col("part") / F.nullif("p", F.lit(0.0)))
    return sums.join(classes, "replicate").select("replicate", value.alias("average_precision"))


def interval(draws: DataFrame, metrics: Sequence[str], alpha: float) -> DataFrame:
    """(metric, lower, upper, n_draws) over the replicates that are defined.

    There is one row per replicate, so exact percentiles are bounded here.
    """
    rows = []
    for m in metrics:
        value = F.col(m)
        rows.append(
            F.struct(
                F.lit(m).alias("metric"),
                F.percentile(value, F.lit(alpha / 2)).alias("lower"),
                F.percentile(value, F.lit(1 - alpha / 2)).alias("upper"),
                F.avg(value).alias("mean"),
                F.count(value).alias("n_draws"),
            )
        )
    return draws.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r6(c) for c in ("lower", "upper", "mean")})


def bootstrap_ci(
    df: DataFrame,
    score: str,
    label: str,
    draws: int = C.BOOTSTRAP_DRAWS,
    alpha: float = C.CONFIDENCE_ALPHA,
    seed: int = C.DEFAULT_SEED,
    key: Column | None = None,
) -> DataFrame:
    """Intervals of roc_auc and average_precision over the rows with score and label.

    ``key`` is a long made of the column ``score`` that tells distinct scores apart; draws
    follow it. Without it, it is a hash of the score.
    """
    key = F.xxhash64("score") if key is None else key
    cells = score_counts(df, score, label).withColumn("key", key)
    blocks = _blocks(cells, "score")
    parts = _parts(blocks, draws, seed, True)
    drawn = _auc(parts, "roc_auc").join(_average_precision(blocks, parts, draws, seed), "replicate")
    result = written(_rounded(interval(drawn, ("roc_auc", "average_precision"), alpha)), "interval")
    release(blocks, parts)
    return result


def paired_bootstrap(
    df: DataFrame,
    score_a: str,
    score_b: str,
    label: str,
    draws: int = C.BOOTSTRAP_DRAWS,
    alpha: float = C.CONFIDENCE_ALPHA,
    seed: int = C.DEFAULT_SEED,
    key: Column | None = None,
) -> DataFrame:
    """Interval of AUC(b) - AUC(a), both read off the same resample.

    Rows are counted per pair of scores, and a pair draws the same in both orders. ``key``:
    as in ``bootstrap_ci``, of the columns ``a`` and ``b``. A score that many pairs share
    fills as many blocks as it needs.
    """
    y = F.col(label).cast("int")
    a, b = F.col(score_a).cast("double"), F.col(score_b).cast("double")
    cells = (
        df.select(a.alias("a"), b.alias("b"), y.alias("_y"))
        .where("a is not null and b is not null and _y is not null")
        .where(~F.isnan("a") & ~F.isnan("b"))
        .groupBy("a", "b")
        .agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
        .withColumn("key", F.xxhash64("a", "b") if key is None else key)
    )
    cells = written(cells, "pairs")
    blocks = [_blocks(cells, one, (other,)) for one, other in (("a", "b"), ("b", "a"))]
    parts = [_parts(x, draws, seed, False) for x in blocks]
    sides = [_auc(x, name) for x, name in zip(parts, ("auc_a", "auc_b"), strict=True)]
    drawn = sides[0].join(sides[1], "replicate").select(
        "replicate", (F.col("auc_b") - F.col("auc_a")).alias("auc_difference")
    )
    result = written(_rounded(interval(drawn, ("auc_difference",), alpha)), "interval")
    release(cells, *blocks, *parts)
    return result.withColumn("significant", (F.col("lower") > 0) | (F.col("upper") < 0))


def bootstrap_f1(
    df: DataFrame,
    truth: str,
    guess: str,
    labels: Sequence[str] = C.ATTITUDES,
    draws: int = C.BOOTSTRAP_DRAWS,
    alpha: float = C.CONFIDENCE_ALPHA,
    seed: int = C.DEFAULT_SEED,
) -> DataFrame:
    """Interval of macro F1 over ``labels``: one Poisson draw per confusion cell.

    A null or unknown label is a class of its own: wrong wherever it stands, and not
    in the mean.
    """
    codes = F.array(*[F.lit(x) for x in labels])
    k = len(labels)

    def code(name: str) -> Column:
        at = F.coalesce(F.array_position(codes, F.col(name)), F.lit(0))
        return F.when(at > 0, at - 1).otherwise(k).cast("int")

    cells = (
        confusion_cells(df, truth, guess)
        .groupBy(code("truth").alias("t"), code("guess").alias("g"))
        .agg(F.sum("n").alias("n"))
    )
    # At most (labels + 1) squared cells, in one row.
    whole = cells.agg(F.array_sort(F.collect_list(F.struct("t", "g", "n"))).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in batch["cells"].to_pylist():
                t, g, n = (np.array([c[x] for c in found], np.int64) for x in ("t", "g", "n"))
                grid = np.zeros((k + 1, k + 1, draws))
                grid[t, g] = poisson(t * (k + 1) + g, n, 0, draws, seed)
                both = (grid.sum(axis=0) + grid.sum(axis=1))[:k]
                right = grid[np.arange(k), np.arange(k)]
                f1 = np.divide(2 * right, both, out=np.zeros_like(both), where=both > 0)
                seen = (both > 0).sum(axis=0)
                mean = np.where(seen > 0, f1.sum(axis=0) / np.maximum(seen, 1), np.nan)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(draws)), pa.array(mean, from_pandas=True)], names=["replicate", "f1_macro"]
                )

    drawn = whole.mapInArrow(run, "replicate long, f1_macro double")
    return _rounded(interval(drawn, ("f1_macro",), alpha))
