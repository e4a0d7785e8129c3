"""Boosted trees for a binary outcome: every cell of a grid and every fold in shared passes.

Features are cut into bins once and kept as bytes. A tree grows in rounds: gradients are
summed by leaf, feature and bin, each leaf's best cut follows from these sums, and the
leaves of greatest gain are split until the tree has its number of leaves. Gradients are
whole multiples of a small step, so sums are exact and the trees depend neither on
partitions nor on the order of rows. Only bins other than a feature's usual one are summed;
the usual bin has the rest of its leaf, so that a row costs as many steps as it has unusual
values, however many one-hot features there are.

A table whose bins fit a task's memory goes to one task per model (cell and fold), all at the
same time. A larger one stays in blocks: each round is one pass that sums the histograms of
all models, merges them by model and leaf, and brings them back, one for every leaf that was
split. Both ways run the same steps on the same sums and give the same trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.plans.sizing import release, written

#: Bins of a feature, at most.
BINS = 255
#: Rows of a block, and bytes of bins up to which a task trains a model alone. Fewer models than
#: slots would leave slots idle: a quarter of these bytes is their limit.
BLOCK, TASK_BYTES = 1 << 14, 128 << 20
#: Rows of a leaf from which on its sums are taken line by line.
FEW = 1 << 11
#: Bytes of all tasks' sums of a pass that are merged without another stage.
MERGE_BYTES = 8 << 20
#: Blocks keep their margins for so many trees before they are written again.
KEEP = 10
#: Gradients are multiples of 1 / STEP.
STEP = float(1 << 28)
# The least rows and curvature of a leaf that the usual learner allows.
MIN_ROWS, MIN_CURVATURE = 20, 1e-3


class Spec(NamedTuple):
    """One model: its limits, step size, trees, and the fold that it doesn't see (-1: none)."""

    leaves: int
    depth: int
    rate: float
    trees: int
    fold: int = -1


class Bins(NamedTuple):
    """Cut values of every feature; a value's bin is the number of cuts below it."""

    cuts: list[np.ndarray]

    @property
    def starts(self) -> np.ndarray:
        """Place of every feature's first bin when all bins stand in a row, and the end."""
        return np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])])


class Tree(NamedTuple):
    """Nodes in the order of their making. A leaf has left -1; rows whose bin is at most
    ``bin`` go left. ``value`` holds the rate already, ``cover`` the rows."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray


class Cuts(NamedTuple):
    """The best cut of some leaves, an element for each: gain minus infinity if none is
    allowed. The sums are those left of the cut, and of the whole leaf."""

    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    whole: np.ndarray


def best_cuts(sums: np.ndarray, starts: np.ndarray, min_rows: int) -> Cuts:
    """``sums``: (leaves, 3, bins) of gradient, curvature and rows. Ties: first feature, bin."""
    run = np.cumsum(sums, axis=2)
    zero = np.zeros((*run.shape[:2], 1))
    before = np.concatenate([zero, run], axis=2)
    size = np.diff(starts)
    base = np.repeat(before[:, :, starts[:-1]], size, axis=2)
    left = run - base
    whole = left[:, :, starts[1] - 1]
    right = whole[:, :, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[:, 0] ** 2 / left[:, 1] + right[:, 0] ** 2 / right[:, 1]
        gain -= (whole[:, 0] ** 2 / whole[:, 1])[:, None]
    fits = np.minimum(left[:, 2], right[:, 2]) >= min_rows
    fits &= np.minimum(left[:, 1], right[:, 1]) >= MIN_CURVATURE * STEP
    fits[:, starts[1:] - 1] = False
    gain = np.where(fits & (gain > 0), gain, -np.inf)
    at = gain.argmax(axis=1)
    feature = np.searchsorted(starts, at, side="right") - 1
    rows = np.arange(len(at))
    return Cuts(gain[rows, at] / STEP, feature, at - starts[feature], left[rows, :, at], whole)


class Growth:
    """A tree while it grows. ``open`` are the leaves whose best cut isn't known yet; those
    with too few rows for two leaves never are."""

    def __init__(self, spec: Spec, min_rows: int):
        self.spec, self.min_rows, self.open, self.waiting = spec, min_rows, [0], {}
        self.nodes = [[-1, 0, -1, -1]]
        self.sums: list = [None]
        self.gains, self.level, self.leaves = [0.0], [0], 1

    def advance(self, cuts: Cuts | None) -> list[int]:
        """Take the best cuts of the open leaves, split those of greatest gain (equal ones:
        the older leaf) and name them; their children are open then. No name: it is grown.

        A round splits at most half as many leaves as may still come, so that a good cut
        deeper down isn't beaten by poor ones higher up."""
        for i, node in enumerate(self.open):
            self.sums[node] = cuts.whole[i]
            deep = self.spec.depth and self.level[node] >= self.spec.depth
            if cuts.gain[i] > 0 and not deep:
                self.waiting[node] = (cuts.gain[i], int(cuts.feature[i]), int(cuts.bin[i]), cuts.left[i])
        room = (self.spec.leaves - self.leaves + 1) // 2
        chosen = sorted(self.waiting, key=lambda n: (-self.waiting[n][0], n))[:room]
        self.open = []
        for node in chosen:
            gain, feature, cut, left = self.waiting.pop(node)
            a = len(self.nodes)
            self.nodes[node] = [feature, cut, a, a + 1]
            self.gains[node] = gain
            self.nodes += [[-1, 0, -1, -1], [-1, 0, -1, -1]]
            self.sums += [left, self.sums[node] - left]
            self.gains += [0.0, 0.0]
            self.level += [self.level[node] + 1] * 2
            self.open += [c for c in (a, a + 1) if self.sums[c][2] >= 2 * self.min_rows]
        self.leaves += len(chosen)
        if self.leaves == self.spec.leaves:
            self.open, self.waiting = [], {}
        return chosen

    def smaller(self, split: Sequence[int]) -> dict[int, int]:
        """Of every split leaf with a child that is open, the child of fewer rows: its sums are
        taken, the other has the rest of its parent's."""
        wanted = [n for n in split if set(self.nodes[n][2:]) & set(self.open)]
        return {min(self.nodes[n][2:], key=lambda c: self.sums[c][2]): n for n in wanted}

    def learn(self, known: dict[int, np.ndarray], small: dict[int, int], found: Sequence[np.ndarray]) -> None:
        """Put the sums of both children in the place of their parent's."""
        for (child, node), sums in zip(small.items(), found, strict=True):
            a, b = self.nodes[node][2:]
            known[child], known[a + b - child] = sums, known.pop(node) - sums

    def tree(self) -> Tree:
        feature, cut, left, right = (np.array(x, np.int32) for x in zip(*self.nodes, strict=True))
        sums = np.array(self.sums)
        value = np.where(left < 0, -self.spec.rate * sums[:, 0] / np.maximum(sums[:, 1], 1.0), 0.0)
        return Tree(feature, cut, left, right, value, np.array(self.gains), sums[:, 2])


def leaf_of(tree: Tree, bins: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
    """The leaf of every column of ``bins`` (features, rows)."""
    node = np.zeros(bins.shape[1], np.int32) if node is None else node.copy()
    rows = np.flatnonzero(tree.left[node] >= 0)
    while len(rows):
        at = node[rows]
        goes_left = bins[tree.feature[at], rows] <= tree.bin[at]
        node[rows] = np.where(goes_left, tree.left[at], tree.right[at])
        rows = rows[tree.left[node[rows]] >= 0]
    return node


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(3, rows): gradient and curvature of the log loss in whole steps, and ones."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.stack([np.rint((p - label) * weight * STEP), np.rint(p * (1 - p) * weight * STEP), np.ones(len(p))])


def histogram(places: np.ndarray, slot: np.ndarray, stats: np.ndarray, slots: int, width: int) -> np.ndarray:
    """(slots, 3, width): sums of ``stats`` by slot and place; ``places`` is (features, rows)."""
    out = np.zeros((3, slots * width))
    for low in range(0, places.shape[1], BLOCK):
        at = slice(low, low + BLOCK)
        key = places[:, at] + slot[at] * width
        shape, key = key.shape, key.ravel()
        for i, s in enumerate(stats[:2]):
            out[i] += np.bincount(key, np.broadcast_to(s[at], shape).ravel(), slots * width)
        out[2] += np.bincount(key, minlength=slots * width)
    return out.reshape(3, slots, width).transpose(1, 0, 2)


class Unusual(NamedTuple):
    """Places of the bins other than their feature's usual one, (most of a row, rows), filled up
    with the place after the last; and the usual bin of every feature."""

    places: np.ndarray
    usual: np.ndarray


def unusual(bins: np.ndarray, starts: np.ndarray) -> Unusual:
    """What ``leaf_sums`` reads of ``bins`` (features, rows)."""
    usual = np.array([np.bincount(b, minlength=1).argmax() for b in bins], np.int64)
    most = max((np.count_nonzero(bins != usual[:, None], axis=0).max(initial=0)), 1)
    places = np.full((most, bins.shape[1]), starts[-1], np.int32)
    for low in range(0, bins.shape[1], BLOCK):
        part = bins[:, low : low + BLOCK]
        row, feature = np.nonzero((part != usual[:, None]).T)
        turn = np.arange(len(row)) - np.searchsorted(row, row)
        places[turn, low + row] = starts[feature] + part[feature, row]
    return Unusual(places, usual)


def leaf_sums(own: Unusual, starts: np.ndarray, rows: np.ndarray | slice, slot: np.ndarray, stats: np.ndarray, slots: int) -> np.ndarray:
    """``histogram`` of all bins for some ``rows``; ``slot`` and ``stats`` are those of these rows."""
    found = histogram(own.places[:, rows], slot, stats, slots, int(starts[-1]) + 1)[:, :, :-1].copy()
    whole = np.stack([np.bincount(slot, s, slots) for s in stats], axis=1)
    rest = whole[:, :, None] - np.add.reduceat(found, starts[:-1], axis=2)
    found[:, :, starts[:-1] + own.usual] += rest
    return found


def class_weights(label: np.ndarray, weight: np.ndarray) -> tuple[int, int]:
    """Weight of the positives and of the negatives, in whole steps."""
    steps = np.rint(weight * STEP)
    return int(steps[label == 1].sum()), int(steps[label != 1].sum())


def log_odds(positive: int, negative: int) -> float:
    return float(np.log(positive / negative)) if positive > 0 and negative > 0 else 0.0


class Turns(NamedTuple):
    """``Unusual`` of rows with ever fewer unusual bins: line ``t`` of the places has one in its
    first ``ends[t]`` rows alone, so nothing that fills up is read. A row's places stand together, in
    ``lines`` (rows, most of a row)."""

    lines: np.ndarray
    usual: np.ndarray
    ends: list[int]


def turns(bins: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, Turns]:
    """An order of the columns of ``bins``, and their places in that order."""
    usual = np.array([np.bincount(b, minlength=1).argmax() for b in bins], np.int64)
    count = np.count_nonzero(bins != usual[:, None], axis=0)
    order = np.argsort(-count, kind="stable")
    own = unusual(bins[:, order], starts)
    lines = np.ascontiguousarray(own.places.T, np.uint16 if starts[-1] < 1 << 16 else np.int32)
    return order, Turns(lines, usual, [int((count > t).sum()) for t in range(lines.shape[1])])


def sums_of_leaves(of: Turns, starts: np.ndarray, leaves: Sequence[np.ndarray], stats: np.ndarray) -> list[np.ndarray]:
    """``leaf_sums`` of leaves that have these rows, in rising order; ``stats`` are those of all
    rows. Leaves of few rows are summed together."""
    few = [i for i, rows in enumerate(leaves) if len(rows) < FEW]
    found = [None if i in few else _sums_by_line(of, starts, rows, stats) for i, rows in enumerate(leaves)]
    if few:
        rows = np.concatenate([leaves[i] for i in few])
        slot = np.repeat(np.arange(len(few)), [len(leaves[i]) for i in few])
        own = Unusual(of.lines[rows].T, of.usual)
        for i, sums in zip(few, leaf_sums(own, starts, slice(None), slot, stats[:, rows], len(few)), strict=True):
            found[i] = sums
    return found


def _sums_by_line(of: Turns, starts: np.ndarray, rows: np.ndarray, stats: np.ndarray) -> np.ndarray:
    width = int(starts[-1])
    out, total = np.zeros((3, width)), np.zeros(3)
    for low in range(0, len(rows), BLOCK):
        some = rows[low : low + BLOCK]
        # Rows without a gap are read where they stand.
        unbroken = some[-1] - some[0] == len(some) - 1
        at = slice(some[0], some[-1] + 1) if unbroken else some
        lines, gradient, curvature = of.lines[at], stats[0][at], stats[1][at]
        total += gradient.sum(), curvature.sum(), len(some)
        for t, end in enumerate(of.ends):
            n = int(np.searchsorted(some, end))
            if not n:
                break
            key = lines[:n, t].astype(np.intp)
            out[0] += np.bincount(key, gradient[:n], width)
            out[1] += np.bincount(key, curvature[:n], width)
            out[2] += np.bincount(key, minlength=width)
    out[:, starts[:-1] + of.usual] += total[:, None] - np.add.reduceat(out, starts[:-1], axis=1)
    return out


def train_alone(
    bins: np.ndarray, label: np.ndarray, weight: np.ndarray, spec: Spec, starts: np.ndarray,
    base: float, min_rows: int = MIN_ROWS,
) -> list[Tree]:
    """All trees of one model over rows that are in memory. Every leaf has its rows, so that a
    split reads the rows of its own leaf only."""
    order, own = turns(bins, starts)
    bins, label, weight = bins[:, order], label[order], weight[order]
    margin, trees = np.full(len(label), base), []
    for _ in range(spec.trees):
        stats, growth = gradients(margin, label, weight), Growth(spec, min_rows)
        held = {0: np.arange(len(label))}
        known = {0: sums_of_leaves(own, starts, [held[0]], stats)[0]}
        while growth.open or growth.waiting:
            cuts = best_cuts(np.stack([known[n] for n in growth.open]), starts, min_rows) if growth.open else None
            split = growth.advance(cuts)
            if not split:
                break
            for node in split:
                feature, cut, a, b = growth.nodes[node]
                rows = held.pop(node)
                goes_left = bins[feature].take(rows) <= cut
                held[a], held[b] = rows[goes_left], rows[~goes_left]
            small = growth.smaller(split)
            if small:
                growth.learn(known, small, sums_of_leaves(own, starts, [held[n] for n in small], stats))
        tree = growth.tree()
        trees.append(tree)
        for leaf, rows in held.items():
            margin[rows] += tree.value[leaf]
    return trees


# Binning and blocks


def find_bins(table: DataFrame, size: int, most: int = BINS) -> Bins:
    """Cuts at approximate quantiles of every feature, from one aggregate; a feature of few
    values is cut between all of them. One short list per feature reaches the driver."""
    shares = [i / most for i in range(1, most)]
    rows = table.select(F.posexplode(vector_to_array("features")).alias("feature", "x"))
    found = rows.groupBy("feature").agg(
        F.percentile_approx("x", shares, 20 * most).alias("inner"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    cuts = [np.zeros(0)] * size
    for r in found.collect():
        values = np.unique(np.array([r["low"], *r["inner"]]))
        cuts[r["feature"]] = values[values < r["high"]][: most - 1]
    return Bins(cuts)


_BLOCK = "n int, bins binary, label binary, weight binary, fold binary"


def _to_blocks(bins: Bins, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def block(parts: list) -> pa.RecordBatch:
            codes, label, weight, fold = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
            values = [len(label), codes.tobytes(), label.tobytes(), weight.tobytes(), fold.tobytes()]
            names = ("n", "bins", "label", "weight", "fold")
            types = (pa.int32(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names
            )

        count = 0
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            codes = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(bins.cuts)]).astype(np.uint8)
            own = [codes, *[batch[c].to_numpy(zero_copy_only=False).astype(t) for c, t in (("label", float), ("weight", float), ("fold", np.int32))]]
            while own[1].size:
                room = rows - count
                held.append([a[..., :room] for a in own])
                own = [a[..., room:] for a in own]
                count += held[-1][1].size
                if count == rows:
                    yield block(held)
                    held, count = [], 0
        if held:
            yield block(held)

    return run


def blocks(table: DataFrame, bins: Bins, rows: int = BLOCK) -> DataFrame:
    """(n, bins, label, weight, fold): rows of (label, features, weight, fold) in blocks. A small
    table is dealt out, so that all slots share the passes."""
    slots = table.sparkSession.sparkContext.defaultParallelism
    spread = table if table.rdd.getNumPartitions() >= slots else table.repartition(slots)
    x = spread.select(
        vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"),
        F.col("weight").cast("double").alias("weight"), F.col("fold").cast("int").alias("fold"),
    )
    return written(x.mapInArrow(_to_blocks(bins, rows), _BLOCK), "blocks")


def opened(block, features: int):
    """(bins, label, weight, fold) of a block."""
    return (
        np.frombuffer(block["bins"], np.uint8).reshape(features, -1),
        np.frombuffer(block["label"]),
        np.frombuffer(block["weight"]),
        np.frombuffer(block["fold"], np.int32),
    )


# One task per model

_TREE = "model int, tree int, " + ", ".join(
    f"{c} array<{t}>" for c, t in zip(Tree._fields, ("int", "int", "int", "int", "double", "double", "double"), strict=True)
)


def _tree_rows(model: int, trees: Sequence[Tree]) -> pd.DataFrame:
    rows = [(model, i, *[x.tolist() for x in t]) for i, t in enumerate(trees)]
    return pd.DataFrame(rows, columns=["model", "tree", *Tree._fields])


def _train_apart(
    stored: DataFrame, specs: Sequence[Spec], starts: np.ndarray, bases, min_rows: int, tasks: int
) -> list[list[Tree]]:
    specs, width = list(specs), len(starts) - 1

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        spec = specs[key[0]]
        parts = [opened(r, width) for r in rows.to_dict("records")]
        bins, label, weight, fold = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
        seen = fold != spec.fold
        trees = train_alone(
            bins[:, seen], label[seen], weight[seen], spec, starts, bases[key[0]], min_rows
        )
        return _tree_rows(key[0], trees)

    models = F.explode(F.sequence(F.lit(0), F.lit(len(specs) - 1))).alias("model")
    copies = stored.select("*", models).repartitionByRange(min(tasks, len(specs)), "model")
    found: list[list[Tree]] = [[] for _ in specs]
    for r in copies.groupBy("model").applyInPandas(run, _TREE).orderBy("model", "tree").toLocalIterator():
        types = (*[np.int32] * 4, *[float] * 3)
        found[r["model"]].append(Tree(*[np.array(r[c], t) for c, t in zip(Tree._fields, types, strict=True)]))
    return found


# Passes over blocks


def _with_margins(specs, bases, width: int, trees: list[list[Tree]]):
    """Blocks with the margins of all models after ``trees`` more trees each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                r["margins"] = _margins(r, specs, bases, width, trees).tobytes()
                yield pa.RecordBatch.from_pylist([r], _margin_schema())

    return run


def _margin_schema() -> pa.Schema:
    kinds = [("n", pa.int32())] + [(c, pa.binary()) for c in ("bins", "label", "weight", "fold", "margins")]
    return pa.schema(kinds)


def _margins(r, specs, bases, width: int, trees: list[list[Tree]]) -> np.ndarray:
    bins = np.frombuffer(r["bins"], np.uint8).reshape(width, -1)
    if r.get("margins"):
        out = np.frombuffer(r["margins"]).reshape(len(specs), -1).copy()
    else:
        out = np.repeat(np.array(bases)[:, None], r["n"], axis=1)
    for m, grown in enumerate(trees):
        for tree in grown:
            out[m] += tree.value[leaf_of(tree, bins)]
    return out


def _read(specs, bases, starts: np.ndarray):
    """A stored block as (bins, places, label, weight, fold, margins)."""
    width = len(starts) - 1

    def run(row):
        r = row.asDict()
        margins = _margins(r, specs, bases, width, [])
        bins, label, weight, fold = opened(r, width)
        return bins, unusual(bins, starts), label, weight, fold, margins

    return run


def _grown(trees: Sequence[Tree | None]):
    """A block with the margins after one more tree of every model."""

    def run(block):
        bins, *others, margins = block
        more = [0.0 if t is None else t.value[leaf_of(t, bins)] for t in trees]
        return bins, *others, np.stack([m + x for m, x in zip(margins, more, strict=True)])

    return run


def _sum_blocks(specs, starts: np.ndarray, growing: dict[int, tuple[Tree, list[int]]]):
    """Per partition: ((model, leaf), histogram) of every open leaf of the growing trees."""

    def run(blocks):
        total: dict[int, np.ndarray] = {}
        for bins, places, label, weight, fold, margins in blocks:
            for m, (tree, wanted) in growing.items():
                slot = np.full(len(tree.left), -1)
                slot[wanted] = np.arange(len(wanted))
                own = slot[leaf_of(tree, bins)]
                rows = np.flatnonzero((own >= 0) & (fold != specs[m].fold))
                stats = gradients(margins[m][rows], label[rows], weight[rows])
                found = leaf_sums(places, starts, rows, own[rows], stats, len(wanted)).astype(np.int64)
                total[m] = total[m] + found if m in total else found
        for m, sums in total.items():
            for leaf, own in zip(growing[m][1], sums, strict=True):
                yield (m, leaf), own

    return run


def _sums_of(state: RDD, specs, starts, growing) -> dict[int, list[np.ndarray]]:
    """One pass: the histogram of every wanted leaf of every growing tree. Their number is the
    trees', not the rows'."""
    leaves = sum(len(wanted) for _, wanted in growing.values())
    sums = state.mapPartitions(_sum_blocks(specs, starts, growing))
    parts = state.getNumPartitions()
    if parts * leaves * int(starts[-1]) * 24 <= MERGE_BYTES:
        found: dict = {}
        for key, own in sums.collect():
            found[key] = found[key] + own if key in found else own
    else:
        found = sums.reduceByKey(np.add, min(leaves, parts)).collectAsMap()
    # A model that sees no row has no sums.
    none = np.zeros((3, int(starts[-1])), np.int64)
    return {m: [found.get((m, leaf), none).astype(float) for leaf in wanted] for m, (_, wanted) in growing.items()}


def _train_in_passes(stored: DataFrame, specs: Sequence[Spec], starts: np.ndarray, bases, min_rows: int) -> list[list[Tree]]:
    specs, width = list(specs), len(starts) - 1
    found: list[list[Tree]] = [[] for _ in specs]
    state, schema, since = stored, f"{_BLOCK}, margins binary", 0

    def read(table: DataFrame) -> RDD:
        return table.rdd.map(_read(specs, bases, starts)).persist(StorageLevel.MEMORY_AND_DISK)

    held, spent = read(stored), []
    for t in range(max(s.trees for s in specs)):
        if t - since == KEEP:
            # The margins so far are stored, so a lost block never repeats more than a few trees.
            fresh = written(
                state.mapInArrow(_with_margins(specs, bases, width, [f[since:] for f in found]), schema), "margins"
            )
            for rows in (held, *spent):
                rows.unpersist()
            if state is not stored:
                release(state)
            state, since, held, spent = fresh, t, read(fresh), []
        growths = {m: Growth(s, min_rows) for m, s in enumerate(specs) if t < s.trees}
        known: dict[int, dict[int, np.ndarray]] = {m: {} for m in growths}
        growing = {m: (_unfinished(g), [0]) for m, g in growths.items()}
        small: dict[int, dict[int, int]] = {}
        while growing:
            sums = _sums_of(held, specs, starts, growing)
            while spent:
                spent.pop().unpersist()
            for m in list(growing):
                g = growths[m]
                if m in small:
                    g.learn(known[m], small[m], sums[m])
                else:
                    known[m][0] = sums[m][0]
                small[m] = {}
                while (g.open or g.waiting) and not small[m]:
                    cuts = best_cuts(np.stack([known[m][n] for n in g.open]), starts, min_rows) if g.open else None
                    split = g.advance(cuts)
                    small[m] = g.smaller(split)
                    if not split:
                        break
            growing = {m: (_unfinished(growths[m]), list(small[m])) for m in growing if small[m]}
        for m, g in growths.items():
            found[m].append(g.tree())
        spent.append(held)
        last = [found[m][t] if m in growths else None for m in range(len(specs))]
        held = held.map(_grown(last)).persist(StorageLevel.MEMORY_AND_DISK)
    for rows in (held, *spent):
        rows.unpersist()
    if state is not stored:
        release(state)
    return found


def _unfinished(g: Growth) -> Tree:
    """The shape of a tree that still grows."""
    shape = [np.array(x, np.int32) for x in zip(*g.nodes, strict=True)]
    none = np.zeros(len(g.nodes))
    return Tree(*shape, none, none, none)


def train(
    stored: DataFrame, specs: Sequence[Spec], bins: Bins, min_rows: int = MIN_ROWS,
    task_bytes: int = TASK_BYTES, tasks: int = 32,
) -> list[tuple[float, list[Tree]]]:
    """(start margin, trees) of every model over the stored ``blocks``."""
    starts, width = bins.starts, len(bins.cuts)

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                _, label, weight, fold = opened(r, width)
                rows = [(int(f), int((fold == f).sum()), *class_weights(label[fold == f], weight[fold == f])) for f in np.unique(fold)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.int64()] * 3), strict=True)],
                    names=["fold", "n", "pos", "neg"],
                )

    sums = stored.mapInArrow(weights, "fold int, n long, pos long, neg long")
    by_fold = sums.groupBy("fold").agg(*[F.sum(c).alias(c) for c in ("n", "pos", "neg")]).collect()
    n = sum(r["n"] for r in by_fold)
    if not n:
        return [(0.0, []) for _ in specs]
    bases = [
        log_odds(*[sum(r[c] for r in by_fold if r["fold"] != s.fold) for c in ("pos", "neg")]) for s in specs
    ]
    slots = stored.sparkSession.sparkContext.defaultParallelism
    if n * width <= (task_bytes if len(specs) >= slots else task_bytes // 4):
        found = _train_apart(stored, specs, starts, bases, min_rows, tasks)
    else:
        found = _train_in_passes(stored, specs, starts, bases, min_rows)
    return list(zip(bases, found, strict=True))


def held_out_margins(stored: DataFrame, specs: Sequence[Spec], trained, bins: Bins, stops: Sequence[int]) -> DataFrame:
    """(model, trees, label, margin) of the rows that a model didn't see, after its first
    ``stops`` trees each."""
    width, specs = len(bins.cuts), list(specs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                codes, label, _, fold = opened(r, width)
                for m, spec in enumerate(specs):
                    rows = np.flatnonzero(fold == spec.fold)
                    base, trees = trained[m]
                    own, margin, done = codes[:, rows], np.full(len(rows), base), 0
                    for stop in stops:
                        for tree in trees[done:stop]:
                            margin = margin + tree.value[leaf_of(tree, own)]
                        done = stop
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), m, np.int32)), pa.array(np.full(len(rows), stop, np.int32)),
                             pa.array(label[rows]), pa.array(margin)], names=["model", "trees", "label", "margin"],
                        )

    return stored.mapInArrow(run, "model int, trees int, label double, margin double")
