"""Hard negatives of anchor vectors, with score bounds along a spanning tree of anchors.

Two anchors a and b score a candidate x within |a - b| * |x| of each other. A block of
anchors is joined by a minimum spanning tree; the root scores all candidates, every other
anchor bounds its scores from its parent's, and rescores exactly only the candidates whose
bounds reach into the window that it looks for. Rescored candidates have exact bounds for
the anchors below. Where the bounds turn out to leave most of what the first anchors
look at, the other anchors of a pair of blocks are scored in one matrix product, with those
candidates alone whose label they look for. Blocks of anchors meet blocks of candidates, each pair once for the
positives and once for the negatives, whose windows follow from the positives' scores. A task
keeps the best of a block of anchors over all blocks of candidates that it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadgrade.llm.vectors import Best, below, blocks, opened, whole
from leadgrade.plans.sizing import release, written

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 3
#: A negative scores between so many percent of its positive's score.
LOW, HIGH = 50, 95
ANCHORS, CANDIDATES, BYTES = 512, 4096, 2 << 20
#: Blocks of candidates in one group, on average, once there are more groups than these.
STRIPE, STRIPES = 64, 64
#: After so many anchors of a pair of blocks all others are scored whole, if more than this part of
#: the wanted candidates had to be; and so many of them at once.
TRIED, PART, CHUNK = 8, 0.5, 128
#: Blocks of anchors whose best a task holds at a time.
HELD = 256

RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)
_EXACT, _EXACT_SINGLE = float(1 << 53), float(1 << 24)


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): Prim's minimum spanning tree over the rows of ``v``.

    ``order`` names the rows parents first; the root is its own parent with edge 0. The
    root is the row nearest to the mean.
    """
    x = v.astype(float)
    n = len(x)
    size = (x * x).sum(axis=1)
    root = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    parent, near = np.full(n, root), np.full(n, np.inf)
    order, edge, left = [root], np.zeros(n), np.ones(n, bool)
    left[root], last = False, root
    for _ in range(n - 1):
        gap = size + size[last] - 2 * (x @ x[last])
        closer = left & (gap < near)
        near[closer], parent[closer] = gap[closer], last
        last = int(np.where(left, near, np.inf).argmin())
        left[last] = False
        order.append(last)
    parent = parent.astype(np.int64)
    edge = np.sqrt(((x - x[parent]) ** 2).sum(axis=1))
    return np.array(order, np.int64), parent, edge


def _with_tree(v: np.ndarray) -> dict[str, np.ndarray]:
    order, parent, edge = spanning_tree(v)
    return {"path": order, "parent": parent, "edge": edge}


class Bounds:
    """Scores of a block of candidates under a block of anchors, between bounds.

    ``rescored`` counts the exact products, ``asked`` the candidates that anchors looked at.
    """

    def __init__(self, anchors: np.ndarray, tree, candidates: np.ndarray):
        self.order, self.parent, self.edge = tree
        most = float(np.abs(anchors).max(initial=0)) * float(np.abs(candidates).max(initial=0))
        self.norm = np.sqrt((candidates.astype(float) ** 2).sum(axis=1))
        self.length = np.sqrt((anchors.astype(float) ** 2).sum(axis=1))
        # No part of a sum is larger than the norms' product.
        single = self.norm.max(initial=0) * self.length.max(initial=0) < 0.99 * _EXACT_SINGLE
        self.exact = np.float32 if single else np.int64 if most * anchors.shape[1] >= _EXACT else np.float64
        self.a, self.c = anchors.astype(self.exact), candidates.astype(self.exact)
        shape = (len(anchors), len(candidates))
        self.low, self.high = np.empty(shape), np.empty(shape)
        self.rescored = self.asked = self.tried = 0

    def dense(self) -> bool:
        """Whether bounds have spared too little so far."""
        return self.exact != np.int64 and self.tried >= TRIED and self.rescored > PART * self.asked

    def whole(self, own, other, left: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchors, candidates, scores) of the anchors ``left``, a few of one label at a time, with
        all candidates of their label or of the others."""
        for label in np.unique(own[1][left]):
            at = np.flatnonzero((other[1] == label) == same)
            rows, c = left[own[1][left] == label], self.c[at]
            for x in range(0, len(rows) if len(at) else 0, CHUNK):
                some = rows[x : x + CHUNK]
                self.rescored += len(some) * len(at)
                yield some, at, self.a[some] @ c.T

    def scores(self, i: int, at: np.ndarray) -> np.ndarray:
        """Exact scores of candidates ``at`` under anchor ``i``, which tighten the bounds."""
        found = ((self.c if len(at) == len(self.c) else self.c[at]) @ self.a[i]).astype(np.int64)
        self.low[i, at] = self.high[i, at] = found
        self.rescored += len(at)
        return found

    def reached(self) -> Iterator[int]:
        """Anchors in tree order, each with bounds from its parent's. The rounding of the
        edge and of large scores is covered by a small share of the norms."""
        for i in self.order:
            p = self.parent[i]
            if i == p:
                self.scores(i, np.arange(len(self.c)))
            else:
                slack = (self.edge[i] * (1 + 1e-9) + 1e-12 * self.length[p]) * self.norm
                self.low[i], self.high[i] = self.low[p] - slack, self.high[p] + slack
            yield i


def _largest(x: np.ndarray, k: int) -> float:
    """The ``k``-th largest, or minus infinity if there are fewer."""
    return np.partition(x, len(x) - k)[len(x) - k] if len(x) >= k else -np.inf


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best, equal scores by smaller id."""
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= _largest(scores, k))
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def block_positives(bounds: Bounds, own, other, k: int, floor: np.ndarray | None = None):
    """(anchor, candidate, score): the ``k`` best of the same label, of every anchor; from a matrix
    product all that are not below the anchor's ``floor``, and an anchor for each."""
    floor = np.full(len(own[0]), -np.inf) if floor is None else floor
    for n, i in enumerate(bounds.reached()):
        if bounds.dense():
            for rows, cols, scores in bounds.whole(own, other, bounds.order[n:], True):
                least = below(floor[rows], scores.dtype)
                row, col = np.divmod(np.flatnonzero((scores >= least[:, None]).ravel()), len(cols))
                keep = other[0][cols[col]] != own[0][rows[row]]
                row, col = row[keep], col[keep]
                yield rows[row], cols[col], scores[row, col].astype(np.int64)
            return
        wanted = np.flatnonzero((other[1] == own[1][i]) & (other[0] != own[0][i]))
        least = max(_largest(bounds.low[i, wanted], k), floor[i])
        at = wanted[bounds.high[i, wanted] >= least]
        bounds.tried, bounds.asked = bounds.tried + 1, bounds.asked + len(wanted)
        scores = bounds.scores(i, at)
        best = _first(scores, other[0][at], k)
        yield i, at[best], scores[best]


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative, in whole numbers."""
    return -((-LOW * positive) // 100), (HIGH * positive) // 100


def block_negatives(bounds: Bounds, own, other, positives, k: int, floor: np.ndarray | None = None):
    """(anchor, number of the positive, candidate, score): the ``k`` best of another label
    within every positive's window; from a matrix product all within it that are not below ``floor``, and
    an anchor and number for each. ``positives``: scores per anchor; ``floor``: (anchors, positives)."""
    most = max(map(len, positives), default=0)
    floor = np.full((len(own[0]), most), -np.inf) if floor is None else floor
    for n, i in enumerate(bounds.reached()):
        if bounds.dense():
            yield from _dense_negatives(bounds, own, other, positives, floor, bounds.order[n:])
            return
        if not len(positives[i]):
            continue
        low, high = window(positives[i])
        wanted = np.flatnonzero(other[1] != own[1][i])
        wanted = wanted[other[0][wanted] != own[0][i]]
        under, above = bounds.low[i, wanted], bounds.high[i, wanted]
        need = np.zeros(len(wanted), bool)
        for a, b, f in {(int(a), int(b), float(f)) for a, b, f in zip(low, high, floor[i], strict=False) if a <= b}:
            # Candidates surely inside set a floor that the k-th best can't be below.
            least = max(_largest(under[(under >= a) & (above <= b)], k), f)
            need |= (above >= max(a, least)) & (under <= b)
        at = wanted[need]
        bounds.tried, bounds.asked = bounds.tried + 1, bounds.asked + len(wanted)
        scores = bounds.scores(i, at)
        for j, (a, b) in enumerate(zip(low, high, strict=True)):
            inside = np.flatnonzero((scores >= a) & (scores <= b))
            best = inside[_first(scores[inside], other[0][at[inside]], k)]
            yield i, j, at[best], scores[best]


def _dense_negatives(bounds: Bounds, own, other, positives, floor: np.ndarray, left: np.ndarray):
    """What lies in the windows of the anchors ``left``, from whole products."""
    # An absent positive has an empty window.
    low, high = np.ones(floor.shape, np.int64), np.zeros(floor.shape, np.int64)
    for i in left:
        low[i, : len(positives[i])], high[i, : len(positives[i])] = window(positives[i])
    least = np.where(low <= high, np.maximum(low, floor), np.inf)
    for rows, cols, scores in bounds.whole(own, other, left, False):
        first = below(least[rows].min(axis=1, initial=np.inf), scores.dtype)[:, None]
        last = -below(-high[rows].max(axis=1, initial=0).astype(float), scores.dtype)[:, None]
        row, col = np.divmod(np.flatnonzero(((scores >= first) & (scores <= last)).ravel()), len(cols))
        keep = other[0][cols[col]] != own[0][rows[row]]
        row, col = row[keep], col[keep]
        found = scores[row, col].astype(np.int64)
        at, j = np.nonzero((found[:, None] >= least[rows][row]) & (found[:, None] <= high[rows][row]))
        yield rows[row[at]], j, cols[col[at]], found[at]


_TREE = ("a_ids", "a_labels", "a_vs")


def _opened_pairs(batches: Iterator[pa.RecordBatch]):
    last = None
    for batch in batches:
        for n in range(batch.num_rows):
            r = {name: column[n].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True) if name not in _TREE}
            if r["ablock"] != last:
                own = opened([batch[x][n].as_py() for x in _TREE], r["dim"])
                tree = [np.frombuffer(r["path"], np.int64), np.frombuffer(r["parent"], np.int64), np.frombuffer(r["edge"])]
                last = r["ablock"]
            other = opened([r[x] for x in ("ids", "labels", "vs")], r["dim"])
            yield r, own, other, Bounds(own[2], tree, other[2])


def _met(ablock: int, best: Best, names: tuple[str, ...], per: int = 1) -> pa.RecordBatch:
    """The best of a block of anchors, ``per`` numbers an anchor."""
    at = np.repeat(np.arange(len(best.count)), best.count)
    place = (at // per, at % per + 1) if per > 1 else (at,)
    found = np.concatenate([*best.ids, *best.scores]).reshape(2, -1)
    columns = [np.full(len(at), ablock, np.int64), *place, *found]
    return pa.RecordBatch.from_pydict(dict(zip(("ablock", *names), map(pa.array, columns), strict=True)))


def _put(best: Best, parts: list) -> None:
    """Parts (number, id, score) into ``best``; a part has one number or one for each id."""
    if parts:
        who = np.concatenate([np.broadcast_to(i, len(ids)) for i, ids, _ in parts])
        best.add(who, *[np.concatenate(x) for x in list(zip(*parts, strict=True))[:0:-1]])


def _find_positives(k: int):
    names = ("anchor", "vec_id", "score")

    def run(batches):
        held: dict[int, Best] = {}
        for r, own, other, bounds in _opened_pairs(batches):
            if r["ablock"] not in held:
                if len(held) == HELD:
                    first = next(iter(held))
                    yield _met(first, held.pop(first), names)
                held[r["ablock"]] = Best(len(own[0]), k)
            best = held[r["ablock"]]
            found = block_positives(bounds, own, other, k, best.floor)
            _put(best, [(i, other[0][at], scores) for i, at, scores in found])
        for ablock, best in held.items():
            yield _met(ablock, best, names)

    return run


def _find_negatives(k: int, most: int):
    names = ("anchor", "place", "vec_id", "score")

    def run(batches):
        held: dict[int, tuple[Best, list]] = {}
        for r, own, other, bounds in _opened_pairs(batches):
            if r["ablock"] not in held:
                if len(held) == HELD:
                    first = next(iter(held))
                    yield _met(first, held.pop(first)[0], names, most)
                positives = [[] for _ in own[0]]
                for p in r["positives"]:
                    positives[p["anchor"]].append(p["score"])
                positives = [np.array(p, np.int64) for p in positives]
                held[r["ablock"]] = Best(most * len(own[0]), k), positives
            best, positives = held[r["ablock"]]
            found = block_negatives(bounds, own, other, positives, k, best.floor.reshape(-1, most))
            _put(best, [(i * most + j, other[0][at], scores) for i, j, at, scores in found])
        for ablock, (best, _) in held.items():
            yield _met(ablock, best, names, most)

    return run


_BLOCK = "dim int, ids binary, labels binary, vs binary"
_FOUND = "ablock long, anchor long, vec_id long, score long"


def _best(found: DataFrame, group: tuple[str, ...], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    scale: float = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of another label that score between 50 and 95 percent of the positive:
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both tables: vec_id, label, embedding; candidates are ``vectors``. Score: inner product
    of floor(scale * x); higher ones first, equal ones by smaller vec_id. Rows with a null
    id, label or vector, or a null or non-finite component, take no part; components stop
    at 2^25, which keeps all scores exact. Only vectors of one length meet. A row with the
    anchor's own id is neither its positive nor its negative. Equal anchor rows count once,
    equal candidates each; two anchors with one id and different vectors or labels both
    give rows. A positive of negative score has an empty window. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    keep = (F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"))
    known = "vec_id is not null and label is not null"
    c = whole(vectors.where(known), scale, keep)
    a = whole(anchors.where(known), scale, keep).distinct()
    c = c.mapInArrow(blocks(CANDIDATES, BYTES), _BLOCK)
    stored = written(c.withColumn("cblock", F.monotonically_increasing_id()), "candidates")
    # Anchors of one label lie together, so that edges are short.
    a = a.repartitionByRange("dim", "label", "vec_id").sortWithinPartitions("dim", "label", "vec_id")
    tree = f"{_BLOCK}, path binary, parent binary, edge binary"
    a = written(
        a.mapInArrow(blocks(ANCHORS, BYTES, _with_tree), tree).withColumn(
            "ablock", F.monotonically_increasing_id()
        ),
        "anchors",
    )
    n = stored.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    # Groups of candidate blocks: the anchors are copied to each group once.
    groups = min(n, max(STRIPES, n // STRIPE))
    c = stored.withColumn("stripe", F.pmod(F.xxhash64("cblock"), F.lit(groups))).drop("cblock")

    def met(blocks: DataFrame) -> DataFrame:
        own = blocks.withColumnsRenamed(dict(zip(("ids", "labels", "vs"), _TREE, strict=True)))
        own = own.withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        return own.join(c, ["stripe", "dim"])

    found = met(a).mapInArrow(_find_positives(positives), _FOUND)
    best = written(
        _best(found, ("ablock", "anchor"), positives, "place").withColumnRenamed("vec_id", "positive_id"),
        "positives",
    )
    # The scores of a block's positives, in order: a few numbers for each anchor.
    scores = best.groupBy("ablock").agg(
        F.array_sort(F.collect_list(F.struct("anchor", "place", "score"))).alias("positives")
    )
    found = met(a.join(scores, "ablock")).mapInArrow(
        _find_negatives(negatives, positives), "ablock long, anchor long, place long, vec_id long, score long"
    )
    found = _best(found, ("ablock", "anchor", "place"), negatives, "rank")
    names = a.select("ablock", "ids").mapInArrow(_ids, "ablock long, anchor long, anchor_id long")
    result = (
        found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        .join(best.withColumnRenamed("score", "positive_score"), ["ablock", "anchor", "place"])
        .join(names, ["ablock", "anchor"])
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            "negative_id",
            "positive_score",
            "negative_score",
        )
    )
    result = written(result, "negatives")
    release(stored, a, best)
    return result


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ablock, ids in zip(batch["ablock"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            own = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "ablock": pa.array(np.full(len(own), ablock, np.int64)),
                    "anchor": pa.array(np.arange(len(own))),
                    "anchor_id": pa.array(own),
                }
            )
