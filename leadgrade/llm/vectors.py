"""Vectors as rows of whole numbers, and blocks of them with a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Whole components stop here, so that sums of products of 64 of them, times 100, fit a long.
LIMIT = 1 << 25


def whole(vectors: DataFrame, scale: float, keep: tuple[str, ...], column: str = "embedding") -> DataFrame:
    """``keep``, dim, v: floor(scale * x) of every component x, in double.

    Rows with a null or empty vector, or a null or non-finite component, are left out.
    Components beyond ``LIMIT`` in size stop there.
    """
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    far = F.lit(float(LIMIT))
    values = F.transform(
        column,
        lambda x: F.floor(F.greatest(F.least(F.lit(scale) * x.cast("double"), far), -far)).cast("int"),
    )
    rows = vectors.where(F.col(column).isNotNull() & (F.size(column) > 0)).where(good)
    return rows.select(*keep, F.size(column).alias("dim"), values.alias("v"))


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    """A list column whose rows have one length, as whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(rows, -1) if rows else np.zeros((0, 0), np.int64)


def narrow(values: np.ndarray) -> np.ndarray:
    """``values`` in the smallest whole numbers that hold them all."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    return values.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def below(floor: np.ndarray, kind: np.dtype) -> np.ndarray:
    """``floor`` as ``kind``, rounded down."""
    if kind.kind != "f":
        return floor
    found = floor.astype(kind)
    return np.where(found > floor, np.nextafter(found, kind.type(-np.inf)), found)


class Best:
    """The k best (score, id) of every query of a block so far, in a row each, and how many."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.held = np.zeros((queries, 2, k), np.int64)
        self.count = np.zeros(queries, np.int64)
        self.floor = np.full(queries, -np.inf)

    @property
    def scores(self) -> list[np.ndarray]:
        return [x[0, :n] for x, n in zip(self.held, self.count.tolist(), strict=True)]

    @property
    def ids(self) -> list[np.ndarray]:
        return [x[1, :n] for x, n in zip(self.held, self.count.tolist(), strict=True)]

    def add(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Put (score, id) into the best of ``who``: the number of a query for each."""
        if not len(who):
            return
        if (who[1:] < who[:-1]).any():
            turn = np.argsort(who, kind="stable")
            who, scores, ids = who[turn], scores[turn], ids[turn]
        new, first, n = np.unique(who, return_index=True, return_counts=True)
        if n.max() > 4 * self.k:
            keep = np.ones(len(who), bool)
            for a, m in zip(first[n > 4 * self.k].tolist(), n[n > 4 * self.k].tolist(), strict=True):
                line = scores[a : a + m]
                keep[a : a + m] = line >= np.partition(line, m - self.k)[m - self.k]
            who, scores, ids = who[keep], scores[keep], ids[keep]
            new, first, n = np.unique(who, return_index=True, return_counts=True)
        shape = (len(new), self.k + int(n.max()))
        row = np.repeat(np.arange(len(new)), n)
        place = self.k + np.arange(len(who)) - np.repeat(first, n)
        both, none = np.zeros((2, *shape), np.int64), np.ones(shape, bool)
        both[:, :, : self.k] = self.held[new].transpose(1, 0, 2)
        none[:, : self.k] = np.arange(self.k) >= self.count[new, None]
        both[0, row, place], both[1, row, place], none[row, place] = scores, ids, False
        order = np.lexsort((both[1], ~both[0], none), axis=-1)[:, : self.k]
        self.held[new] = np.take_along_axis(both, order[None], axis=2).transpose(1, 0, 2)
        self.count[new] = np.minimum(self.count[new] + n, self.k)
        full = new[self.count[new] == self.k]
        self.floor[full] = self.held[full, 0, -1]


def blocks(most_rows: int, most_bytes: int, extra=None):
    """``mapInArrow`` function: (vec_id, label, dim, v) to blocks (dim, ids, labels, vs).

    A block holds vectors of one length, at most ``most_rows`` of them and ``most_bytes``
    of components (but one vector at least). ``extra`` gives further columns of a block
    from its vectors.
    """

    def block(dim: int, parts: list) -> pa.RecordBatch:
        ids, labels, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        found = {"ids": ids.astype(np.int64), "labels": labels.astype(np.int64), "vs": narrow(v)}
        found |= extra(v) if extra else {}
        return pa.RecordBatch.from_pydict(
            {"dim": pa.array([dim], pa.int32())}
            | {name: pa.array([x.tobytes()], pa.binary()) for name, x in found.items()}
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        count: dict[int, int] = {}
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in map(int, np.unique(dims)):
                limit = min(most_rows, max(1, most_bytes // (8 * dim)))
                at = pa.array(np.flatnonzero(dims == dim))
                rows = [
                    batch["vec_id"].take(at).to_numpy(),
                    batch["label"].take(at).to_numpy(),
                    matrix(batch["v"].take(at), len(at)),
                ]
                while len(rows[0]):
                    room = limit - count.get(dim, 0)
                    held.setdefault(dim, []).append([x[:room] for x in rows])
                    count[dim] = count.get(dim, 0) + min(room, len(rows[0]))
                    rows = [x[room:] for x in rows]
                    if count[dim] == limit:
                        yield block(dim, held.pop(dim))
                        count[dim] = 0
        for dim, parts in held.items():
            yield block(dim, parts)

    return run


def opened(block, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, vectors) of a block's binary columns."""
    ids, labels, vs = block
    own = np.frombuffer(ids, np.int64)
    vectors = np.frombuffer(vs, f"i{len(vs) // (dim * len(own))}").reshape(-1, dim)
    return own, np.frombuffer(labels, np.int64), vectors.astype(np.int64)
