"""Exact top-k inner products by the threshold algorithm.

Vectors become small integers. Candidates lie in blocks; a block has a list of its
vectors for every dimension, sorted by their value there. A query reads its lists in
rounds from the end that its sign favours, deeper where its weight is larger. Rows that a
list shows for the first time are scored whole (a random access). What no list has shown
can't score above the sum of the query's weights times the next unread values; as soon as
that bound is below the query's k-th best, the rest of the block is left. A few
queries of like direction read the lists together, and many once several such groups
in a row had to be shown nearly the whole block.

Blocks keep their numbers as narrow as they fit. Large blocks of queries meet stripes of
candidate blocks, so that few copies of the candidates are moved and a task holds one stripe.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadgrade.llm.vectors import Best as _Best
from leadgrade.llm.vectors import below, narrow
from leadgrade.plans.sizing import written

SCALE = 64.0
TOP = 20
#: Rows of a block at most, and its bytes at eight a component.
BLOCK, QUERY_BLOCK = 1 << 16, 4096
BYTES = 32 << 20
#: Bytes, as stored, of the candidate blocks that one task goes through for a block of queries;
#: fewer where there would be less than so many tasks a slot.
STRIPE_BYTES, TASKS = 8 << 20, 4
#: Tasks at most; beyond that a task takes several pairs, one after the other.
PARTS = 2000
#: A round reads at least so many entries of the list of the largest weight, then a quarter of
#: those read so far, and at most this part of the list.
STEP, PART = 16, 64
#: Queries that read the lists together; so many after a few groups in a row that were shown
#: more than a part of the block.
TOGETHER, WIDE = 16, 128
ROW, WHOLE = 4, 0.9
_EXACT, _EXACT_SINGLE = float(1 << 53), float(1 << 24)
_LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """(vec_id, dim, values): floor(scale * x) of every component, in double, as long.

    Rows with a null id or vector, or a null or non-finite component, are left out, as are
    empty vectors. Components beyond the range of long stop at its end.
    """
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    values = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return (
        vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0")
        .where(good)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), values.alias("values"))
    )


def _blocked(limit: int):
    """Rows to blocks (dim, ids, values) of at most ``limit`` vectors of one length and ``BYTES``."""

    def block(dim: int, parts: list) -> pa.RecordBatch:
        ids = np.concatenate([p[0] for p in parts])
        values = np.concatenate([p[1] for p in parts])
        return pa.RecordBatch.from_pydict(
            {
                "dim": pa.array([dim], pa.int32()),
                "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                "values": pa.array([narrow(values).tobytes()], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        count: dict[int, int] = {}
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims):
                at = pa.array(np.flatnonzero(dims == dim))
                ids = batch["vec_id"].take(at).to_numpy()
                values = batch["values"].take(at).flatten().to_numpy().reshape(-1, dim)
                most = max(1, min(limit, BYTES // (8 * int(dim))))
                while len(ids):
                    room = most - count.get(dim, 0)
                    held.setdefault(int(dim), []).append((ids[:room], values[:room]))
                    count[dim] = count.get(dim, 0) + min(room, len(ids))
                    ids, values = ids[room:], values[room:]
                    if count[dim] == most:
                        yield block(int(dim), held.pop(int(dim)))
                        count[dim] = 0
        for dim, parts in held.items():
            yield block(dim, parts)

    return run


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Blocks with a number; rows are dealt by a hash of the id, so blocks fill evenly."""
    table = rows.repartition(F.xxhash64("vec_id")).mapInArrow(
        _blocked(size), "dim int, ids binary, values binary"
    )
    return written(table.withColumn(name, F.monotonically_increasing_id()), name)


def _numbered(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks counted from 0; the numbering reads one id of each block."""
    order = Window.orderBy("block")
    numbers = blocks.select("block", (F.row_number().over(order) - 1).alias(name))
    return blocks.join(written(numbers, name), "block").drop("block")


def _matrix(values: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(values, f"i{len(values) // (dim * rows)}").reshape(-1, dim)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; those out of the range of long stop at its end.
    Rows in floating point are known to stay exact, and so do their products."""
    if q.dtype == c.dtype and q.dtype.kind == "f":
        return q @ c.T
    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(c.astype(float)).max(initial=0))
    if most * q.shape[1] < _EXACT:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, -_LONG - 1, _LONG).astype(np.int64)


def _search(q: np.ndarray, own: np.ndarray, c: np.ndarray, ids: np.ndarray, best: _Best) -> np.ndarray:
    """Put the block (c, ids) into the best of the queries (q, own); the sorted and random
    accesses of every query."""
    q = q.astype(np.int64)
    most = max(abs(int(c.max(initial=0))), abs(int(c.min(initial=0))))
    size = np.abs(q.astype(float)).max(initial=0) * float(most) * q.shape[1]
    kind = np.float32 if size < _EXACT_SINGLE else np.float64 if size < _EXACT else np.int64
    slack = 0.0 if size < _EXACT else 1e-9 * size + 0.5
    places = np.stack([np.argsort(np.ascontiguousarray(x), kind="stable").astype(np.int32) for x in c.T])
    rows, reads = c.astype(kind), np.zeros((len(q), 2), np.int64)
    strongest = np.abs(q).argmax(axis=1)
    order = np.lexsort((q[np.arange(len(q)), strongest], strongest))
    at = row = 0
    while at < len(q):
        who = order[at : at + (WIDE if row >= ROW else TOGETHER)]
        reads[who] = _read(q[who], own[who], who, rows, places, ids, best, slack)
        row = row + 1 if reads[who, 1].max() > WHOLE * len(c) else 0
        at += len(who)
    return reads


def _read(q, own, who, rows, places, ids, best: _Best, slack: float) -> np.ndarray:
    """The threshold algorithm for a few queries over the lists ``places`` of a block, read from
    both ends; a query counts the accesses made while it was open."""
    dim, n = places.shape
    each, plus, minus = np.arange(dim), np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    strongest = np.maximum(np.abs(q.astype(float)).max(axis=1, keepdims=True), 1)
    share_top, share_low = plus / strongest, -minus / strongest
    # Where all scores are 0 the ids decide, so one list is read whole.
    share_top[~q.any(axis=1), 0] = 1.0
    top, low = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
    shown, left, reach = np.zeros(n, bool), n, 0
    going, reads = np.arange(len(who)), np.zeros((len(who), 2), np.int64)
    while left:
        high, least = (rows[places[each, x], each].astype(float) for x in (n - 1 - top, low))
        bound = plus[going] @ high + minus[going] @ least + slack
        going = going[bound >= best.floor[who[going]]]
        if not len(going):
            break
        reach = min(n, reach + max(STEP, min(reach // 4, n // PART)))
        tops = np.maximum(top, np.ceil(share_top[going].max(axis=0) * reach).astype(np.int64))
        lows = np.maximum(low, np.ceil(share_low[going].max(axis=0) * reach).astype(np.int64))
        seen = [x[n - b : n - a] for x, a, b in zip(places, top.tolist(), tops.tolist(), strict=True)]
        seen += [x[a:b] for x, a, b in zip(places, low.tolist(), lows.tolist(), strict=True)]
        now = np.zeros(n, bool)
        now[np.concatenate(seen)] = True
        fresh = np.flatnonzero(now & ~shown)
        shown[fresh] = True
        reads[going] += int((tops - top).sum() + (lows - low).sum()), len(fresh)
        top, low, left = tops, lows, left - len(fresh)
        if len(fresh):
            _merge(q[going].astype(rows.dtype), own[going], who[going], rows[fresh], ids[fresh], best)
    return reads


def _merge(q, own, who, c, ids, best: _Best) -> None:
    scores = _products(q, c)
    near = np.flatnonzero((scores >= below(best.floor[who], scores.dtype)[:, None]).ravel())
    row, col = np.divmod(near, len(ids))
    other = ids[col] != own[row]
    row, col = row[other], col[other]
    best.add(who[row], scores[row, col].astype(np.int64), ids[col])


FOUND = "query_id long, vec_id long, score long"
RANKED = "query_id long, rank int, vec_id long, score long"
ACCESSES = ("sorted_accesses", "random_accesses", "candidates")


def _stripe(k: int, more: tuple[str, ...]):
    def run(queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q in queries.itertuples():
            own = np.frombuffer(q.ids, np.int64)
            values = _matrix(q.values, q.dim, len(own))
            best, reads = _Best(len(own), k), np.zeros((len(own), 3), np.int64)
            for b in blocks.sort_values("cblock").itertuples():
                if b.dim == q.dim:
                    ids = np.frombuffer(b.ids, np.int64)
                    reads[:, :2] += _search(values, own, _matrix(b.values, b.dim, len(ids)), ids, best)
                    reads[:, 2] += len(ids)
            rows = np.repeat(np.arange(len(own)), best.count)
            # Accesses stand at the first row of a query, so that their sum counts them once.
            counts = np.where(np.diff(rows, prepend=-1)[:, None] > 0, reads[rows], 0)
            found = np.concatenate([*best.ids, *best.scores]).reshape(2, -1)
            out.append((own[rows], *found, *counts.T[: len(more)]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[]] * (3 + len(more))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score", *more), columns, strict=True)), dtype="int64")

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, accesses: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of ``vectors`` for each of ``queries``
    (both vec_id, embedding), without those that have the query's own id.

    Score: inner product of the quantised vectors; equal scores go to the smaller
    vec_id; fewer candidates give fewer rows. Only vectors of the query's length
    are compared. Left-out vectors: see ``quantised``. Equal rows are candidates each;
    a query id that occurs more than once is answered from all of its rows together.
    Blocks of queries meet stripes of candidate blocks, about one pair a task; a block's lists
    are whole, and a later block of a stripe starts from the k-th best of those before it.
    With ``accesses`` each row also has its query's sorted_accesses (entries read from lists while
    it was open), random_accesses (rows scored) and candidates (rows in the blocks it met).
    """
    c = _numbered(_blocks(quantised(vectors), BLOCK, "block"), "cblock")
    q = _numbered(_blocks(quantised(queries), QUERY_BLOCK, "block"), "qblock")
    more = ACCESSES if accesses else ()
    n_queries = q.count()
    n_blocks, size = c.agg(F.count("*"), F.sum(F.octet_length("values"))).first()
    if not n_queries or not n_blocks:
        return q.sparkSession.createDataFrame([], ", ".join([RANKED, *(f"{x} long" for x in more)]))
    slots = q.sparkSession.sparkContext.defaultParallelism
    n_stripes = min(n_blocks, max(-(-size // STRIPE_BYTES), -(-TASKS * slots // n_queries)))
    c = c.withColumn("stripe", F.col("cblock") % n_stripes)
    # Each block goes to every task that needs it: pairs of blocks, not of vectors.
    c = c.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    q = q.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(n_stripes - 1))))
    keys, parts = ("qblock", "stripe"), min(n_queries * n_stripes, PARTS)
    q, c = (x.repartition(parts, *keys) for x in (q, c))
    schema = ", ".join([FOUND, *(f"{x} long" for x in more)])
    found = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(_stripe(k, more), schema)
    own = Window.partitionBy("query_id")
    order = own.orderBy(F.col("score").desc(), "vec_id")
    for name in more:
        found = found.withColumn(name, F.sum(name).over(own))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", *more)
    )
