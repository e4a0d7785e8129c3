"""Benchmark decontamination: short test items inside long documents.

Items are put into partitions by size. For every hash function of a family, an item is
known by its smallest shingle; a document is searched with windows of its partition's
size, so that a short item is compared with a stretch of similar size however long the
document is. A document whose window has the same smallest shingle as an item is a
candidate, and the exact share of the item's shingles in the document decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.llm.words import counted, pieces, seeded, shingles, word_hashes
from leadgrade.plans.sizing import written

HASHES = 16
CONTAINMENT = 0.8
#: Bits of the filter that is sent to every task, whatever the number of items.
FILTER_BITS = 1 << 23


def size_class(n: int) -> int:
    """The partition of an item with ``n`` shingles: the next power of two."""
    return 1 << (int(n) - 1).bit_length()


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text) to (item_id, shingles, partition, signature)."""
    for whole in batches:
        for batch in pieces(whole, "text"):
            found, offsets = shingles(*word_hashes(batch["text"]))
            keys, signs, parts, at = [], [], [], []
            for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
                if a == b:
                    continue
                own = counted(found[a:b])[0]
                at.append(i)
                keys.append(own.tobytes())
                parts.append(size_class(b - a))
                signs.append([int(own[seeded(own, f).argmin()].view(np.int64)) for f in range(HASHES)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["item_id"].take(pa.array(at, pa.int64())),
                    pa.array(keys, pa.binary()),
                    pa.array(parts, pa.int32()),
                    pa.array(signs, pa.list_(pa.int64())),
                ],
                ["item_id", "shingles", "partition", "signature"],
            )


def _bits(words: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for at, value in words:
        out[at] = value
    return out.view(np.uint8)


def _hits(bits: bytes, sizes: list[int]):
    """(node, text) to one row per text that may hold an item: its distinct shingles, and
    (partition, function, shingle) for each window minimum that the filter knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits, np.uint8)
        for whole in batches:
            for batch in pieces(whole, "text"):
                found, offsets = shingles(*word_hashes(batch["text"]))
                slot = found % np.uint64(FILTER_BITS)
                may = (known[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
                spots = np.flatnonzero(may)
                if not len(spots):
                    continue
                row = np.searchsorted(offsets, spots, side="right") - 1
                nodes, keys, minima = [], [], []
                for i in np.unique(row):
                    own = found[offsets[i] : offsets[i + 1]]
                    hits = _window_minima(own, spots[row == i] - offsets[i], sizes)
                    if hits:
                        nodes.append(int(i))
                        keys.append(counted(own)[0].tobytes())
                        minima.append(hits)
                kind = pa.list_(pa.struct([("partition", pa.int32()), ("function", pa.int32()), ("shingle", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["node"].take(pa.array(nodes, pa.int64())),
                        pa.array(keys, pa.binary()),
                        pa.array(minima, kind),
                    ],
                    ["node", "shingles", "minima"],
                )

    return run


def _window_minima(own: np.ndarray, spots: np.ndarray, sizes: list[int]) -> list[dict]:
    """Which of the shingles at ``spots`` are the smallest of a window of each size."""
    out = set()
    for f in range(HASHES):
        order = seeded(own, f)
        for c in spots:
            value = order[c]
            reach = min(len(own), max(sizes))
            left, right = order[max(0, c - reach) : c][::-1], order[c + 1 : c + 1 + reach]
            lower = np.flatnonzero(left < value)
            before = int(lower[0]) if len(lower) else len(left)
            lower = np.flatnonzero(right < value)
            after = int(lower[0]) if len(lower) else len(right)
            for size in sizes:
                if before + after + 1 >= min(size, len(own)):
                    out.add((size, f, int(own[c].view(np.int64))))
    return [{"partition": p, "function": f, "shingle": s} for p, f, s in sorted(out)]


def _contained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        share = []
        for mine, theirs in zip(batch["shingles"], batch["item_shingles"], strict=True):
            own = np.frombuffer(mine.as_buffer(), np.uint64)
            item = np.frombuffer(theirs.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(own, item), len(own) - 1)
            share.append(float((own[at] == item).mean()))
        yield pa.RecordBatch.from_arrays(
            [batch["node"], batch["item_id"], pa.array(share, pa.float64())],
            ["node", "item_id", "containment"],
        )


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """(node, item_id, containment): the md5 of each text of ``docs`` (text) and the items
    (item_id, text) of which it has at least ``threshold`` of the shingles."""
    schema = "item_id long, shingles binary, partition int, signature array<long>"
    clean = items.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"))
    items = written(
        clean.where("text is not null").distinct().mapInArrow(_item_rows, schema), "items"
    )
    signs = items.select("item_id", "partition", F.posexplode("signature").alias("function", "shingle"))
    # shingle mod FILTER_BITS of the unsigned value: the low bits are the same.
    bit = F.col("shingle").bitwiseAND(FILTER_BITS - 1)
    packed = (
        signs.select(F.shiftright(bit, 6).cast("int").alias("at"), F.expr("shiftleft(1L, cast(shingle & 63 as int))").alias("one"))
        .groupBy("at")
        .agg(F.bit_or("one").alias("value"))
        .collect()
    )
    sizes = [r.partition for r in items.select("partition").distinct().orderBy("partition").collect()]
    texts = docs.where("text is not null").select(
        F.unhex(F.md5("text")).alias("node"), F.lower("text").alias("text")
    )
    kind = "array<struct<partition:int,function:int,shingle:long>>"
    bits = _bits([(r["at"], r.value) for r in packed]).tobytes()
    found = texts.mapInArrow(_hits(bits, sizes), f"node binary, shingles binary, minima {kind}")
    found = written(found if sizes else found.limit(0), "hits")
    found = found.dropDuplicates(["node"])
    pairs = (
        found.select("node", F.explode("minima").alias("m"))
        .select("node", "m.*")
        .join(signs, ["partition", "function", "shingle"])
        .select("node", "item_id")
        .distinct()
    )
    own = items.select("item_id", F.col("shingles").alias("item_shingles"))
    tested = (
        pairs.join(found.select("node", "shingles"), "node")
        .join(own, "item_id")
        .mapInArrow(_contained, "node binary, item_id long, containment double")
    )
    best = tested.groupBy("node", "item_id").agg(F.max("containment").alias("containment"))
    return written(best.where(F.col("containment") >= threshold), "contained")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, containment) for every row of ``docs`` and item found in its text.

    Words and case are those of ``words``; a shingle is five words. Items of fewer than
    five words have no shingle and are never found. An item that occurs twice under an
    id is found once, with its larger share. Null or empty texts hold nothing; rows with
    a null doc_id are returned with it; repeated rows are all returned. Other
    columns are ignored. Without items or documents the result is empty.
    """
    found = contained_items(docs.select("text"), items, threshold)
    rows = docs.where("text is not null").select("doc_id", F.unhex(F.md5("text")).alias("node"))
    return rows.join(found, "node").select("doc_id", "item_id", "containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs``, with all columns, in whose text no item is found."""
    found = contained_items(docs.select("text"), items, threshold).select(F.col("node").alias("_node"))
    rows = docs.withColumn("_node", F.unhex(F.md5("text")))
    return rows.join(found.distinct(), "_node", "left_anti").drop("_node")
