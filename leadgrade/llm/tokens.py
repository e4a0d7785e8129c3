"""Token counts of documents in flat token files that have no index.

A token file is a run of fixed-width ids; an end-of-document id follows each document.
The files are read in blocks. Each block is searched for that id at once; a prefix scan
over the blocks then tells how many documents end before a block and where the last one
did, which stitches documents that cross block borders.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadgrade.plans.sizing import work_dir, written

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that this vocabulary was made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
END = 50256
WIDTH = "uint16"
BLOCK_TOKENS = 1 << 20
#: Blocks that are scanned together before the scan over groups of blocks.
GROUP = 1024


@lru_cache(maxsize=2)
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encoder(folder: str, tokenizer: str, end: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():08d}.bin"
        store, root = fs.FileSystem.from_uri(folder)
        encode = _encoding(tokenizer).encode_ordinary
        draft = f"{root}/_{name}-{context.taskAttemptId()}"
        place, out = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(draft)
            for text in batch["text"]:
                ids = encode(text.as_py() or "")
                ids.append(end)
                out.write(np.array(ids, width).tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([name] * n), pa.array(np.arange(place, place + n))],
                ["doc_id", "file", "place"],
            )
            place += n
        if out is not None:
            out.close()
            # Every attempt writes the same bytes, so the last one to move may win.
            store.move(draft, f"{root}/{name}")

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end: int = END, width: str = WIDTH
) -> DataFrame:
    """Write the texts of ``docs`` (doc_id, text) as token files to ``folder``, one per
    partition, and return where each row went: (doc_id, file, place).

    ``folder`` is a path or address that every executor can write, ``tokenizer`` a file that
    every executor can read. A null text is a document without tokens. A file shows up
    only when it is whole, and a repeated task writes the same file.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if np.iinfo(width).max < end:
        raise ValueError(f"{width} can't hold {end}")
    where = rows.mapInArrow(_encoder(folder, tokenizer, end, width), "doc_id long, file string, place long")
    return written(where, "places")


def _searched(end: int, width: str):
    """Blocks (path, block, skip, length) to the places where documents end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, skip = batch["path"][i].as_py(), batch["skip"][i].as_py()
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as source:
                    source.seek(skip)
                    data = source.read(batch["length"][i].as_py())
                ids = np.frombuffer(data, width)
                ends = np.flatnonzero(ids == end) + skip // ids.itemsize
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]),
                        batch["block"].slice(i, 1),
                        pa.array([skip // ids.itemsize + len(ids)], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    ["path", "block", "upto", "ends"],
                )

    return run


COUNTED = "file string, place long, start long, n_tokens long, whole boolean"


def count_tokens(
    spark: SparkSession, folder: str, end: int = END, width: str = WIDTH, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """(file, place, start, n_tokens, whole) of every document in the token files of ``folder``.

    place counts the documents of a file from 0, start its tokens; the end-of-document id
    isn't counted. Tokens after the last such id are a document that isn't whole. A file
    whose size is no multiple of the id's width is refused. Empty files have no document.
    """
    size = np.dtype(width).itemsize
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
    if files.where(F.col("length") % size != 0).limit(1).count():
        raise ValueError(f"a file in {folder} ends inside of an id")
    step = block_tokens * size
    blocks = (
        files.where("length > 0")
        .select("path", "length", F.explode(F.expr(f"sequence(0L, (length - 1) div {step})")).alias("block"))
        .select("path", "block", (F.col("block") * step).alias("skip"), F.least(F.lit(step), F.col("length") - F.col("block") * step).alias("length"))
        .repartition(F.xxhash64("path", "block"))
    )
    found = written(
        blocks.mapInArrow(_searched(end, width), "path string, block long, upto long, ends array<long>"), "ends"
    )
    return written(_stitched(found), "counts")


def _stitched(found: DataFrame) -> DataFrame:
    """The scan: (path, block, upto, ends) to one row per document."""
    last = F.element_at("ends", F.when(F.size("ends") > 0, -1))
    slim = found.select(
        "path", "block", "upto", F.size("ends").cast("long").alias("n"), last.alias("last"),
        F.floor(F.col("block") / GROUP).alias("group"),
    )
    above = Window.partitionBy("path").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        slim.groupBy("path", "group")
        .agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        .select(
            "path", "group",
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
            F.max("last").over(above).alias("last_above"),
        )
    )
    near = Window.partitionBy("path", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        slim.withColumn("n_near", F.coalesce(F.sum("n").over(near), F.lit(0)))
        .withColumn("last_near", F.max("last").over(near))
        .join(groups, ["path", "group"])
        .select(
            "path", "block",
            (F.col("n_above") + F.col("n_near")).alias("before"),
            F.coalesce("last_near", "last_above", F.lit(-1)).alias("carry"),
        )
    )
    name = F.element_at(F.split("path", "/"), -1)
    docs = (
        found.join(carried, ["path", "block"])
        .select("path", "before", "carry", "ends", F.posexplode("ends").alias("at", "stop"))
        .withColumn("start", F.when(F.col("at") == 0, F.col("carry")).otherwise(F.expr("get(ends, at - 1)")) + 1)
        .select(
            name.alias("file"), (F.col("before") + F.col("at")).alias("place"), "start",
            (F.col("stop") - F.col("start")).alias("n_tokens"), F.lit(True).alias("whole"),
        )
    )
    tail = (
        slim.groupBy("path")
        .agg(F.max("upto").alias("upto"), F.coalesce(F.max("last"), F.lit(-1)).alias("last"), F.sum("n").alias("n"))
        .where(F.col("upto") > F.col("last") + 1)
        .select(
            name.alias("file"), F.col("n").alias("place"), (F.col("last") + 1).alias("start"),
            (F.col("upto") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("whole"),
        )
    )
    return docs.union(tail)


def document_token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, file, place) for every row of ``docs`` (doc_id, text).

    The rows are written as token files to the shared folder, and counted from these
    alone. Null and empty texts have 0 tokens; rows with a null doc_id, and repeated rows,
    are counted each. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "tokens")
    places = write_token_files(docs, folder, tokenizer)
    if places.isEmpty():
        return places.selectExpr("doc_id", "0L as n_tokens", "file", "place")
    counts = count_tokens(spark, folder).select("file", "place", "n_tokens")
    return places.join(counts, ["file", "place"]).select("doc_id", "n_tokens", "file", "place")
