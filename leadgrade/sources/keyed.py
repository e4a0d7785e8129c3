"""An append-only table without repeats that knows where a key may be.

Rows lie in folders by batch and by a hash of the key. For each folder the table keeps a
Bloom filter of its keys in ``_index``. A new batch is held against the filters of its own
hash buckets, and only the folders whose filter answers are read, so a batch of new keys
reads next to nothing however long the history is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrade.plans.sizing import release, written

BUCKETS = 32
#: Bits of a filter per key, and bits that a key sets: one key in about 2,000 answers falsely.
BITS, PROBES = 16, 8
#: Keys that are held against a filter at once.
SLICE = 1 << 16

_INDEX = "batch string, bucket int, n long, bits binary"


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """(keys, probes): the bits of every key in a filter of ``size`` bits. The hash is mixed
    once more, because keys of one bucket have some of its bits in common."""
    h = hashes.view(np.uint64)[:, None]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h & np.uint64(0xFFFFFFFF)) + np.arange(PROBES, dtype=np.uint64) * step) % np.uint64(size)


def make_filter(hashes: np.ndarray) -> np.ndarray:
    size = max(64, -(-len(hashes) * BITS // 8) * 8)
    bits = np.zeros(size, np.uint8)
    bits[_slots(hashes, size).ravel()] = 1
    return np.packbits(bits)


def maybe(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which keys may be in a filter; none that is in it is missed."""
    at = _slots(hashes, len(bits) * 8)
    return ((bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, hash) to slices of hashes by bucket, as bytes."""
    held: dict[int, list[np.ndarray]] = {}

    def out(bucket: int) -> pa.RecordBatch:
        values = np.concatenate(held.pop(bucket))
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([values.tobytes()], pa.binary())], names=["bucket", "hashes"]
        )

    for batch in batches:
        buckets, hashes = batch["bucket"].to_numpy(), batch["hash"].to_numpy()
        for b in map(int, np.unique(buckets)):
            held.setdefault(b, []).append(hashes[buckets == b])
            if sum(map(len, held[b])) >= SLICE:
                yield out(b)
    for b in list(held):
        yield out(b)


def _answering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            if maybe(np.frombuffer(r["hashes"], np.int64), np.frombuffer(r["bits"], np.uint8)).any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["batch"]]), pa.array([r["bucket"]], pa.int32())], names=["batch", "bucket"]
                )


def _filters(name: str):
    """Sorted by bucket: one filter for each bucket of a partition."""

    def out(bucket: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.concatenate(parts)
        values = [name, bucket, len(hashes), make_filter(hashes).tobytes()]
        types = (pa.string(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=["batch", "bucket", "n", "bits"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = None, []
        for batch in batches:
            buckets, hashes = batch["bucket"].to_numpy(), batch["hash"].to_numpy()
            for b in map(int, np.unique(buckets)):
                if b != own and parts:
                    yield out(own, parts)
                    parts = []
                own = b
                parts.append(hashes[buckets == b])
        if parts:
            yield out(own, parts)

    return run


def _keyed(df: DataFrame, key: str) -> DataFrame:
    hashed = F.xxhash64(F.col(key).cast("string"))
    return df.select(F.pmod(hashed, F.lit(BUCKETS)).cast("int").alias("bucket"), hashed.alias("hash"))


def folders(spark: SparkSession, wanted: DataFrame, path: str, key: str) -> list[str]:
    """The stored folders that may hold a key of ``wanted``. Their names reach the driver,
    as those of any files that it reads."""
    if not path_exists(spark, f"{path}/_index"):
        return []
    index = spark.read.schema(_INDEX).parquet(f"{path}/_index")
    ids = _keyed(wanted, key).mapInArrow(_sliced, "bucket int, hashes binary")
    hits = ids.join(index, "bucket").mapInArrow(_answering, "batch string, bucket int").distinct()
    found = [f"{path}/batch={r['batch']}/bucket={r['bucket']}" for r in hits.collect()]
    # A run that died after its filters were stored has no rows.
    return sorted(f for f in found if path_exists(spark, f))


def _without(spark: SparkSession, wanted: DataFrame, key: str, found: list[str]) -> DataFrame:
    if not found:
        return wanted
    kind = wanted.schema[key].dataType
    held = spark.read.parquet(*found).select(F.col(key).cast(kind).alias(key))
    return wanted.join(held, key, "left_anti")


def absent(spark: SparkSession, wanted: DataFrame, path: str, key: str) -> DataFrame:
    """Rows of ``wanted`` whose key the table doesn't hold."""
    return _without(spark, wanted, key, folders(spark, wanted, path, key))


def append(spark: SparkSession, new: DataFrame, path: str, key: str, replace: bool = False) -> int:
    """Add the rows of ``new`` (one per key) whose key the table doesn't hold, or make them
    the whole table; returns the number of stored folders that were read."""
    if replace:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    elif path_exists(spark, path) and not path_exists(spark, f"{path}/_index"):
        raise ValueError(f"{path}: no table of this kind; replace it or append elsewhere")
    # Stored once: what the filters hold is what is appended, whatever runs twice.
    stored = written(new, "append")
    found = folders(spark, stored, path, key)
    todo = _without(spark, stored, key, found)
    batch = uuid.uuid4().hex
    todo = written(todo, "append-rest") if found else todo
    if todo.isEmpty():
        if replace:  # A table without rows still has its columns.
            todo.write.parquet(f"{path}/batch={batch}/bucket=0")
            spark.createDataFrame([], _INDEX).write.parquet(f"{path}/_index")
        release(stored, todo)
        return len(found)
    filters = _keyed(todo, key).repartition("bucket").sortWithinPartitions("bucket")
    filters.mapInArrow(_filters(batch), _INDEX).write.mode("append").parquet(f"{path}/_index")
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")
    rows = todo.withColumn("bucket", bucket)
    # Rows of a bucket come from one task each, so a batch has one file per bucket.
    rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/batch={batch}")
    release(stored, todo)
    return len(found)
