"""Appending without reading the history, and streams with bounded state."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrade.sources import keyed
from leadgrade.streaming import jobs


def table(spark, ids):
    return spark.createDataFrame([(f"l{i}", int(i)) for i in ids], "lead_id string, x long")


def ids_in(spark, path):
    return sorted(r["x"] for r in spark.read.parquet(path).collect())


def test_filters_miss_no_key():
    rng = np.random.default_rng(1)
    inside, outside = (rng.integers(-(2**62), 2**62, 4000) for _ in range(2))
    bits = keyed.make_filter(inside)
    assert keyed.maybe(inside, bits).all()
    assert keyed.maybe(outside, bits).mean() < 0.01
    assert not keyed.maybe(outside, keyed.make_filter(inside[:0])).any()


def test_new_keys_read_no_history(spark, tmp_path):
    path = str(tmp_path / "t")
    read = [keyed.append(spark, table(spark, range(40 * i, 40 * i + 40)), path, "lead_id") for i in range(6)]
    # Every batch holds new keys: a filter answers falsely once in about 2,000 times.
    assert sum(read) <= 2 and ids_in(spark, path) == list(range(240))
    again = keyed.append(spark, table(spark, [41, 42, 1000]), path, "lead_id")
    assert 1 <= again <= 4 and ids_in(spark, path) == [*range(240), 1000]
    left = keyed.absent(spark, table(spark, [5, 239, 7000]), path, "lead_id")
    assert [r["x"] for r in left.collect()] == [7000]


def test_a_run_that_died_between_filters_and_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.append(spark, table(spark, range(5)), path, "lead_id")
    dead = keyed._keyed(table(spark, range(5, 9)), "lead_id").repartition("bucket").sortWithinPartitions("bucket")
    dead.mapInArrow(keyed._filters("dead"), keyed._INDEX).write.mode("append").parquet(f"{path}/_index")
    keyed.append(spark, table(spark, range(9)), path, "lead_id")
    assert ids_in(spark, path) == list(range(9))


def test_empty_batches_and_foreign_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.append(spark, table(spark, []), path, "lead_id", replace=True)
    assert ids_in(spark, path) == [] and spark.read.parquet(path).columns[:2] == ["lead_id", "x"]
    assert keyed.append(spark, table(spark, []), path, "lead_id") == 0
    keyed.append(spark, table(spark, [1]), path, "lead_id")
    assert ids_in(spark, path) == [1]
    keyed.append(spark, table(spark, [2]), path, "lead_id", replace=True)
    assert ids_in(spark, path) == [2]
    table(spark, [1]).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="no table of this kind"):
        keyed.append(spark, table(spark, [2]), str(tmp_path / "plain"), "lead_id")


def test_state_of_the_latest_notes_falls(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "k string, ts timestamp, n long, text string"
    days = [
        [(f"k{i}", "2024-01-01 10:00:00", i, "first") for i in range(20)],
        [("k0", "2024-01-02 10:00:00", 100, "second"), ("k1", "2024-01-02 11:00:00", 101, "second")],
        # Late, but within the bound, and newer than what is stored of k2 and k3.
        [("k2", "2024-01-01 23:00:00", 102, "late"), ("k3", "2024-01-01 09:00:00", 103, "older")],
        [("k4", "2024-01-09 10:00:00", 104, "far on")],
        [("k4", "2024-01-09 11:00:00", 105, "after")],
    ]
    kept = []
    for rows in days:
        df = spark.createDataFrame(rows, "k string, ts string, n long, text string")
        df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        query = jobs.keep_latest(events, "k", "ts", "n", ["text"], target, state, delay="2 days")
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert kept[0] == 20 and kept[2] >= 22 and kept[-1] <= 2
    got = {r["k"]: r["text"] for r in jobs.read_latest(spark, target, "k", "ts", "n").collect()}
    assert len(got) == 20 and got["k0"] == got["k1"] == "second" and got["k2"] == "late"
    assert got["k3"] == "first" and got["k4"] == "after" and got["k19"] == "first"
    compacted = jobs.compact_latest(spark, target, str(tmp_path / "compact"), "k", "ts", "n")
    assert compacted.count() == 20
    again = jobs.read_latest(spark, str(tmp_path / "compact"), "k", "ts", "n")
    assert {r["k"]: r["text"] for r in again.collect()} == got
