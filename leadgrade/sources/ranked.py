"""A ranked list stored in order, with a small table that says what each file holds.

Rows are sorted by priority over all files. ``_zones`` has for each file its lowest and highest
priority, its rows, and the rows of the files before it. A top list reads the files that can
hold its rows, a floor those that it cuts; totals come from the zones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrade.operators.priority import check_top_arguments
from leadgrade.plans.ordered import running_totals
from leadgrade.plans.sizing import written

_ZONES = "file string, lo double, hi double, n long, up_to long"


def write_ranked(ranked: DataFrame, path: str) -> None:
    """Store (lead_id, priority, ...) for ``top_leads``. Rows without a priority come last and
    are in no list with a floor."""
    spark = ranked.sparkSession
    order = [F.desc_nulls_last("priority"), "lead_id"]
    ranked.orderBy(*order).write.mode("overwrite").parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    found = rows.groupBy(F.input_file_name().alias("file")).agg(
        F.min(F.coalesce("priority", F.lit(-1.0))).alias("lo"),
        F.max(F.coalesce("priority", F.lit(-1.0))).alias("hi"),
        F.count("*").alias("n"),
    )
    # Files whose highest priority is equal count together, so the sum is the same in any order.
    found = written(found, "zones")
    by_top = running_totals(found.groupBy("hi").agg(F.sum("n").alias("m")), "hi", ["m"])
    zones = found.join(by_top.select("hi", F.col("cum_m").alias("up_to")), "hi")
    zones.select("file", "lo", "hi", "n", "up_to").write.mode("overwrite").parquet(f"{path}/_zones")


def _zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_ZONES).parquet(f"{path}/_zones")


def files_for(spark: SparkSession, path: str, n: int, floor: float = 0.0) -> list[str]:
    """The files that can hold one of the first ``n`` rows at or above the floor.

    The files down to the first whose running total reaches ``n`` hold so many rows at or
    above their lowest priority; a file that is all below it can't help.
    """
    zones = _zones(spark, path)
    # No row without a floor either: a list of the whole table reads all files.
    wanted = zones if floor <= 0.0 else zones.where(F.col("hi") >= floor)
    reach = wanted.where(F.col("up_to") >= n).agg(F.max("hi").alias("hi")).first()["hi"]
    if reach is not None:
        lowest = wanted.where(F.col("hi") >= reach).agg(F.min("lo").alias("lo")).first()["lo"]
        wanted = wanted.where(F.col("hi") >= lowest)
    return [r["file"] for r in wanted.select("file").collect()]


def count_above(spark: SparkSession, path: str, floor: float) -> int:
    """Rows at or above the floor: whole files from the zones, cut ones from their rows."""
    zones = _zones(spark, path)
    above = zones.agg(F.sum(F.when(F.col("lo") >= floor, F.col("n"))).alias("n")).first()["n"] or 0
    cut = [r["file"] for r in zones.where((F.col("lo") < floor) & (F.col("hi") >= floor)).collect()]
    if not cut:
        return above
    return above + spark.read.parquet(*cut).where(F.col("priority") >= floor).count()


def total(spark: SparkSession, path: str) -> int:
    return _zones(spark, path).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def top_leads(
    spark: SparkSession, path: str, n: int = 10, min_priority: float = 0.0, max_n: int | None = None
) -> DataFrame:
    """The first ``n`` stored leads at or above the floor (ties by id), with
    ``total_available``, the number of all leads."""
    check_top_arguments(n, min_priority, max_n)
    files = files_for(spark, path, n, min_priority) if n else []
    schema = spark.read.parquet(f"{path}/rows").schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    if min_priority > 0.0:
        rows = rows.where(F.col("priority") >= min_priority)
    top = rows.orderBy(F.desc_nulls_last("priority"), "lead_id").limit(n)
    return top.withColumn("total_available", F.lit(total(spark, path)).cast("long"))
