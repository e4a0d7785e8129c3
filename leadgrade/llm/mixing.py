"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a budget of words. Whole passes over a source come first; the rest of
the budget is a weighted sample without replacement: each document draws an exponential
key divided by its quality weight, and the documents with the smallest keys are
taken until the budget is full. Sums up to a key come from key ranges that are split
again where the budget ends, so no source is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrade.plans.sizing import written

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_PASSES = 2.0
SEED = 20240613
RANGES, LEVELS = 1024, 3
#: Logarithms of all keys lie in this range: a key is between 2^-54 and 53 ln 2 / 0.05.
LEAST_LOG, MOST_LOG = -38.0, 7.0


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of letters and spaces among the characters, squared; 0.05 at least."""
    odd = F.length(F.regexp_replace(text, r"[\p{L} ]+", ""))
    share = 1 - odd / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share * share, F.lit(0.0)), F.lit(0.05))


def _uniform(seed: int) -> Column:
    """In (0, 1), from the id and, if that is null, the text alone."""
    draw = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text")), F.lit(seed))
    return (F.shiftrightunsigned(draw, 11).cast("double") + 0.5) / float(1 << 53)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) to the same with ``target``.

    Sources ordered by code point, null last, weigh ``weights`` in turn and share
    ``TOTAL_SHARE`` of all sizes. A target stops at ``MOST_PASSES`` times its source's size;
    what is over is shared again by weight among the others until none is above.
    Only sums reach the driver.
    """
    spark = sizes.sparkSession
    order = [F.col("source").isNull(), F.encode("source", "UTF-8")]
    ranked = sizes.orderBy(*order).rdd.zipWithIndex().map(lambda r: (*r[0], r[1]))
    names = "source string, source_size long, at long"
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    table = written(
        spark.createDataFrame(ranked, names).withColumn("weight", weight).withColumn("most", F.col("source_size") * MOST_PASSES),
        "sources",
    )
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * TOTAL_SHARE
    level, capped = 0.0, -1
    while True:
        full = F.col("most") <= level * F.col("weight")
        row = table.agg(
            F.sum(F.when(full, F.col("most"))).alias("used"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if row.n == capped or not row.weight:
            break
        capped, level = row.n, (total - (row.used or 0.0)) / row.weight
    share = F.least("most", F.lit(level) * F.col("weight"))
    return table.select("source", "source_size", share.alias("target"))


def _measured(docs: DataFrame, seed: int) -> DataFrame:
    added = ("size", "source_size", "target", "taken")
    drawn = F.least(_uniform(seed), F.lit(1 - 2.0**-53))
    key = -F.log1p(-drawn) / quality_weight(F.col("text"))
    rows = docs.drop(*added).withColumn("size", words(F.col("text")))
    return rows.withColumn("_at", key).withColumn("_tie", F.md5("text"))


def _cell(level: int) -> Column:
    place = (F.log("_at") - LEAST_LOG) / (MOST_LOG - LEAST_LOG)
    return F.floor(place * float(RANGES**level)).cast("long")


def _cut(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """``goal`` with the key range ``_edge`` of the last level in which the budget ends and
    the words ``_before`` it. Each level splits the range of the level above."""
    state = goal.withColumn("_edge", F.lit(0).cast("long")).withColumn("_before", F.lit(0).cast("long"))
    for level in range(1, LEVELS + 1):
        same = F.col("source").eqNullSafe(F.col("_source"))
        inside = F.floor(F.col("_cell") / RANGES) == F.col("_edge")
        sums = (
            rows.select("source", "size", _cell(level).alias("_cell"))
            .groupBy("source", "_cell")
            .agg(F.sum("size").alias("n"))
            .join(state, same & inside)
        )
        upto = Window.partitionBy("_source").orderBy("_cell")
        sums = sums.withColumn("upto", F.col("_before") + F.sum("n").over(upto))
        cell = F.struct("_cell", (F.col("upto") - F.col("n")).alias("words"))
        over = (
            sums.groupBy("_source")
            .agg(F.min(F.when(F.col("upto") > F.col("_budget"), cell)).alias("cut"), F.max("upto").alias("all"))
            .toDF("_s", "cut", "all")
        )
        state = written(
            state.join(over, F.col("_source").eqNullSafe(F.col("_s")), "left")
            .withColumn("_before", F.coalesce("cut.words", "all", "_before"))
            .withColumn("_edge", F.coalesce("cut._cell", F.lit(RANGES**level).cast("long")))
            .drop("_s", "cut", "all"),
            "cut",
        )
    return state


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED, text: bool = True
) -> DataFrame:
    """``docs`` with size, source_size, target and taken; same-named columns go, and so
    does the text without ``text``.

    size: the text's words, 0 for null. source_size and target: of the row's source
    (see ``targets``); a null source is a source. taken: the words that the mix takes,
    size times the whole passes, plus the row's part of the rest: the whole size if it comes
    before the end of the budget, and of the document in which the budget ends as many
    words as are left, so that the taken words of a source are its target, rounded.
    Equal keys go by doc_id, then text; of repeated rows any may come first, which leaves the
    same rows. Empty tables stay empty; a source without words has target 0.
    """
    rows = _measured(docs, seed)
    rows = written(rows if text else rows.drop("text"), "measured")
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1))).cast("long")
    goal = (
        goal.withColumn("_passes", passes)
        .withColumn("_budget", F.round("target").cast("long") - F.col("_passes") * F.col("source_size"))
        .withColumnRenamed("source", "_source")
    )
    goal = _cut(rows, written(goal, "targets"))
    placed = rows.join(goal, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "_cell", _cell(LEVELS)
    )
    away = placed.where(F.col("_cell") != F.col("_edge")).withColumn(
        "_part", F.when(F.col("_cell") < F.col("_edge"), F.col("size")).otherwise(F.lit(0).cast("long"))
    )
    order = Window.partitionBy("_source").orderBy("_at", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    left = F.greatest(F.col("_budget") - before, F.lit(0))
    at_edge = placed.where(F.col("_cell") == F.col("_edge")).withColumn("_part", F.least("size", left))
    return (
        away.union(at_edge)
        .withColumn("taken", F.col("size") * F.col("_passes") + F.col("_part"))
        .drop("_at", "_tie", "_source", "_passes", "_budget", "_edge", "_before", "_cell", "_part")
    )
