"""Exact quantiles of many columns at once, and numbers for values in order.

A sketch per column, all in one aggregate, brackets every wanted quantile. Two more passes
count what lies below each bracket and, by value, inside it; only those few values are
ordered. The sketch decides how much is ordered, never the result: a bracket that misses
its rank is opened to the whole column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadgrade.plans.ordered import _offsets, running_totals
from leadgrade.plans.sizing import written

#: Half the width of a bracket in ranks; a sketch errs by about 0.0133.
HALF = 0.02


def _number(column: str):
    return F.nullif(F.col(column).cast("double"), F.lit(float("nan")))


def wide_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], half: float = HALF) -> DataFrame:
    """(column, prob, n, n_null, quantile, lo, hi), a row per column and wanted share.

    Quantiles by linear interpolation between the values ``lo`` and ``hi``. ``n`` counts the
    values that are neither null nor NaN, ``n_null`` the nulls; a column without values has
    null quantiles. The driver sees a few numbers per row.
    """
    aggs = []
    for i, (column, probs) in enumerate(wanted.items()):
        x, n = _number(column), F.count(_number(column))
        sketch = F.kll_sketch_agg_double(x)
        aggs += [n.alias(f"n{i}"), F.count_if(F.col(column).isNull()).alias(f"null{i}")]
        for j, p in enumerate(probs):
            for side, share in (("a", max(0.0, p - half)), ("b", min(1.0, p + half))):
                edge = F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))
                aggs.append(edge.alias(f"{side}{i}_{j}"))
    first = df.agg(*aggs).first()
    targets = [
        (column, p, first[f"n{i}"], first[f"null{i}"], first[f"a{i}_{j}"], first[f"b{i}_{j}"])
        for i, (column, probs) in enumerate(wanted.items())
        for j, p in enumerate(probs)
    ]
    return _selected(df, targets)


def _selected(df: DataFrame, targets: list[tuple]) -> DataFrame:
    spark, inf = df.sparkSession, float("inf")
    edges = [(-inf if t[4] is None else t[4], inf if t[5] is None else t[5]) for t in targets]

    def below(edges):
        counts = [F.count_if(_number(t[0]) < F.lit(a)).alias(f"c{i}") for i, (t, (a, _)) in enumerate(zip(targets, edges, strict=True))]
        counts += [F.count_if(_number(t[0]) <= F.lit(b)).alias(f"d{i}") for i, (t, (_, b)) in enumerate(zip(targets, edges, strict=True))]
        return df.agg(*counts).first()

    ranks = [(int(p * (n - 1)) + 1, -int(-p * (n - 1) // 1) + 1) for _, p, n, *_ in targets]
    seen = below(edges)
    missed = [i for i, (lo, hi) in enumerate(ranks) if targets[i][2] and not seen[f"c{i}"] < lo <= hi <= seen[f"d{i}"]]
    if missed:
        edges = [(-inf, inf) if i in missed else e for i, e in enumerate(edges)]
        seen = below(edges)
    about = [
        (i, *t[:4], max(0, lo - seen[f"c{i}"]), max(0, hi - seen[f"c{i}"]))
        for i, (t, (lo, hi)) in enumerate(zip(targets, ranks, strict=True))
    ]
    table = spark.createDataFrame(
        about, "target int, column string, prob double, n long, n_null long, rank_lo long, rank_hi long"
    )
    inside = [
        F.when(_number(t[0]).between(a, b), F.struct(F.lit(i).alias("target"), _number(t[0]).alias("value")))
        for i, (t, (a, b)) in enumerate(zip(targets, edges, strict=True))
    ]
    rows = df.select(F.explode(F.array_compact(F.array(*inside))).alias("x")).select("x.*")
    counts = written(rows.groupBy("target", "value").agg(F.count("*").alias("c")), "inside")
    ranked = running_totals(counts, "value", ["c"], ["target"], descending=False)
    reached = ranked.join(F.broadcast(table), "target")
    values = reached.groupBy("target").agg(
        *[F.min(F.when(F.col("cum_c") >= F.col(f"rank_{s}"), F.col("value"))).alias(s) for s in ("lo", "hi")]
    )
    out = table.join(values, "target", "left")
    position = F.col("prob") * (F.col("n") - 1)
    quantile = F.col("lo") + (F.col("hi") - F.col("lo")) * (position - F.floor(position))
    return out.select("column", "prob", "n", "n_null", quantile.alias("quantile"), "lo", "hi")


def numbered(df: DataFrame, group: str, value: str) -> DataFrame:
    """``df`` (one row per group and value) with ``slot``: 0, 1, ... in order of the value
    within each group.

    Values are dealt out in ranges; each range is numbered on its own and starts after the
    counts of the ranges before it. No task holds a whole group.
    """
    ranges = df.repartitionByRange(group, value).withColumn("_b", F.spark_partition_id())
    ranges = written(ranges, "ranges")
    starts = _offsets(ranges, {"c": F.lit(1)}, [group])
    order = Window.partitionBy(group, "_b").orderBy(value)
    slot = F.row_number().over(order) - 1 + F.col("_off_c")
    return ranges.join(starts, [group, "_b"]).withColumn("slot", slot.cast("int")).select(*df.columns, "slot")
