"""Global order, running sums, exact quantiles and exact cuts.

A window without a partition key sorts the whole table in one task. The helpers
here cut the order into buckets first, so every task sees one bucket:

* rows are pre-aggregated by order key, so a key held by a third of all rows is
  one row per map task before any shuffle;
* bucket edges are approximate quantiles of the *distinct* keys. They only decide
  how work is spread; results stay exact whatever the edges are;
* bucket totals (one row per bucket) give each bucket its offset.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadgrade.functions.hashing import hash_bucket, hash_uniform
from leadgrade.plans.sizing import written

TIE_SEED = "tie"
Reaching = tuple[str, Sequence[Column]]


def bucket_count(spark: SparkSession) -> int:
    """Buckets for one ordering: a power of two that follows the shuffle width."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(6, math.ceil(math.log2(max(2, width))))


def _edges(df: DataFrame, key: str, groups: Sequence[str], buckets: int) -> DataFrame:
    probs = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    # Neighbouring edges have to differ by more than the error of the sketch.
    accuracy = max(1000, 4 * buckets)
    sketch = f"percentile_approx({key}, array({probs}), {accuracy})"
    return df.groupBy(*groups).agg(F.expr(sketch).alias("_edges"))


def _with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Binary search of ``key`` in the sorted ``_edges``, one projection per level."""
    out, step = df.withColumn("_b", F.lit(0)), buckets // 2
    while step:
        right = f"_b + if({key} > get(_edges, _b + {step - 1}), {step}, 0)"
        out, step = out.withColumn("_b", F.expr(right)), step // 2
    return out.drop("_edges")


def in_buckets(counts: DataFrame, key: str) -> DataFrame:
    """``counts`` with ``_b``: ascending ranges of ``key``, about alike in rows."""
    buckets = bucket_count(counts.sparkSession)
    rows = _present(counts, [key])
    return _with_bucket(_attach(rows, _edges(rows, key, (), buckets), (), ()), key, buckets)


def _present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose ordering columns are all set.

    A join on these columns implies the same filter, but only on its own branch;
    stated up front it holds on all of them, and they can share an exchange.
    """
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df


def _attach(
    big: DataFrame,
    small: DataFrame,
    groups: Sequence[str],
    extra: Sequence[str],
) -> DataFrame:
    """Join per-group facts. Without groups there is one row, or one a bucket; with
    groups their number is open, and the planner picks the join."""
    on = [*groups, *extra]
    if not on:
        return big.crossJoin(F.broadcast(small))
    return big.join(small if groups else F.broadcast(small), on)


def _offsets(
    bucketed: DataFrame,
    sums: dict[str, Column],
    groups: Sequence[str],
    reaching: Reaching | None = None,
) -> DataFrame:
    """(groups, _b, _off_<s>, total_<s>): what comes before each bucket.

    The totals of a group are one short array, so its running sum needs no window.
    ``reaching`` keeps only the buckets in which a running sum reaches a target.
    """
    totals = bucketed.groupBy(*groups, "_b").agg(
        *[F.sum(col).cast("bigint").alias(s) for s, col in sums.items()]
    )
    lists = totals.groupBy(*groups).agg(
        F.array_sort(F.collect_list(F.struct("_b", *sums))).alias("_l")
    )

    def prefix(s: str) -> Column:
        """0, first bucket, first two buckets, ... : one entry more than buckets."""
        start = F.array(F.lit(0).cast("bigint"))
        return F.aggregate(
            "_l", start, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x[s]))
        )

    size = F.size("_l")
    summed = lists.where(size > 0).select(
        *groups, "_l", *[prefix(s).alias(f"_p_{s}") for s in sums]
    )
    offsets = summed.select(
        *groups,
        F.inline(
            F.transform(
                F.sequence(F.lit(0), size - 1),
                lambda i: F.struct(
                    F.get("_l", i)["_b"].alias("_b"),
                    *[F.get(f"_p_{s}", i).alias(f"_off_{s}") for s in sums],
                    *[F.get(f"_p_{s}", i + 1).alias(f"_end_{s}") for s in sums],
                    *[F.element_at(f"_p_{s}", -1).alias(f"total_{s}") for s in sums],
                ),
            )
        ),
    )
    if reaching:
        name, targets = reaching
        hit = F.lit(False)
        for target in targets:
            hit = hit | ((target > F.col(f"_off_{name}")) & (target <= F.col(f"_end_{name}")))
        offsets = offsets.where(hit)
    return offsets.drop(*[f"_end_{s}" for s in sums])


def running_totals(
    counts: DataFrame,
    key: str,
    sums: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = True,
    reaching: Reaching | None = None,
) -> DataFrame:
    """Add ``cum_<s>`` (inclusive running sum) and ``total_<s>`` per group.

    ``counts`` holds one row per (groups, key), both non-null, ``sums`` integer.
    There may be any number of groups.

    ``reaching=(s, targets)`` keeps only the buckets in which the running sum of
    ``s`` reaches one of the targets (expressions over ``total_<s>``, from 1 up).
    All other rows are dropped by the offset join, before the shuffle and sort.
    """
    spark = counts.sparkSession
    buckets = bucket_count(spark)
    order = F.col(key).cast("double")
    # The counts feed three branches: edges, bucket totals and rows. The order key
    # is made to depend on every sum, so that column pruning leaves the branches
    # alike and Spark runs the counting, and the edges, once for all of them.
    valid = sum((F.abs(s) for s in sums), F.lit(0)) >= 0
    keyed = _present(counts, [*groups, key]).withColumn(
        "_k", F.when(valid, -order if descending else order)
    )
    edges = _edges(keyed, "_k", groups, buckets)
    bucketed = _with_bucket(
        _attach(keyed, edges, groups, ()), "_k", buckets
    )

    offsets = _offsets(
        bucketed, {s: F.col(s) for s in sums}, groups, reaching
    )
    window = (
        Window.partitionBy(*groups, "_b")
        .orderBy("_k")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = _attach(bucketed, offsets, groups, ("_b",))
    return joined.select(
        *counts.columns,
        *[
            (F.sum(s).over(window) + F.col(f"_off_{s}")).cast("bigint").alias(f"cum_{s}")
            for s in sums
        ],
        *[f"total_{s}" for s in sums],
    )


def quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    For each entry of ``probs`` the columns ``<name>``, ``<name>_lo`` and
    ``<name>_hi`` hold the quantile and the two values it lies between; ``n`` is
    the number of values that are neither null nor NaN.

    Found by selection, not by sorting: a sketch proposes bucket edges, one pass
    counts rows per bucket, and only the values of the buckets that hold a wanted
    rank are counted, shuffled and ordered.
    """
    number = F.col(value).cast("double")
    rows = _present(
        df.select(*groups, F.nullif(number, F.lit(float("nan"))).alias("_v")),
        [*groups, "_v"],
    )
    buckets = bucket_count(df.sparkSession)
    edges = _edges(rows, "_v", groups, buckets)
    bucketed = _with_bucket(
        _attach(rows, edges, groups, ()), "_v", buckets
    )
    total = F.col("total__c")
    ranks = {
        f"{name}_{suffix}": rounded(F.lit(float(p)) * (total - 1)) + 1
        for name, p in probs.items()
        for suffix, rounded in (("lo", F.floor), ("hi", F.ceil))
    }
    offsets = _offsets(
        bucketed, {"_c": F.lit(1)}, groups, ("_c", list(ranks.values()))
    )
    inside = _attach(bucketed, offsets, groups, ("_b",))
    counts = inside.groupBy(*groups, "_b", "_v", "_off__c", "total__c").agg(
        F.count("*").alias("_c")
    )
    window = (
        Window.partitionBy(*groups, "_b")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counts.withColumn("cum__c", F.sum("_c").over(window) + F.col("_off__c"))
    aggs = [F.max(total).alias("n")]
    for column, rank in ranks.items():
        reached = F.when(F.col("cum__c") >= rank, F.col("_v"))
        aggs.append(F.min(reached).alias(column))
    wide = ranked.groupBy(*groups).agg(*aggs)
    out = [*groups, "n"]
    for name, p in probs.items():
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out += [interpolate(lo, hi, F.col("n"), p).alias(name), lo, hi]
    return wide.select(*out)


def interpolate(lo: Column, hi: Column, n: Column, p: float) -> Column:
    position = F.lit(float(p)) * (n - 1)
    return lo + (hi - lo) * (position - F.floor(position))


def running_rows(
    df: DataFrame,
    score: str,
    row_id: str,
    sums: dict[str, Column],
    groups: Sequence[str] = (),
    seed: int | str = TIE_SEED,
) -> DataFrame:
    """Add running sums over single rows, best score first.

    Rows without a score or id have no rank and are left out. Equal scores are
    ordered by a hash of the id, then the id: stable, free of any
    meaning the ids may carry, and it lets a tie group that holds a third of the
    table be split over buckets of the hash. Adds ``total_<name>`` too.
    """
    buckets = bucket_count(df.sparkSession)
    names = list(sums)
    cell = [*groups, "_s", "_tb"]
    base = (
        df.withColumns({f"_v_{n}": c.cast("bigint") for n, c in sums.items()})
        .withColumn("_s", F.col(score).cast("double"))
        .withColumn("_u", hash_uniform(F.col(row_id), seed))
        .withColumn("_tb", hash_bucket(F.col("_u"), buckets))
    )
    base = _present(base, [*groups, "_s", row_id])
    cells = base.groupBy(*cell).agg(*[F.sum(f"_v_{n}").alias(n) for n in names])
    per_score = cells.groupBy(*groups, "_s").agg(*[F.sum(n).alias(n) for n in names])
    ranked = running_totals(per_score, "_s", names, groups)
    before = ranked.select(
        *groups,
        "_s",
        *[(F.col(f"cum_{n}") - F.col(n)).alias(f"_before_{n}") for n in names],
        *[f"total_{n}" for n in names],
    )
    earlier = (
        Window.partitionBy(*groups, "_s")
        .orderBy("_tb")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = cells.join(before, [*groups, "_s"]).select(
        *cell,
        *[
            (F.coalesce(F.sum(n).over(earlier), F.lit(0)) + F.col(f"_before_{n}")).alias(
                f"_off_{n}"
            )
            for n in names
        ],
        *[f"total_{n}" for n in names],
    )
    inside = (
        Window.partitionBy(*cell)
        .orderBy("_u", row_id)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return base.join(offsets, cell).select(
        *df.columns,
        *[(F.sum(f"_v_{n}").over(inside) + F.col(f"_off_{n}")).alias(n) for n in names],
        *[f"total_{n}" for n in names],
    )


def cut_by_quota(
    df: DataFrame,
    strata: Sequence[str],
    row_id: str,
    quotas: Sequence[Column],
    seed: int | str,
    part: str = "part",
) -> DataFrame:
    """Cut every stratum, in hash order, at exact row counts.

    ``quotas`` are cumulative row counts as expressions over ``n_stratum`` and
    ``n_total``. The result has an integer column ``part``: 0 for the first
    ``quotas[0]`` rows of the stratum, 1 up to ``quotas[1]``, and so on. Rows whose
    stratum is null are a stratum of their own.

    The table itself is never shuffled. One aggregation counts rows per (stratum,
    hash bucket); a second pass ranks only the buckets a cut falls into, to find
    the hash at which to cut; the last pass compares each row with those values.
    """
    buckets = bucket_count(df.sparkSession)
    strata = list(strata)
    drawn = df.withColumn("_u", hash_uniform(F.col(row_id), seed)).withColumn(
        "_tb", hash_bucket(F.col("_u"), buckets)
    )
    counts = drawn.groupBy(*strata, "_tb").agg(F.count("*").alias("_c"))
    total = counts.agg(F.sum("_c").alias("n_total"))
    by_stratum = Window.partitionBy(*strata)
    ordered = by_stratum.orderBy("_tb").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cumulative = (
        counts.crossJoin(F.broadcast(total))
        .withColumn("n_stratum", F.sum("_c").over(by_stratum))
        .withColumn("_cum", F.sum("_c").over(ordered))
    )
    targets = F.array(
        *[
            F.struct(F.lit(i).alias("_cut"), q.cast("bigint").alias("_quota"))
            for i, q in enumerate(quotas)
        ]
    )
    cuts = (
        cumulative.select("*", F.inline(targets))
        .where((F.col("_quota") > F.col("_cum") - F.col("_c")))
        .where(F.col("_quota") <= F.col("_cum"))
        .select(
            *strata,
            "_tb",
            "_cut",
            (F.col("_quota") - (F.col("_cum") - F.col("_c"))).alias("_need"),
        )
    )
    cuts = written(_renamed(cuts, strata), "cuts")
    rank = Window.partitionBy(*strata, "_tb", "_cut").orderBy("_u", row_id)
    limits = (
        drawn.select(*strata, "_tb", "_u", row_id)
        .withColumnRenamed("_tb", "_hb")
        .join(cuts, _same(strata) & (F.col("_hb") == F.col("_tb")))
        .withColumn("_r", F.row_number().over(rank))
        .where(F.col("_r") == F.col("_need"))
        .select(*strata, "_cut", F.struct("_u", row_id).alias("_limit"))
        .groupBy(*strata)
        .agg(
            *[
                F.min(F.when(F.col("_cut") == i, F.col("_limit"))).alias(f"_l{i}")
                for i in range(len(quotas))
            ]
        )
    )
    joined = drawn.join(written(_renamed(limits, strata), "limits"), _same(strata), "left")
    here = F.struct("_u", row_id)
    number = F.lit(len(quotas))
    for i in reversed(range(len(quotas))):
        number = F.when(here <= F.col(f"_l{i}"), F.lit(i)).otherwise(number)
    return joined.select(*df.columns, number.alias(part))


def _renamed(table: DataFrame, strata: Sequence[str]) -> DataFrame:
    return table.withColumnsRenamed({c: f"_of_{c}" for c in strata})


def _same(strata: Sequence[str]) -> Column:
    """Equal strata; a null is a stratum like any other."""
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return same
