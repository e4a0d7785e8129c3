"""Contingency tables and the statistics computed from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrade.functions.clean import r6


def cells(df: DataFrame, row: str, col: str) -> DataFrame:
    """(row, col, o): counts of the pairs that occur; nulls do not count."""
    kept = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return kept.groupBy(F.col(row).alias("row"), F.col(col).alias("col")).agg(
        F.count("*").alias("o")
    )


def with_marginals(table: DataFrame) -> DataFrame:
    """Add row and column totals; everything after the first groupBy is cell-sized."""
    rows = table.groupBy("row").agg(F.sum("o").alias("row_total"))
    cols = table.groupBy("col").agg(F.sum("o").alias("col_total"))
    return table.join(rows, "row").join(cols, "col")


def crosstab_pct(
    df: DataFrame, row: str, label: str = "converted", values: Sequence[int] = (0, 1)
) -> DataFrame:
    """Counts per class plus row percentages (two decimals)."""
    return cell_crosstab(cells(df, row, label), row, label, values)


def cell_crosstab(
    table: DataFrame, row: str, label: str, values: Sequence[int] = (0, 1)
) -> DataFrame:
    """``crosstab_pct`` of a cell table."""
    counts = table.groupBy(F.col("row").alias(row)).agg(
        *[
            F.sum(F.when(F.col("col") == v, F.col("o")).otherwise(0)).alias(f"{label}_{v}")
            for v in values
        ]
    )
    total = sum((F.col(f"{label}_{v}") for v in values), F.lit(0))
    pct = [
        F.round(
            F.col(f"{label}_{v}") * F.lit(100.0) / F.nullif(total, F.lit(0)), 2
        ).alias(f"{label}_{v}_pct")
        for v in values
    ]
    return counts.select("*", *pct)


def crosstab_margins(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts with an 'All' row and column, of rows that have both values."""
    return (
        df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
        .cube(row, col)
        .agg(
            F.count("*").alias("n"),
            F.grouping(row).alias("_gr"),
            F.grouping(col).alias("_gc"),
        )
        .select(
            F.when(F.col("_gr") == 1, "All").otherwise(F.col(row)).alias(row),
            F.when(F.col("_gc") == 1, "All").otherwise(F.col(col)).alias(col),
            "n",
        )
    )


def association(df: DataFrame, row: str, col: str) -> DataFrame:
    """chi_square (no continuity correction), cramers_v (bias corrected) and
    mutual_information (nats) of two columns."""
    return cell_association(cells(df, row, col))


def cell_association(table: DataFrame) -> DataFrame:
    """``association`` of a cell table, in one pass over the cells.

    Cells that do not occur add nothing to any of the three sums. A table without
    rows, or with a single level, has cramers_v 0.
    """
    full = with_marginals(table)
    o = F.col("o").cast("double")
    product = F.col("row_total").cast("double") * F.col("col_total")
    sums = full.agg(
        F.coalesce(F.sum("o"), F.lit(0)).cast("bigint").alias("n"),
        F.count_distinct("row").alias("r"),
        F.count_distinct("col").alias("k"),
        F.sum(o * o / product).alias("_s"),
        F.sum(o * F.ln(o / product)).alias("_m"),
    )
    n, r, k = F.col("n").cast("double"), F.col("r"), F.col("k")
    less = F.nullif(n - 1, F.lit(0.0))
    phi2 = F.greatest(F.lit(0.0), F.col("_s") - 1 - (k - 1) * (r - 1) / less)
    r_fix = r - (r - 1) * (r - 1) / less
    k_fix = k - (k - 1) * (k - 1) / less
    denominator = F.least(k_fix - 1, r_fix - 1)
    v = F.when(denominator > 0, F.sqrt(phi2 / denominator))
    return sums.select(
        "n",
        "r",
        "k",
        r6(F.coalesce(n * (F.col("_s") - 1), F.lit(0.0))).alias("chi_square"),
        r6(F.coalesce(v, F.lit(0.0))).alias("cramers_v"),
        r6(
            F.when(n > 0, F.col("_m") / F.nullif(n, F.lit(0.0)) + F.ln(n)).otherwise(0.0)
        ).alias("mutual_information"),
    )
