"""Portable pseudo-random numbers: the same in Spark and in any SQL engine.

Every draw is a function of (id, seed), so a lost executor recomputes the same
value and a split never depends on row order or partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = float(2**32)


def hash_uniform(key: Column, seed: int | str) -> Column:
    """Uniform in [0, 1) from the first 32 bits of md5("key:seed")."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(TWO_32)


def hash_bucket(draw: Column, buckets: int) -> Column:
    """Bucket number of a uniform draw.

    Never null, and written so that the planner sees it: it would otherwise test a
    join key for null in a filter, and so hash every row twice.
    """
    return F.coalesce(F.floor(draw * buckets).cast("int"), F.lit(0))


def hash_normal(key: Column, seed: int | str) -> Column:
    """Standard normal by Box-Muller on two hash uniforms (first one in (0, 1])."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - hash_uniform(key, f"{seed}a")))
    return radius * F.cos(F.lit(2.0 * math.pi) * hash_uniform(key, f"{seed}b"))


def weighted_choice(draw: Column, weights: dict[str, float]) -> Column:
    """Pick a key of ``weights`` by comparing a uniform draw to cumulative weight."""
    if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError(f"weights must be non-negative with a positive sum: {weights}")
    total = sum(weights.values())
    names = list(weights)
    edge, chain = 0.0, None
    for name in names[:-1]:
        edge += weights[name] / total
        cond = draw < F.lit(edge)
        chain = F.when(cond, name) if chain is None else chain.when(cond, name)
    return F.lit(names[0]) if chain is None else chain.otherwise(names[-1])
