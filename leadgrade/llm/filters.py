"""A filter of constant size that keeps most of a table out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrade.plans.sizing import written

BITS = 1 << 24
#: The largest filter, whatever the number of keys: 16 MB.
MOST_BITS = 1 << 27


def bits_for(keys: int) -> int:
    """Bits of a filter that is sparse for so many keys, up to ``MOST_BITS``."""
    return min(MOST_BITS, max(1 << 16, 1 << (16 * keys).bit_length()))


def parted(
    df: DataFrame, key: Column, wanted: DataFrame, bits: int = BITS
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` may be in the only column of ``wanted``, and those
    whose key surely isn't.

    The second part needs no join with ``wanted``; the first holds a few others too, more as
    ``wanted`` grows. What is broadcast has ``bits`` bits whatever the tables hold.
    """
    spark = df.sparkSession
    slot = F.pmod(F.xxhash64("k"), F.lit(bits))
    words = (
        wanted.toDF("k")
        .select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("id"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("word"))
    )
    word = F.coalesce("word", F.lit(0).cast("long")).alias("word")
    dense = (
        spark.range(0, bits >> 6, 1, 4)
        .join(words, "id", "left")
        .agg(F.sort_array(F.collect_list(F.struct("id", word))).alias("all"))
        .select(F.col("all.word").alias("_bits"))
    )
    dense = written(dense, "filter")
    own = df.withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(bits)))
    known = F.expr("getbit(_bits[cast(_slot >> 6 as int)], cast(_slot & 63 as int))")
    return tuple(
        own.join(F.broadcast(dense), known == bit).drop("_slot", "_bits") for bit in (1, 0)
    )


def maybe_in(df: DataFrame, key: Column, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """The first part of ``parted``: none that is wanted is lost, and a join has to follow."""
    return parted(df, key, wanted, bits)[0]
