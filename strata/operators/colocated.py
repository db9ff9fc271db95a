"""Joins of tables that are stored in the same buckets of their join key.

Spark reads bucket b of both sides in one task, so neither side is shuffled. What a shuffle
join gets from AQE, splitting a hot key, such a join cannot have; so it is taken only where
no bucket is far larger than the others (``balanced``), and rows without a key, which match
nothing, go around it by union: they are read in pieces of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FACTOR = 4.0
ALWAYS_FINE = 1_000_000  # rows of a bucket that one task takes at any rate


def bucket(key: str, buckets: int) -> Column:
    """The bucket in which Spark stores a key."""
    return F.pmod(F.hash(key), F.lit(buckets))


def balanced(df: DataFrame, key: str, buckets: int, factor: float = FACTOR, fine: int = ALWAYS_FINE) -> bool:
    """Whether no bucket has more than ``factor`` times the mean of the rows with a key, or ``fine`` rows.

    Reads the key column once and moves one count per task and bucket.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(bucket(key, buckets).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(F.max("n").alias("largest"), F.sum("n").alias("rows")).first()
    return (found["largest"] or 0) <= max(factor * (found["rows"] or 0) / buckets, fine)
