"""Spreading NULL join keys over shuffle partitions.

A NULL key never matches in an equi-join, but a shuffle still hashes every NULL to
the same partition, so a batch where a third of the rows lack a key would load one
task with a third of the data. ``with_null_salt`` adds a second join key: 0 for rows
with a key, a hash of the row's values (0..NULL_SPREAD-1) for rows without one. The
other side gets a salt that is always 0 (and is not a constant the optimizer could
fold away), so matches are unchanged while NULL-key rows land on up to
``NULL_SPREAD`` partitions. Hot *non-NULL* keys are split by AQE skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 1024
SALT = "_strata_salt"


def with_null_salt(df: DataFrame, key: str, name: str = SALT, spread: int = NULL_SPREAD) -> DataFrame:
    """``df`` plus ``name``: 0 when ``key`` is set, a row-hash bucket when it is NULL."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    salt = F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(spread))).otherwise(F.lit(0).cast("long"))
    return df.withColumn(name, salt)


def zero_salt(key: str) -> Column:
    """A salt that is 0 on every row with a key, computed from the key column."""
    # ``hash * 0`` is folded to a literal by the optimizer; a bitwise AND is not
    return F.xxhash64(F.col(key)).bitwiseAND(F.lit(0))
