"""Surrogate keys and merge conditions."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the values cast to text and joined with no delimiter.

    NULL in any input gives a NULL key (``concat`` is NULL-strict), and a NULL key
    never matches anything, so such rows are always inserted. Timestamp text follows
    Spark's cast: trailing zero fractions are dropped.
    """
    return F.md5(F.concat(*[F.col(c) if isinstance(c, str) else c for c in cols]))


def key_condition(keys: Sequence[str], left: str = "target", right: str = "source") -> Column:
    """``left.k1 = right.k1 AND ...`` as a Column over two aliased frames."""
    if not keys:
        raise ValueError("at least one key column is required")
    parts = [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys]
    return reduce(lambda a, b: a & b, parts)


def key_condition_sql(keys: Sequence[str], left: str = "target", right: str = "source") -> str:
    """The same condition as SQL text."""
    if not keys:
        raise ValueError("at least one key column is required")
    return " AND ".join(f"{left}.`{k}` = {right}.`{k}`" for k in keys)
