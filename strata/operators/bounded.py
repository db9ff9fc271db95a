"""Size-checked broadcasts.

A side is broadcast only after its exact payload was measured with one aggregate
(row count plus the byte length of every variable-width value). Anything above the
limit takes the shuffle path, so a broadcast can never grow with the data unchecked.
A side that was not measured, or declined, is joined as ``shuffled``: left to itself, Spark
broadcasts what the file sizes let it take for small, however many rows well-compressed files hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_LIMIT = 32 * 1024 * 1024  # bytes of measured payload
_VARIABLE = (T.StringType, T.BinaryType)
_FIXED = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)


@dataclass(frozen=True)
class Footprint:
    rows: int
    bytes: int


def footprint(df: DataFrame) -> Footprint:
    """Rows and an upper bound of the in-memory bytes of ``df`` (one Spark job).

    Fixed-width values count 8 bytes, variable-width ones their octet length plus 8,
    and every row 16 bytes of header, close to Spark's UnsafeRow layout.
    """
    fields = df.schema.fields
    lengths = [
        F.coalesce(F.sum(F.octet_length(F.col(f"`{f.name}`"))), F.lit(0))
        for f in fields
        if isinstance(f.dataType, _VARIABLE)
    ]
    total = F.lit(0)
    for length in lengths:
        total = total + length
    row = df.agg(F.count(F.lit(1)).alias("rows"), total.cast("long").alias("var_bytes")).first()
    rows = int(row["rows"])
    return Footprint(rows=rows, bytes=rows * (16 + 8 * len(fields)) + int(row["var_bytes"] or 0))


def fixed_width_bound(df: DataFrame, max_rows: int) -> int | None:
    """Byte bound of ``df`` from a known row bound, when every column is fixed-width."""
    if not all(isinstance(f.dataType, _FIXED) for f in df.schema.fields):
        return None
    return max_rows * (16 + 8 * len(df.schema.fields))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a join side that goes through the shuffle (or lies in join buckets), whatever its files' size."""
    return df.hint("merge")


def broadcast_if_bounded(
    df: DataFrame,
    limit: int = DEFAULT_BROADCAST_LIMIT,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when its size is within ``limit``, else ``(df, False)``.

    A caller that already holds a proven upper bound passes it: ``max_bytes`` (e.g.
    the measured footprint of a superset of the rows and columns), or ``max_rows``
    (e.g. the observed row count of the batch it is derived from) for frames with only
    fixed-width columns. Otherwise the size is measured with one aggregate.
    """
    if limit <= 0:
        return df, False
    bound = max_bytes
    if bound is None and max_rows is not None:
        bound = fixed_width_bound(df, max_rows)
    if bound is None:
        bound = footprint(df).bytes
    if bound <= limit:
        return F.broadcast(df), True
    return df, False
