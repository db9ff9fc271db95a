"""Seeded synthetic bronze batches, generated on the executors.

Every value is a pure function of (seed, row id), so a batch is reproducible and a
lost task recomputes the same rows. ``spark.range`` spreads the rows over tasks; no
row list is built on the driver. Random choices come from the first 32 bits of
``md5("seed:tag:row")``, which plain SQL engines compute the same way, so generated
batches can be checked against an SQL oracle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value lists of the generator.
ITEMS = ["chair", "car", "toy"]
FIRST_NAMES = [
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda",
    "William", "Elizabeth", "David", "Barbara", "Richard", "Susan", "Joseph", "Jessica",
]
LAST_NAMES = [
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis",
    "Rodriguez", "Martinez", "Hernandez", "Lopez", "Gonzalez", "Wilson", "Anderson", "Thomas",
]
# postal codes of the states, the capital district and the territories
STATES = [
    "AK", "AL", "AR", "AS", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "FM", "GA", "GU", "HI",
    "IA", "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MH", "MI", "MN", "MO", "MP",
    "MS", "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "PR",
    "PW", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VI", "VT", "WA", "WI", "WV", "WY",
]


def _digest(seed: int | Column, tag: str, row: Column) -> Column:
    seed_col = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", seed_col, F.lit(tag), row.cast("string")))


def _hash32(seed: int | Column, tag: str, row: Column) -> Column:
    """A non-negative 32-bit integer from the md5 of ``seed:tag:row``."""
    return F.conv(F.substring(_digest(seed, tag, row), 1, 8), 16, 10).cast("long")


def _pick(values: list[str], seed: int | Column, tag: str, row: Column) -> Column:
    idx = _hash32(seed, tag, row) % F.lit(len(values)) + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int"))


def _uuid(seed: int, tag: str, row: Column) -> Column:
    h = _digest(seed, tag, row)
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12),
    )


def _as_of(as_of: datetime | str | None) -> Column:
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(as_of)).cast("timestamp_ntz")


BASE_TIME = "2000-01-01 00:00:00"


def synthetic_customers(
    spark: SparkSession,
    ids: DataFrame | int = 1000,
    seed: int = 0,
    as_of: datetime | str | None = None,
    changed_share: float = 1.0,
) -> DataFrame:
    """One customer per id with random names and state; both timestamps = ``as_of``.

    ``ids`` is either a count (ids 0..n-1) or a DataFrame with an integer ``id`` column.
    ``changed_share`` is the fraction of ids (chosen by a hash of the id, so the same
    ids every run) that carry ``as_of``; the others carry a fixed base time and fixed
    attributes, so from the second run on they are unchanged versions.
    """
    frame = spark.range(ids).select(F.col("id")) if isinstance(ids, int) else ids.select("id")
    row = F.col("id").cast("long")
    if not 0.0 <= changed_share <= 1.0:
        raise ValueError("changed_share must be within [0, 1]")
    changed = _hash32(0, "changed", row) % F.lit(10_000) < F.lit(int(round(changed_share * 10_000)))
    row_seed = F.when(changed, F.lit(seed)).otherwise(F.lit(0))
    ts = F.when(changed, _as_of(as_of)).otherwise(F.lit(BASE_TIME).cast("timestamp_ntz"))
    return frame.select(
        F.col("id").cast("int").alias("id"),
        _pick(FIRST_NAMES, row_seed, "first", row).alias("first_name"),
        _pick(LAST_NAMES, row_seed, "last", row).alias("last_name"),
        _pick(STATES, row_seed, "state", row).alias("state_id"),
        ts.alias("datetime_created"),
        ts.alias("datetime_updated"),
    )


def synthetic_orders(
    spark: SparkSession,
    num_orders: int = 10_000,
    customers: int | tuple[int, int] = 1000,
    seed: int = 0,
    as_of: datetime | str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``num_orders`` orders with uuid ids, a uniform customer id and a random item.

    ``customers`` is a count (ids 0..n-1) or an inclusive ``(low, high)`` id range.
    """
    low, high = (0, customers - 1) if isinstance(customers, int) else customers
    span = high - low + 1
    if span <= 0:
        raise ValueError("empty customer id range")
    row = F.col("id")
    ts = _as_of(as_of)
    frame = spark.range(0, num_orders, 1, partitions) if partitions else spark.range(num_orders)
    return frame.select(
        _uuid(seed, "order", row).alias("order_id"),
        (_hash32(seed, "customer", row) % F.lit(span) + low).cast("int").alias("customer_id"),
        _uuid(seed, "item", row).alias("item_id"),
        _pick(ITEMS, seed, "item_name", row).alias("item_name"),
        ts.alias("delivered_on"),
        ts.alias("datetime_order_placed"),
    )
