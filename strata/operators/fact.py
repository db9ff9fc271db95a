"""Order fact: every order with the surrogate key of its customer's active version.

A left join of the orders batch to the active dimension rows on
``customer_id = id``; no active row (or a NULL customer id) gives a NULL key.

Scale notes: when the active rows' measured size is within the broadcast limit
they are broadcast and the orders are streamed past them without any shuffle (AQE
could only switch to a broadcast after both sides were shuffled). Above the limit
it is a shuffle join: orders with a NULL customer id cannot match and a salt column
spreads them over many shuffle partitions (``operators.skew``) instead of one; a hot
customer on the orders side is split by AQE skew-join handling (the left side of a
left outer join can be split). Where orders and active rows are stored in the same buckets
of the customer id, and none is far larger than the others, neither side is shuffled
(``operators.colocated``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.bounded import DEFAULT_BROADCAST_LIMIT, broadcast_if_bounded, shuffled
from strata.operators.skew import SALT, with_null_salt, zero_salt
from strata.schemas import ORDERS_BATCH

ORDER_COLUMNS = [f.name for f in ORDERS_BATCH.fields]


def active_keys(dim: DataFrame, dim_key: str = "id", sur_key: str = "customer_sur_id") -> DataFrame:
    """``(_dim_id, sur_key)`` of the active dimension rows (filter pushed to the scan)."""
    return dim.where(F.col("current")).select(F.col(dim_key).alias("_dim_id"), F.col(sur_key))


def build_fact(
    orders: DataFrame,
    dim: DataFrame,
    customer_key: str = "customer_id",
    dim_key: str = "id",
    sur_key: str = "customer_sur_id",
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
    dim_bytes: int | None = None,
    co_located: bool = False,
) -> DataFrame:
    """Order columns plus ``sur_key`` of the active customer version.

    ``dim_bytes``: a known upper bound of the active rows' size (skips measuring).
    ``co_located``: both sides are stored in the same buckets of the customer, none far larger
    than the others (``operators.colocated``).
    """
    cols = [c for c in ORDER_COLUMNS if c in orders.columns]
    small, fits = broadcast_if_bounded(active_keys(dim, dim_key, sur_key), broadcast_limit, max_bytes=dim_bytes)
    if fits:
        return orders.select(*cols).join(small, F.col(customer_key) == F.col("_dim_id"), "left").select(*cols, sur_key)
    if co_located:
        return _co_located(orders.select(*cols), active_keys(dim, dim_key, sur_key), customer_key, sur_key)
    active = active_keys(dim, dim_key, sur_key).withColumn("_dim_salt", zero_salt("_dim_id"))
    salted = with_null_salt(orders.select(*cols), customer_key)
    cond = (F.col(customer_key) == F.col("_dim_id")) & (F.col(SALT) == F.col("_dim_salt"))
    return salted.join(shuffled(active), cond, "left").select(*cols, sur_key)


def _co_located(orders: DataFrame, active: DataFrame, customer_key: str, sur_key: str) -> DataFrame:
    known = orders.where(F.col(customer_key).isNotNull()).join(
        shuffled(active.where(F.col("_dim_id").isNotNull())), F.col(customer_key) == F.col("_dim_id"), "left"
    )
    unknown = orders.where(F.col(customer_key).isNull()).withColumn(sur_key, F.lit(None).cast("string"))
    return known.select(*orders.columns, sur_key).unionByName(unknown)
