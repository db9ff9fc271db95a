"""Gold mart (orders per delivery date and state) and the latest-snapshot filter.

The mart joins the fact to the *active* dimension rows on the surrogate key (no
match or a NULL key gives a NULL state) and counts rows per (delivery date, state);
NULL is a group of its own.

Plan: when the active (key, state) rows are within the broadcast limit (measured),
they are broadcast, the fact streams past them, and one exchange moves the partial
counts per (delivery date, state), a handful per task. Above the limit the fact is
first reduced to counts per (delivery date, surrogate key) with a map-side partial
aggregate, so that a customer holding a third of all orders becomes one row per date
before any shuffle; these counts are joined and summed per state, which equals counting
the joined rows (the join multiplies counts exactly as it multiplies rows). Where fact and
active rows are stored in the same buckets of the customer id, counts and join read the
buckets as they are, and only the counts per (date, state) move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.temporal import deliver_date
from strata.operators.bounded import DEFAULT_BROADCAST_LIMIT, broadcast_if_bounded, shuffled


def build_mart(
    fact: DataFrame,
    dim: DataFrame,
    sur_key: str = "customer_sur_id",
    delivered_on: str = "delivered_on",
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
    dim_bytes: int | None = None,
    customer_key: str = "customer_id",
    dim_key: str = "id",
    co_located: bool = False,
) -> DataFrame:
    """``deliver_date DATE, state_id STRING, num_orders BIGINT``.

    ``dim_bytes``: a known upper bound of the active rows' size (skips measuring).
    ``co_located``: both sides are stored in the same buckets of the customer, none far larger
    than the others (``operators.colocated``). The
    surrogate key must determine the customer, as its hash does.
    """
    active = dim.where(F.col("current")).select(F.col(sur_key).alias("_k"), F.col("state_id"))
    active, small = broadcast_if_bounded(active, broadcast_limit, max_bytes=dim_bytes)
    date = deliver_date(delivered_on).alias("deliver_date")
    if small:
        joined = fact.select(date, F.col(sur_key).alias("_k")).join(active, "_k", "left")
        return joined.groupBy("deliver_date", "state_id").agg(F.count(F.lit(1)).alias("num_orders"))
    if co_located:
        per_state = _co_located(fact, dim.where(F.col("current")), date, sur_key, customer_key, dim_key)
        return per_state.groupBy("deliver_date", "state_id").agg(F.sum("_n").alias("num_orders"))
    per_key = fact.groupBy(date, F.col(sur_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_key.join(shuffled(active), "_k", "left")
        .groupBy("deliver_date", "state_id")
        .agg(F.sum("_n").alias("num_orders"))
    )


def _co_located(fact: DataFrame, current: DataFrame, date: Column, sur_key: str, customer_key: str, dim_key: str) -> DataFrame:
    """``deliver_date, state_id, _n``: counts per customer, with states looked up in the customer's bucket."""
    counted = F.count(F.lit(1)).alias("_n")
    known = fact.where(F.col(customer_key).isNotNull())
    per_customer = known.groupBy(F.col(customer_key).alias("_id"), F.col(sur_key).alias("_k"), date).agg(counted)
    states = current.where(F.col(dim_key).isNotNull())
    states = states.select(F.col(dim_key).alias("_of"), F.col(sur_key).alias("_sur"), F.col("state_id"))
    # as a range, so that the customer is the only equality: with the surrogate key as a second
    # one, Spark would shuffle both sides by the pair
    same = (F.col("_k") <= F.col("_sur")) & (F.col("_k") >= F.col("_sur"))
    looked_up = per_customer.join(shuffled(states), (F.col("_id") == F.col("_of")) & same, "left")
    # counted on their own, so that they are read in pieces and not as one bucket
    unknown = fact.where(F.col(customer_key).isNull()).groupBy(date).agg(counted)
    unknown = unknown.withColumn("state_id", F.lit(None).cast("string"))
    return looked_up.select("deliver_date", "state_id", "_n").unionByName(unknown)


def latest_partition(df: DataFrame, col: str = "partition") -> DataFrame:
    """Rows of the newest run: ``col = (SELECT max(col))``.

    Written as a scalar subquery so a partitioned table is pruned to one partition
    (an IN-subquery becomes a semi join that scans every partition). An empty
    input gives an empty result.
    """
    newest = df.select(F.max(col)).scalar()
    return df.where(F.col(col) == newest)
