"""Bronze batches derived from the TPC-H-like test tables.

The three batches are deterministic, so the same rows can be produced by Spark and
by plain SQL in another engine:

* customer batch 1: every customer, both timestamps at the customer's first order
  date (NULL for a customer without orders);
* customer batch 2: every customer, updated at the last order date, every fifth
  customer moved to the next nation;
* held-back batch: batch 1 without one customer in ten, for the queries whose
  feature is a customer that the dimension does not know yet;
* edge batch: every case of the SCD2 rules, see ``edge_batch``;
* orders: one row per order; item = lowest part key among its line items,
  delivered_on = last ship date (NULL for orders without line items).

All joins are equi-joins that Spark plans as shuffle joins (the nations, whose number is
fixed, may be broadcast); the two aggregates run partial-then-final, so nothing grows on the driver.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bounded import shuffled

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_LOADED: dict = {}
_LOCK = threading.Lock()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables (read-only inputs).

    The DataFrame is kept per session and path, so the Parquet schema is inferred
    (one small Spark job) once instead of on every read.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    with _LOCK:
        if key not in _LOADED:
            _LOADED[key] = spark.read.parquet(path)
        return _LOADED[key]


def customer_batch(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """Customer batch ``version`` 1 or 2 (schema ``schemas.CUSTOMER_BATCH``).

    Left joins keep every customer: without orders the timestamps are NULL, without a
    nation the state is NULL.
    """
    if version not in (1, 2):
        raise ValueError("version must be 1 or 2")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = load(spark, sf_dir, "nation")
    nation = nations.select("n_nationkey", "n_name")
    first_last = (
        load(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("mn"), F.max("o_orderdate").alias("mx"))
    )
    if version == 1:
        nation_key, updated = F.col("c_nationkey"), F.col("mn")
    else:
        count = nations.select(F.count(F.lit(1))).scalar()
        nation_key = F.when(F.col("c_custkey") % 5 == 0, (F.col("c_nationkey") + 1) % count).otherwise(F.col("c_nationkey"))
        updated = F.col("mx")
    return (
        customer.withColumn("nation_key", nation_key)
        .join(nation, F.col("nation_key") == F.col("n_nationkey"), "left")
        .join(shuffled(first_last), F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("c_custkey").cast("int").alias("id"),
            F.lit("Customer").alias("first_name"),
            F.expr("substring(c_name, 10)").alias("last_name"),
            F.col("n_name").alias("state_id"),
            F.col("mn").alias("datetime_created"),
            updated.alias("datetime_updated"),
        )
    )


HELD_BACK = 10  # the held-back batch lacks one customer in so many


def held_back_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 without every tenth customer: these are new in batch 2, and their orders find no customer."""
    return customer_batch(spark, sf_dir, 1).where(F.col("id") % HELD_BACK != HELD_BACK - 1)


EDGE_NEW = 1_000_000_000  # added to an id to make it unknown
EDGE_HOT = 2_000_000_000  # the id that a third of all rows share


def edge_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 with every customer turned into a case of the SCD2 rules by its id modulo 9.

    0: equal timestamp, 1: an hour older, 2: a NULL timestamp, 3: a NULL id, 4: two
    versions of an unknown id, 5: a newer version, 6 to 8: one hot unknown id.
    """
    case = F.col("id") % 9
    hour = F.expr("interval 1 hour")
    times = (
        F.when(case == 1, F.array(F.col("datetime_updated") - hour))
        .when(case == 2, F.array(F.lit(None).cast("timestamp_ntz")))
        .when(case == 4, F.array(F.col("datetime_updated"), F.col("datetime_updated") + hour))
        .when(case == 5, F.array(F.col("datetime_updated") + hour))
        .otherwise(F.array(F.col("datetime_updated")))
    )
    new_id = (
        F.when(case == 3, F.lit(None).cast("int"))
        .when(case == 4, F.col("id") + EDGE_NEW)
        .when(case >= 6, F.lit(EDGE_HOT))
        .otherwise(F.col("id"))
    )
    rows = customer_batch(spark, sf_dir, 1).withColumn("_time", F.explode(times)).withColumn("_id", new_id)
    return rows.select(
        F.col("_id").cast("int").alias("id"), "first_name", "last_name", "state_id", "datetime_created",
        F.col("_time").alias("datetime_updated"),
    )


def orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders batch (schema ``schemas.ORDERS_BATCH``)."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    per_order = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("pk"), F.max("l_shipdate").alias("sd"))
    )
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (
        orders.join(shuffled(per_order), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(shuffled(part), F.col("p_partkey") == F.col("pk"), "left")
        .select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("int").alias("customer_id"),
            F.col("pk").cast("string").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("sd").alias("delivered_on"),
            F.col("o_orderdate").alias("datetime_order_placed"),
        )
    )
