"""Hot and NULL keys: a third of the orders lack a customer, a third belong to one
customer. Results must equal brute force, and the plan must split the skew."""

import pytest
from pyspark.sql import functions as F

from strata.operators import apply_scd2, build_fact, build_mart, materialize
from strata.sources import synthetic_customers
from tests.frames import empty_dim


@pytest.fixture()
def skew_conf(spark):
    keys = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_orders(spark, n=30_000):
    third = F.pmod(F.col("id"), F.lit(3))
    customer = (
        F.when(third == 0, F.lit(None).cast("int"))
        .when(third == 1, F.lit(7))
        .otherwise((F.pmod(F.xxhash64("id"), F.lit(1000))).cast("int"))
    )
    return spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        customer.alias("customer_id"),
        F.lit("i").alias("item_id"),
        F.lit("toy").alias("item_name"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(days=F.pmod(F.col("id"), F.lit(5)).cast("int"))).alias("delivered_on"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("datetime_order_placed"),
    )


def test_skewed_fact_and_mart_are_exact_and_split(spark, skew_conf):
    customers = synthetic_customers(spark, 1000, seed=1, as_of="2024-01-01 00:00:00")
    dim = materialize(apply_scd2(customers, empty_dim(spark), "2024-01-01-00-00-00"))
    orders = materialize(skewed_orders(spark))
    fact = build_fact(orders, dim, broadcast_limit=0)  # the shuffle path
    fact_rows = fact.collect()  # runs this DataFrame's own adaptive plan (test-sized)
    final_plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "_strata_salt" in final_plan
    assert "skew=true" in final_plan, final_plan

    # brute force on the driver (test-sized data only)
    active = {r["id"]: (r["customer_sur_id"], r["state_id"]) for r in dim.where("current").collect()}
    expected = {}
    for r in orders.collect():
        sur, state = active.get(r["customer_id"], (None, None)) if r["customer_id"] is not None else (None, None)
        key = (str(r["delivered_on"].date()), state)
        expected[key] = expected.get(key, 0) + 1
        assert sur is None or len(sur) == 32
    assert len(fact_rows) == 30_000
    assert sum(r["customer_sur_id"] is None for r in fact_rows) == 10_000
    mart = {
        (str(r["deliver_date"]), r["state_id"]): r["num_orders"]
        for r in build_mart(fact, dim, broadcast_limit=0).collect()
    }
    assert mart == expected
    # the broadcast path gives the same result without shuffling the orders
    small_fact = build_fact(orders, dim)
    assert "BroadcastHashJoin" in plan_of(small_fact) and "_strata_salt" not in plan_of(small_fact)
    assert sorted(map(tuple, small_fact.collect()), key=str) == sorted(map(tuple, fact_rows), key=str)


def test_upsert_with_a_third_of_keys_null_has_no_hot_task(spark, skew_conf):
    """Rows per task of the written upsert: none far above the mean, NULL keys on both sides."""
    from strata.operators import merge_frames

    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")

    def side(n, shift):
        key = F.when(F.pmod("id", F.lit(3)) != 0, F.col("id") + shift)
        return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").cast("string").alias("v"))

    target, source = materialize(side(60_000, 0)), materialize(side(60_000, 30_000))
    merged = merge_frames(target, source, ["k"], broadcast_limit=0)
    per_task = [r[0] for r in merged.groupBy(F.spark_partition_id()).count().select("count").collect()]
    # 20,000 NULL keys a side, 40,000 keys a side of which a share meets
    assert sum(per_task) == merged.count()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert max(per_task) < 2 * sum(per_task) / len(per_task)
