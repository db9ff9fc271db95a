"""Fact lookup, mart aggregate and the latest-snapshot filter."""

from pyspark.sql import functions as F

from strata.operators import apply_scd2, build_fact, build_mart, latest_partition, materialize
from tests.conftest import ts
from tests.frames import customers, empty_dim, orders


def test_order_without_customer_gets_null_key_and_null_state(spark):
    dim = materialize(apply_scd2(customers(spark, [(1, "CA", ts(1))]), empty_dim(spark), "2024-01-01-00-00-00"))
    o = orders(spark, [("a", 1, ts(5)), ("b", 9, ts(5)), ("c", None, ts(6)), ("d", 1, None)])
    fact = build_fact(o, dim)
    keys = {r["order_id"]: r["customer_sur_id"] for r in fact.collect()}
    assert keys["a"] is not None and keys["b"] is None and keys["c"] is None
    mart = {(str(r["deliver_date"]), r["state_id"]): r["num_orders"] for r in build_mart(fact, dim).collect()}
    assert mart == {("2024-01-05", "CA"): 1, ("2024-01-05", None): 1, ("2024-01-06", None): 1, ("None", "CA"): 1}


def test_mart_rebuild_after_change_gives_null_state(spark):
    dim1 = materialize(apply_scd2(customers(spark, [(1, "CA", ts(1))]), empty_dim(spark), "2024-01-01-00-00-00"))
    fact = materialize(build_fact(orders(spark, [("a", 1, ts(5))]), dim1))
    dim2 = materialize(apply_scd2(customers(spark, [(1, "NY", ts(2))]), dim1, "2024-01-02-00-00-00"))
    rows = build_mart(fact, dim2).collect()
    assert [(r["state_id"], r["num_orders"]) for r in rows] == [(None, 1)]


def test_mart_counts_equal_row_counts_with_duplicate_active_rows(spark):
    # two active versions with the same key (same id and timestamp twice in one batch)
    dim = materialize(
        apply_scd2(customers(spark, [(1, "CA", ts(1)), (1, "CA", ts(1))]), empty_dim(spark), "2024-01-01-00-00-00")
    )
    fact = build_fact(orders(spark, [("a", 1, ts(5)), ("b", 1, ts(5))]), dim)
    assert fact.count() == 4  # each order matches both active rows
    rows = build_mart(fact, dim).collect()
    # joined rows: 4 fact rows x 2 dim rows with the same key
    assert [(r["state_id"], r["num_orders"]) for r in rows] == [("CA", 8)]


def test_latest_partition_and_empty_input(spark):
    df = spark.createDataFrame([(1, "2024-01-01-00-00-00"), (2, "2024-01-02-00-00-00")], "x int, partition string")
    assert [r["x"] for r in latest_partition(df).collect()] == [2]
    assert latest_partition(df.where(F.lit(False))).count() == 0
