"""Tiny hand-made frames for edge cases."""

from strata.schemas import CUSTOMER_BATCH, DIM_CUSTOMER, ORDERS_BATCH


def customers(spark, rows):
    """rows: (id, state, datetime_updated)"""
    data = [(i, "F", f"L{i}", st, upd, upd) for i, st, upd in rows]
    return spark.createDataFrame(data, CUSTOMER_BATCH)


def empty_dim(spark):
    return spark.createDataFrame([], DIM_CUSTOMER)


def orders(spark, rows):
    """rows: (order_id, customer_id, delivered_on)"""
    data = [(o, c, "item", "chair", d, d) for o, c, d in rows]
    return spark.createDataFrame(data, ORDERS_BATCH)
