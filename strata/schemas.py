"""Explicit schemas of the five tables and the audit table; nothing is inferred.

Business timestamps are ``TIMESTAMP_NTZ`` (wall-clock values, as in the input batches),
so surrogate keys do not depend on the session time zone. ``etl_inserted`` is an
instant and stays ``TIMESTAMP``.
"""

from __future__ import annotations

from pyspark.sql import types as T

PARTITION_COL = "partition"
ETL_INSERTED_COL = "etl_inserted"

CUSTOMER_BATCH = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("state_id", T.StringType()),
        T.StructField("datetime_created", T.TimestampNTZType()),
        T.StructField("datetime_updated", T.TimestampNTZType()),
    ]
)

ORDERS_BATCH = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("delivered_on", T.TimestampNTZType()),
        T.StructField("datetime_order_placed", T.TimestampNTZType()),
    ]
)

_AUDIT = [
    T.StructField(ETL_INSERTED_COL, T.TimestampType()),
    T.StructField(PARTITION_COL, T.StringType()),
]

CUSTOMER_TABLE = T.StructType(list(CUSTOMER_BATCH.fields) + _AUDIT)
ORDERS_TABLE = T.StructType(list(ORDERS_BATCH.fields) + _AUDIT)

# the dimension has no etl_inserted column
DIM_CUSTOMER = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("customer_sur_id", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("state_id", T.StringType()),
        T.StructField("datetime_created", T.TimestampNTZType()),
        T.StructField("datetime_updated", T.TimestampNTZType()),
        T.StructField("current", T.BooleanType()),
        T.StructField("valid_from", T.TimestampNTZType()),
        T.StructField("valid_to", T.TimestampNTZType()),
        T.StructField(PARTITION_COL, T.StringType()),
    ]
)

FCT_ORDERS = T.StructType(
    list(ORDERS_BATCH.fields) + [T.StructField("customer_sur_id", T.StringType())] + _AUDIT
)

SALES_MART = T.StructType(
    [
        T.StructField("deliver_date", T.DateType()),
        T.StructField("state_id", T.StringType()),
        T.StructField("num_orders", T.LongType()),
    ]
    + _AUDIT
)

RUN_METADATA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_id", T.StringType()),
        T.StructField("run_params", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("timestamp_inserted", T.TimestampType()),
    ]
)


def ddl_columns(schema: T.StructType) -> str:
    """``name TYPE, ...`` for CREATE TABLE, with every name quoted."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
