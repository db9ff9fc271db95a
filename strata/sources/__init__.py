"""Sources: the fixture batches derived from the given tables, seeded synthetic
batches generated on the executors, and reads of published folders."""

from strata.sources.catalog import read_path
from strata.sources.synthetic import synthetic_customers, synthetic_orders
from strata.sources.testdata import (
    TABLES,
    customer_batch,
    edge_batch,
    held_back_batch,
    load,
    orders_batch,
)

__all__ = [
    "TABLES",
    "customer_batch",
    "edge_batch",
    "held_back_batch",
    "load",
    "orders_batch",
    "read_path",
    "synthetic_customers",
    "synthetic_orders",
]
