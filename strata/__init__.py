"""strata: layered (bronze / silver / gold) batch analytics on plain Spark tables.

The library keeps a type-2 slowly changing customer dimension with hashed surrogate
keys, builds an order fact that looks those keys up, aggregates a mart of orders per
delivery date and state, and publishes every layer with one of two write modes
(replace one run partition, or upsert by key) on ordinary Parquet catalog tables.

Everything is a DataFrame / Spark SQL plan; nothing is collected to the driver.
"""

from strata.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
